from pyspark.sql import functions as F

import corpus_pipeline

WORDS = "the quick brown fox jumps over that lazy dog with this thing and then some more words of it are here for all to read"


def test_stages_keep_what_is_clean(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "secrets", "packing"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(9001, WORDS + " token = abcdef123456", "en", "s", 0), (9002, WORDS + " token = abcdef123456", "en", "s", 0), (9003, "12 34 !!", "en", "s", 8), (9004, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema).withColumn("n_chars", F.char_length("text").cast("long")))
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, seen, "").collect(), docs.schema)
        assert kept.columns == docs.columns
        ids = {r["doc_id"] for r in kept.collect()}
        if name == "language_id":
            assert not ids & {9003, 9004} and len(ids) >= 0.98 * seen.count()
        if name == "near_duplicates":
            assert 9001 in ids and 9002 not in ids and len(ids) == kept.count()
        if name == "secrets":
            row = kept.where("doc_id = 9001").first()
            assert row["text"] == WORDS + " [SECRET]" and row["n_chars"] == len(row["text"])
            before = {r["doc_id"]: r["text"] for r in seen.collect()}
            assert sum(r["text"] != before[r["doc_id"]] for r in kept.collect()) < 0.1 * len(before)
        seen = kept
    pieces = corpus_pipeline.packing(spark, seen, "")
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in seen.collect()}


def test_repeated_rows_count_once(spark):
    rows = [(1, WORDS, "en", "s", 1), (1, WORDS, "en", "s", 1), (2, "", "en", "s", 0), (None, WORDS, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()) == ["1", "2", "None"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_of_several_languages_stay(spark):
    said = {
        "en": WORDS,
        "fr": "le vif renard brun saute par dessus ce chien paresseux avec cette chose et puis encore quelques mots qui sont ici pour tous",
        "de": "der schnelle braune fuchs springt ueber den faulen hund mit diesem ding und dann noch einige worte davon sind hier zum lesen",
    }
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    mixed = [(500, f"{said['en']} {said['fr']}"), (501, f"{said['de']} {said['fr']}"), (502, " ".join(said.values())), (503, " ".join(t for x in zip(*map(str.split, said.values())) for t in x))]
    rows = [(i, said[x], x, "s", 1) for i, x in enumerate([*said] * 20)] + [(i, t, None, "s", 1) for i, t in mixed]
    got = {r["doc_id"] for r in corpus_pipeline.language_id(spark, spark.createDataFrame(rows, schema), "").collect()}
    assert got >= {500, 501, 502} and len(got) >= len(rows) - 1
    bare = spark.createDataFrame([(1, WORDS, None, "s", 1), (2, "12 !!", None, "s", 1), (3, None, None, "s", 1)], schema)
    assert [r["doc_id"] for r in corpus_pipeline.language_id(spark, bare, "").collect()] == [1]
