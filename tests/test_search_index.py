"""The index on disk: best hits by blocks, segments that take new records, and tables that change."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from lexisift.operators import search
from lexisift.operators import search_index as SI
from lexisift.plans import registry
from lexisift.sources.shared import fresh_path


def words(c="t"):
    return F.filter(F.split(c, " "), lambda w: w != "")


def corpus(spark, n, seed=1):
    """Every document holds 'common', most a frequent word, some rare ones."""
    rng = random.Random(seed)
    rows = [(i, " ".join(["common"] * rng.randrange(1, 3) + rng.choices(["often", "much"], k=rng.randrange(1, 4)) + [f"rare{rng.randrange(60)}" for _ in range(rng.randrange(3))])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, t string")


def found(df):
    return sorted((r["q"], r["rank"], r["key"], round(r["score"], 5)) for r in df.collect())


@pytest.fixture(scope="module")
def written_index(spark):
    path = fresh_path(spark, "index-test")
    SI.write_index(search.build_index(corpus(spark, 600), "k", {"t": words()}), path, size=16)
    return SI.open_index(spark, path)


@pytest.mark.parametrize(("k", "tried", "norms"), [(10, 2, True), (3, 1, True), (10, 2, False), (1000, 2, True)])
def test_best_hits_by_blocks_equal_all_hits(spark, written_index, k, tried, norms):
    asked = spark.createDataFrame([(1, "common rare7"), (2, "often"), (3, "rare3 rare4 much common"), (4, "nothing"), (5, ""), (6, "common")], "q long, t string")
    terms = search.query_terms(asked, "q", words())
    want = search.top(search.match(written_index, terms, "t", 2.0, norms), k)
    assert found(SI.top_match(search.of_few_terms(written_index, terms), terms, "t", k, 2.0, norms, tried)) == found(want)


def test_a_common_words_postings_are_mostly_not_scored(spark, written_index):
    terms = search.query_terms(spark.createDataFrame([(1, "common rare7")], "q long, t string"), "q", words())
    chosen = []
    SI.top_match(written_index, terms, "t", 5, blocks_scored=chosen).collect()
    every = written_index.blocks.where("term = 'common'").agg(F.sum(F.size("entries"))).first()[0]
    scored = sum(c.join(written_index.blocks.where("term = 'common'"), ["segment", "block"]).agg(F.coalesce(F.sum(F.size("entries")), F.lit(0))).first()[0] for c in chosen)
    assert every == 600 and scored < every / 4


def test_blocks_hold_every_posting_once(written_index):
    flat = written_index.blocks.select("field", "term", F.inline("entries"))
    assert flat.count() == written_index.postings.count() and flat.join(written_index.postings, ["field", "term", "key", "tf", "length"]).count() == flat.count()
    assert written_index.blocks.groupBy("block").agg(F.count_distinct("block")).count() == -(-600 // 16)


def test_many_terms_are_not_put_into_a_filter(spark, written_index):
    terms = spark.range(20).select(F.lit(1).alias("q"), F.concat(F.lit("rare"), F.col("id")).alias("term"), F.lit(1.0).alias("weight"))
    assert search.of_few_terms(written_index, terms, 10) is written_index
    assert search.of_few_terms(written_index, terms, 20).terms.count() == 20


def segments(spark, **options):
    return SI.SegmentedIndex(spark, fresh_path(spark, "segments"), {"t": words()}, "k", size=4, **options)


def batch(spark, rows):
    return spark.createDataFrame(rows, "k long, t string, published long, key string")


FIRST = [(1, "a b", 5, "x"), (2, "b c", 5, "x"), (3, "c c d", 5, "x"), (4, "", 5, "x"), (None, "a", 5, "x"), (5, None, 5, "x")]
SECOND = [(2, "a a a", 6, "x"), (3, "z", 4, "too old"), (6, "b", 1, "x"), (6, "c e", 2, "newer in its batch")]
THIRD = [(1, "", 9, "now without terms"), (2, "b", 6, "equal times: the later batch"), (7, "a f", 1, "x"), (6, "d", None, "no time: oldest")]
LEFT = [(2, "b"), (3, "c c d"), (6, "c e"), (7, "a f")]


def same_as_fresh(spark, index, rows):
    fresh = search.build_index(spark.createDataFrame(rows, "k long, t string"), "k", {"t": words()})
    terms = search.query_terms(spark.createDataFrame([(n, t) for n, t in enumerate("a,b c,d e,c f z".split(","))], "q long, t string"), "q", words(F.translate("t", ",", " ")))
    want = found(search.top(search.match(fresh, terms, "t")))
    assert found(search.top(search.match(index, terms, "t"))) == want and found(SI.top_match(index, terms, "t")) == want
    assert [(r["field"], r["documents"], round(r["mean_length"], 9)) for r in index.fields.collect()] == [(r["field"], r["documents"], round(r["mean_length"], 9)) for r in fresh.fields.collect()]
    assert sorted((r["term"], round(r["idf"], 9)) for r in index.terms.collect()) == sorted((r["term"], round(r["idf"], 9)) for r in fresh.terms.collect())


def test_segments_equal_a_fresh_index_after_replacements_and_compaction(spark):
    index = segments(spark)
    for n, rows in enumerate((FIRST, SECOND, THIRD)):
        index.add(batch(spark, rows), n)
    same_as_fresh(spark, index.open(), LEFT)
    index.add(batch(spark, THIRD), 2)  # the same batch again
    same_as_fresh(spark, index.open(), LEFT)
    index.compact()
    same_as_fresh(spark, index.open(), LEFT)
    index.add(batch(spark, [(2, "a d", 7, "x"), (8, "b z", 1, "x")]), 3)
    same_as_fresh(spark, index.open(), [(2, "a d"), (8, "b z"), *LEFT[1:]])
    assert sorted(r["key"] for r in index.documents().collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_an_empty_batch_and_an_incomplete_segment(spark):
    index = segments(spark)
    index.add(batch(spark, []), 0)
    index.add(batch(spark, FIRST), 1)
    index.add(batch(spark, SECOND), 2)
    shutil.rmtree(index.root.removeprefix("file:") + "/segment-000000002/fields")  # as if its writer had died
    same_as_fresh(spark, index.open(), [(1, "a b"), (2, "b c"), (3, "c c d")])
    index.add(batch(spark, SECOND), 2)
    index.add(batch(spark, THIRD), 3)
    same_as_fresh(spark, index.open(), LEFT)


def test_queries_see_a_table_that_changed(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    query, folder = registry.queries()["Q1_match"], str(tmp_path)
    rows.coalesce(1).write.parquet(f"{folder}/part.parquet")
    before = query(spark, folder).collect()
    asked = rows.where("p_partkey % 100 = 0").select("p_partkey", F.lit("unseen").alias("p_name"), *rows.columns[2:])
    asked.coalesce(1).write.mode("overwrite").parquet(f"{folder}/part.parquet")
    after = query(spark, folder).collect()
    n = asked.count()
    assert len(before) == 10 * n and {(r["q"], r["key"]) for r in after} == {(a["p_partkey"], b["p_partkey"]) for a in asked.collect() for b in asked.collect()}
