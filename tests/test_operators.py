"""Operators on small inline tables: nulls, blanks, ties, repeated rows and empty tables."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexisift.functions import analyzers, arrays, scalars
from lexisift.functions import text as T
from lexisift.operators import decisions, features, geocoding, metrics, nested, ranking, relational, search, tree, vectors
from lexisift.sources import tables
from lexisift.sources.shared import fresh_path


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'array<double>' if isinstance(v, list) and v and isinstance(v[0], float) else 'array<string>' if isinstance(v, list) else 'int'}" for k, v in values.items()))
    return row.select(column).first()[0]


def test_blanks_and_sentinels(spark):
    df = spark.createDataFrame([("a", None), ("  ", "x"), (None, None)], "rs_x string, b string")
    assert [r[0] for r in scalars.fill_sentinel(df, ["rs_x"]).collect()] == ["a", "rsxinconnue", "rsxinconnue"]
    value, source = scalars.first_non_blank([("r", F.col("rs_x")), ("b", F.col("b"))])
    assert [tuple(r) for r in df.select(value, source).collect()] == [("a", "r"), ("x", "b"), (None, None)]


def test_cleaning(spark):
    assert one(spark, T.clean(F.col("c")), c="L'École-d’Été!") == "l ecole d ete "
    assert one(spark, T.preprocess(F.col("c")), c="de la") is None
    assert one(spark, T.preprocess(F.col("c")), c=None) is None
    assert one(spark, T.ngrams(F.col("c"), 3), c="ab") == [" ab"]
    assert one(spark, T.padded_ngrams(F.col("c"), 3), c="ab") == ["##a", "#ab", "ab#", "b##"]
    assert one(spark, T.acronym(F.col("c")), c="Société Nationale des Chemins") == "SNC"
    assert one(spark, T.acronym(F.col("c")), c="Madame Dupont Durand") is None


def test_addresses(spark):
    number, street = T.house_number(F.col("c"))
    assert one(spark, number, c="12 rue X") == "12" and one(spark, street, c="rue X") == "rue X" and one(spark, number, c="rue X") is None
    first, second = T.split_name(F.col("c"))
    assert one(spark, first, c="Bar (du Port)") == "Bar" and one(spark, second, c="Bar (du Port)") == "du Port" and one(spark, second, c="Bar") is None


def test_analyzers(spark):
    assert one(spark, analyzers.edge_ngrams(F.col("c")), c="A abcd") == ["ab", "abc", "abcd"]
    assert one(spark, analyzers.keyword(F.col("c")), c="x" * 257) == []
    assert one(spark, analyzers.dotted(F.col("c")), c="S.N.C.F.") == ["sncf"]
    assert one(spark, analyzers.acronym(F.col("c")), c="Les Amis de la Mer du Nord") == ["amn"]
    assert one(spark, analyzers.elide(F.col("c")), c="l'eau d'ici") == "eau ici"


def test_spell_correction(spark):
    words = spark.createDataFrame([("bread",), ("board",), ("cat",)], "w string")
    rows = spark.createDataFrame([(1, "bred cat"), (2, "xyzzy cat"), (3, ""), (4, None)], "k int, t string")
    assert {r["k"]: r["corrected"] for r in T.spell_correct(rows, "k", "t", words, "w").collect()} == {1: "bread cat", 2: "xyzzy cat", 3: "", 4: None}


def test_points(spark):
    assert tuple(one(spark, arrays.parse_point(F.col("c")), c="48.5, 2")) == (48.5, 2.0)
    for bad in ("48.5", "a, b", "148, 2", "1,2,3", None):
        assert one(spark, arrays.parse_point(F.col("c")), c=bad) is None
    assert one(spark, arrays.haversine(F.col("a"), F.lit(0.0), F.lit(1.0), F.lit(0.0)), a=0.0) == pytest.approx(111195.08, abs=1)


def test_rank_of_truth(spark):
    df = spark.createDataFrame([(["a", "b"], "b"), (["a"], "z"), (None, "a"), ([], "a")], "items array<string>, truth string")
    assert [tuple(r) for r in df.select(ranking.rank_of_truth(F.col("items"), F.col("truth")), ranking.rank_or_sentinel(F.col("items"), F.col("truth"))).collect()] == [(2, 1), (-1, 10), (-2, None), (-1, 10)]


def test_topk_ties_and_long_wide(spark):
    df = spark.createDataFrame([("a", i, 1.0) for i in (3, 1, 2)] + [("b", 9, None)], "g string, k int, s double")
    top = ranking.top_k(df, ["g"], [F.desc("s"), F.col("k")], 2)
    assert sorted(tuple(r) for r in top.select("g", "k", "rank").collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 9, 1)]
    back = ranking.long(ranking.wide(top, ["g"], ["k"], 2), ["g"], ["k"], 2)
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 9)]


def test_gap_features_single_candidate(spark):
    df = spark.createDataFrame([("a", 0.0, 1)], "g string, s double, rank int")
    assert tuple(ranking.gap_features(df, ["g"], "s").first()) == ("a", 0.0, 0.0, 0.0, None, None)


def test_relational(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, c string")
    assert sorted(r["code"] for r in relational.label_encode(df, "c", "code").collect()) == [0, 1]
    changed = relational.update_by_key(df, spark.createDataFrame([(2, "z")], "k int, c string"), "k", ["c"])
    assert sorted(tuple(r) for r in changed.collect()) == [(1, "x"), (2, "z"), (3, "y")]
    assert [r[0] for r in relational.in_list(df, "k", list(range(1001))).orderBy("k").select("k").collect()] == [1, 2, 3]
    yes, no = relational.split(df, F.col("c") == "x")
    assert (yes.count(), no.count()) == (1, 2)
    batched = relational.batches(spark.range(25).withColumnRenamed("id", "k"), ["k"], 10, "b")
    assert sorted((r["k"], r["b"]) for r in batched.collect()) == [(i, i // 10) for i in range(25)]
    with pytest.raises(Exception, match="not unique"):
        relational.checked_left_join(df, df.union(df).select("k"), "k").count()


def test_oversample(spark):
    df = spark.createDataFrame([(i, int(i == 0 or i == 1), [float(i)]) for i in range(9)], "k int, y int, x array<double>")
    made = relational.oversample(df, "y", "k", "x")
    assert {r["y"]: r["count"] for r in made.groupBy("y").count().collect()} == {0: 7, 1: 7}


def test_metrics(spark):
    df = spark.createDataFrame([(0.9, True), (0.9, False), (0.6, True), (0.4, False), (0.1, False)], "s double, t boolean")
    assert metrics.best_threshold(df, "s", F.col("t"), 0.6).first()[0] == 0.6
    assert metrics.best_threshold(df, "s", F.col("t"), 0.99).first()[0] == 0.5
    area = metrics.areas(df, "s", F.col("t")).first()
    assert area["roc_auc"] == pytest.approx((0.5 + 1 + 1 + 0 + 1 + 1) / 6)
    cells = metrics.confusion(df, F.col("t"), F.col("s") > 0.5).first()
    assert (cells["tp"], cells["fp"], cells["fn"], cells["tn"]) == (2, 1, 0, 2)
    assert metrics.confusion(df.where("s > 2"), F.col("t"), F.col("s") > 0.5).first()["accuracy"] is None
    curve = {r["k"]: r["accuracy"] for r in metrics.topk_curve(spark.createDataFrame([(1,), (5,), (-1,), (None,)], "r int"), "r").collect()}
    assert curve[1] == 0.25 and curve[10] == 0.5 and all(curve[k] <= curve[k + 1] for k in range(1, 10))


def test_ancestor_weights_of_a_chain(spark):
    chain = spark.createDataFrame([("98", None), ("982", "98"), ("9820", "982"), ("9820Z", "9820")], "code string, parent string")
    w = {(r["code"], r["other"]): r["weight"] for r in tree.ancestor_weights(tree.ancestors(chain)).collect()}
    assert [w["9820Z", c] for c in ("9820Z", "9820", "982", "98")] == [1, 0.5, 0.25, 0.125] and w["98", "9820Z"] == 0.125


def test_tree_merges_a_child_equal_to_its_parent(spark):
    rows = spark.createDataFrame([("1", "a", None), ("2", "a", "1"), ("3", "b", "2")], "code string, label string, parent string")
    assert sorted((r["code"], r["parent"], r["level"]) for r in tree.load_tree(rows, "code", "label", "parent").collect()) == [("1", None, 0), ("3", "1", 1)]


def test_vectors(spark):
    assert one(spark, vectors.cosine(F.col("a"), F.col("a")), a=[1.0, 2.0]) == pytest.approx(1)
    assert one(spark, vectors.cosine(F.col("a"), F.array(F.lit(0.0), F.lit(0.0))), a=[1.0, 2.0]) is None
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0])], "k long, v array<double>")
    near = vectors.nearest(df.where("k = 1"), df, "k", "v", 2)
    assert [(r["k"], r["rank"]) for r in near.orderBy("rank").collect()] == [(2, 1), (3, 2)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=6), st.lists(st.sampled_from("abc"), max_size=6))
def test_overlap_of_multisets(spark, a, b):
    want = sum(min(a.count(x), b.count(x)) for x in set(a)) / len(b) if b else 0.0
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert df.select(vectors.overlap(F.col("a"), F.col("b"))).first()[0] == pytest.approx(want)


def test_search_edge_cases(spark):
    docs = spark.createDataFrame([(1, "rue du port"), (2, "rue"), (3, ""), (4, None)], "k long, t string")
    index = search.build_index(docs, "k", {"t": T.words(F.col("t"))})
    asked = spark.createDataFrame([(10, "port rue rue"), (11, "")], "q long, t string")
    terms = search.query_terms(asked, "q", T.words(F.col("t")))
    hits = {(r["q"], r["key"]): r["score"] for r in search.match(index, terms, "t").collect()}
    assert set(hits) == {(10, 1), (10, 2)}
    idf = lambda n: math.log(1 + (2 - n + 0.5) / (n + 0.5))
    assert hits[10, 2] == pytest.approx(idf(2) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 1 / 2)))
    assert search.zero_terms(asked, "q", terms, docs, "k").count() == 4
    both = search.boolean(must=[search.match(index, terms, "t")], filters=[spark.createDataFrame([(10, 2)], "q long, key long")])
    assert [r["key"] for r in both.collect()] == [2]


@pytest.mark.parametrize("metres, block", [(0, 50), (400_000, 50), (400_000, 100_000), (1_500_000, 30), (9_000_000, 100_000), (25_000_000, 40)])
def test_geo_cells_find_what_all_pairs_find(spark, metres, block):
    """Points all over, at the poles and the date line, and a third of all in one place."""
    rows = [(i, -90 + (i * 37 % 1801) / 10, -180 + (i * 113 % 3600) / 10) for i in range(200)] + [(200 + i, 48 + i % 10 / 100, 2 + i % 7 / 100) for i in range(120)]
    rows += [(400, 90.0, 0.0), (401, -90.0, 55.0), (402, 10.0, 180.0), (403, 10.0, -180.0), (404, 10.1, -179.9), (405, 9.9, 179.9), (406, 89.5, -100.0), (407, 0.0, -1e-18), (408, 0.0, 540.0)]
    ill = [(500, None, 1.0), (501, 1.0, None), (502, float("nan"), 1.0), (503, 1.0, float("inf")), (504, 91.0, 1.0)]
    points = spark.createDataFrame(rows + ill, "k long, lat double, lon double")
    a, b = points.where("k < 500").toDF("q", "a", "o"), points.where("k < 500").toDF("key", "b", "p")
    every = a.join(b).where(arrays.haversine(F.col("a"), F.col("o"), F.col("b"), F.col("p")) <= metres)
    inside = lambda df: sorted((r["q"], r["key"]) for r in df.select("q", "key").collect())
    assert inside(search.near(points, "k", points, "k", "lat", "lon", metres, block)) == inside(every)
    assert search.near(points.where("false"), "k", points, "k", "lat", "lon", metres, block).count() == 0


def test_features(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, []), (4, None)], "k int, w array<string>")
    assert {r["token"]: r["id"] for r in features.first_seen_vocabulary(docs, "k", F.col("w")).collect()} == {"a": 1, "b": 2}
    coded = features.encode(docs, "k", F.col("w"), spark.createDataFrame([("a", 5)], "token string, id long"), unknown=1)
    assert {r["k"]: r["ids"] for r in coded.collect()} == {1: [5, 1, 5], 2: [1], 3: [], 4: []}
    weights = features.tf_idf(docs, "k", F.col("w"))
    norm = {r["key"]: r["n"] for r in weights.groupBy("key").agg(F.sum(F.col("tfidf") ** 2).alias("n")).collect()}
    assert norm == {1: pytest.approx(1), 2: pytest.approx(1)}


def test_geocoding_rules(spark):
    rows = spark.createDataFrame(
        [("x", "7505", 0.9, "housenumber", 1.0, "housenumber"), ("a", "75056", 0.9, "housenumber", 1.0, "housenumber"), ("b", "75056", 0.5, "housenumber", 0.9, "housenumber"), ("c", "75056", 0.1, "street", 0.2, "town"), ("n", "75056", None, None, None, None)],
        "k string, commune string, a_score double, a_kind string, b_score double, b_kind string",
    ).withColumns({c: F.lit(1.0) for c in ("a_lat", "a_lon", "b_lat", "b_lon", "c_lat", "c_lon")})
    assert {r["k"]: r["rule"] for r in geocoding.decide(rows).collect()} == {"x": "no commune", "a": "a housenumber", "b": "b housenumber", "c": "centre", "n": "centre"}


def test_nested(spark):
    df = spark.createDataFrame([(1, (1, (2,)))], "k int, a struct<a: int, b: struct<c: int>>")
    assert nested.flatten(df).columns == ["k", "a_a", "a_b_c"]
    assert one(spark, nested.parse_list(F.col("c"), "int"), c="[1,2]") == [1, 2]
    assert one(spark, nested.parse_list(F.col("c"), "int"), c="nonsense") is None
    assert nested.merge_configuration({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}, {"A__C": 9}) == {"a": {"b": 3, "c": 9}}


def test_decisions_with_one_candidate(spark):
    top = spark.createDataFrame([("q", "k", 0.5, 2, 0.0, 0.7, 1)], "q string, key string, similarity double, nb long, activity double, final double, rank int")
    row = decisions.decision_features(top).first()
    assert (row["final_1"], row["final_2"], row["gap"]) == (0.7, 0.0, 0.7)


def test_import_and_append(spark):
    source, target = fresh_path(spark, "in"), fresh_path(spark, "out")
    spark.createDataFrame([("1.0", "[1.5,2]"), (None, "[]"), ("x", None)], "CABBI string, v string").write.option("sep", ";").option("header", True).csv(source)
    schema = tables.schema_of([("CABBI", "Int64"), ("V", "[float64]"), ("more", "object")])
    got = tables.import_table(spark, source, target, schema, "cabbi")
    assert [tuple(r) for r in got.collect()] == [(1, [1.5, 2.0], None)]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.import_table(spark, source, target, schema, "cabbi")
    keyed = fresh_path(spark, "keyed")
    tables.append_unique(spark.range(3), keyed, "id")
    with pytest.raises(ValueError, match="repeat"):
        tables.append_unique(spark.range(2, 4), keyed, "id")


#: Words and stems of the published sample of the Snowball rules for French.
STEMS = (
    "continua continu continuation continu continuel continuel continuellement continuel continuité continu continuons continuon contournait contourn contractions contract "
    "contradictoirement contradictoir contraindre contraindr maintenaient mainten maintien maintien maintint maintint mais mais maïs maï maîtresses maîtress majestueusement majestu "
    "majeure majeur majorités major malacca malacc maladive malad"
).split()


def test_french_stems(spark):
    from lexisift.functions import stemming

    for word, stem in zip(STEMS[::2], STEMS[1::2]):
        assert stemming.french_stem(word) == stem
    assert [stemming.french_stem(w) for w in ("", "s", "é", "aa", "quille", "joyeux")] == ["", "s", "é", "aa", "quill", "joyeux"]
    rows = [(["maladies", None, "maladies"],), ([],), (None,), (["majorité"],)]
    df = spark.createDataFrame(rows, "w array<string>").coalesce(1)
    got = [r[0] for r in df.select(stemming.each_word(F.col("w"), stemming.french_stem)).collect()]
    assert got == [["malad", None, "malad"], [], None, ["major"]]


def test_measures_in_blocks(spark):
    import numpy as np

    x = np.random.default_rng(2).normal(size=(50, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(50, None)], "k long, v array<double>")
    brute = {"euclidean": lambda a, b: np.linalg.norm(a - b), "manhattan": lambda a, b: np.abs(a - b).sum(), "chebyshev": lambda a, b: np.abs(a - b).max(), "dot": np.dot}
    for name, f in brute.items():
        got = vectors.measured(df.where("k < 3"), df, "k", "v", name, block=7).collect()
        assert len(got) == 3 * 51
        for r in got:
            assert r["value"] is None if r["k"] == 50 else abs(r["value"] - f(x[r["query_id"]], x[r["k"]])) < 1e-9
    assert vectors.pairwise(df.where("k < 50"), df.where("k < 50"), "k", "v", "dot").count() == 50 * 49 / 2
    assert vectors.measured(df.where("false"), df, "k", "v", "dot").count() == 0


def test_records_published_out_of_order(spark):
    from lexisift.sources.shared import fresh_path
    from lexisift.streaming import publication

    path, target = fresh_path(spark, "validated"), fresh_path(spark, "published")
    for rows in ([(1, 5), (2, 1)], [(1, 3), (3, 2)], [(2, 4)]):
        spark.createDataFrame(rows, "user long, published long").coalesce(1).write.mode("append").parquet(path)
    stream = publication.file_stream(spark, path, "user long, published long")
    publication.publish(stream, target, fresh_path(spark, "state"), "user").awaitTermination()
    assert spark.read.parquet(target).select("part").distinct().count() == 3
    got = {r["user"]: r["published"] for r in publication.latest(spark, target, "user").collect()}
    assert got == {1: 5, 2: 4, 3: 2}


def test_synonym_graph_takes_the_longest_run_from_the_left(spark):
    rules = {"a": ["x"], "a b": ["y z"], "a b c": ["q"], "c d": ["v", "w"], "b c": ["never after a b"]}
    cases = {"a b c d": [(0, 3, "q")], "a b d": [(0, 2, "y z")], "a a b": [(0, 1, "x"), (1, 2, "y z")], "b c d": [(0, 2, "never after a b")], "e c d": [(1, 2, "v"), (1, 2, "w")], "e": [], "": []}
    df = spark.createDataFrame([(t, t.split() or None if t else []) for t in cases] + [("null", None), ("holes", ["a", None, "b", "a"])], "t string, w array<string>")
    got = {r["t"]: r["g"] for r in df.select("t", analyzers.synonym_graph(F.col("w"), rules).alias("g")).collect()}
    for t, alternatives in cases.items():
        words = [(i, 1, w) for i, w in enumerate(t.split())]
        assert sorted(map(tuple, got[t])) == sorted(words + alternatives)
    assert got["null"] is None and sorted(map(tuple, got["holes"])) == [(0, 1, "a"), (0, 1, "x"), (2, 1, "b"), (3, 1, "a"), (3, 1, "x")]


def test_fragments_with_most_marks_first(spark):
    text = " ".join(["a"] * 20 + ["b"] * 5 + ["X"] + ["b"] * 14 + ["x", "X"] + ["c"] * 9)
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "none here"), (5, "x")], "k int, t string")
    got = {r["k"]: r["f"] for r in df.select("k", search.fragments(F.col("t"), ["x"]).alias("f")).collect()}
    assert [(f["marks"], f["at"]) for f in got[1]] == [(2, 40), (1, 20)] and got[1][0]["text"].startswith("<em>x</em> <em>X</em> c c")
    assert got[2] == got[4] == [] and got[3] is None and [tuple(f) for f in got[5]] == [(1, 0, "<em>x</em>")]


@pytest.mark.parametrize("k", [1, 3])
def test_best_by_equal_values_equals_all_pairs(spark, k):
    """Few values, so that groups are far larger than k; nulls equal nothing."""
    rows = [(i, i % 3 if i % 11 else None, "xy"[i % 2] if i % 13 else None) for i in range(120)]
    docs = spark.createDataFrame(rows, "k long, a long, b string")
    asked = docs.where("k % 9 = 0")
    text = spark.createDataFrame([(q, key, 0.5 + key % 4) for q in range(0, 120, 9) for key in range(q % 7, 120, 17)], "q long, key long, score double")
    found = search.boolean(should=[text, search.first_equals(asked, "k", docs, "k", [(F.col("a"), F.col("a")), (F.col("b"), F.col("b"))], k)])
    same = [(F.col(f"q_{c}") == F.col(c), n) for c, n in (("a", 2.0), ("b", 1.0))]
    fast = search.top(search.on_candidates(found, asked, "k", docs, "k", should=[(F.col("_score") > 0, 0.0), *same], minimum=1), k)
    slow = search.top(search.boolean(should=[text, search.term(asked, "k", docs, "k", [("a", "a")], 2.0), search.term(asked, "k", docs, "k", [("b", "b")], 1.0)]), k)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert search.first_equals(asked, "k", docs, "k", [(F.col("a"), F.col("a"))], k).groupBy("q").count().agg(F.max("count")).first()[0] <= k


def test_clauses_of_beginnings_list_all_pairs(spark):
    docs = spark.createDataFrame([(1, "abcd"), (2, "abce"), (3, "abd"), (4, None), (5, "")], "k long, c string")
    hits = lambda df: {(r["q"], r["key"]): r["score"] for r in df.where("q = 1").collect()}
    assert hits(search.prefix(docs, "k", "c", docs, "k", "c", 3, 2.0)) == {(1, 1): 2.0, (1, 2): 2.0}
    assert hits(search.graded_codes(docs, "k", "c", docs, "k", "c", {2: 1.0, 3: 2.0, 4: 4.0})) == {(1, 1): 7.0, (1, 2): 3.0, (1, 3): 1.0}


def test_pairs_are_made_after_their_join(spark):
    from lexisift.operators import relational

    few, many = spark.range(0, 5000).toDF("q"), spark.range(0, 300).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    found = relational.all_pairs(few, many, "k")
    assert found.columns == ["k", "s", "q"] and found.count() == found.distinct().count() == 5000 * 300
    assert "explode" in found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    grouped = relational.in_lists(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "g string, v int"), ["g"], "l")
    pairs = relational.with_lists(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, g string"), grouped, ["g"], "l", "k")
    assert sorted(map(tuple, pairs.collect())) == [(1, "a", 1), (1, "a", 2), (2, "b", 3)]


def test_passed_down_is_what_propagate_adds_to_children(spark):
    from lexisift.operators import tree

    nodes = spark.createDataFrame([("r", None), ("m", "r"), ("n", "m"), ("x", "n"), ("y", "m"), ("o", None)], "code string, parent string")
    scores = spark.createDataFrame([(q, c, float(q + i)) for q in (1, 2) for i, c in enumerate("rmno")], "q int, code string, score double")
    up = tree.ancestors(nodes)
    zero = scores.select("q").distinct().crossJoin(nodes.where("code IN ('x', 'y')").select("code")).selectExpr("q", "code", "0D AS score")
    want = {(r["q"], r["code"]): r["score"] for r in tree.propagate(scores.union(zero), up, "q", 0.3).collect()}
    more = {(r["q"], r["parent"]): r["more"] for r in tree.passed_down(scores, up, "q", 0.3).collect()}
    for q in (1, 2):
        assert abs(more[q, "n"] - want[q, "x"]) < 1e-12 and abs(more[q, "m"] - want[q, "y"]) < 1e-12


def test_rounded_is_what_sql_rounds_to(spark):
    import duckdb

    values = [0.0, 0.5e-6, 1.5e-6, 2.5e-6, -2.5e-6, 1234.5678905, 1234567.1234565, -0.1234564999, 9e15, 1e300, float("inf"), *[i * 0.00001234567 + i for i in range(-300, 300)]]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in [*values, None]], "v double").coalesce(1).select(scalars.rounded(F.col("v"))).collect()]
    assert got == [duckdb.execute("SELECT round(CAST(? AS DOUBLE), 6)", [v]).fetchone()[0] for v in values] + [None]
    assert str(spark.createDataFrame([(float("nan"),)], "v double").select(scalars.rounded(F.col("v"))).first()[0]) == "nan"


def test_lists_of_pairs_are_not_broadcast(spark):
    """Their copies for all blocks are much larger than Spark takes them for."""
    pairs = relational.all_pairs(spark.range(0, 50).toDF("q"), spark.range(0, 30).toDF("k"), "k")
    assert pairs.count() == 1500 and "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_candidate_pairs_are_made_of_lists(spark):
    from lexisift.plans import registry

    pairs = registry.queries()["J17_candidate_join"](spark, "/root/testdata/sf0.001")
    above = pairs._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "explode" in above and pairs.count() == pairs.distinct().count() > 0
