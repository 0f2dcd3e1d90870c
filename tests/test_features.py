"""Phrases in texts, overlap joins and exact quantiles against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexisift.functions import text as T
from lexisift.operators import features, metrics


def joined(words, pairs):
    out, i = [], 0
    while i < len(words):
        if i + 1 < len(words) and (words[i], words[i + 1]) in pairs:
            out.append(f"{words[i]}_{words[i + 1]}")
            i += 2
        else:
            out.append(words[i])
            i += 1
    return " ".join(out)


def test_phrases_are_joined_from_left_to_right(spark):
    rng = random.Random(2)
    texts = ["", None, "a", "a a", "a a a a a", "new york city hall", "x new york", "a b a b a b c", *[" ".join(rng.choices("abcd", k=rng.randrange(1, 40))) for _ in range(30)], " ".join(["a"] * 4001)]
    pairs = {("a", "a"), ("new", "york"), ("york", "city"), ("city", "hall"), ("b", "a"), ("a", "b"), ("c", "d")}
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "k long, t string, at string").repartition(3)
    of = spark.createDataFrame(sorted(pairs), "first string, second string")
    got = {r["k"]: r["out"] for r in features.with_phrases(df, "k", T.words(F.col("t")), of, "out").collect()}
    assert got == {i: None if t is None else joined(t.split(), pairs) for i, t in enumerate(texts)}
    assert features.with_phrases(df.where("false"), "k", T.words(F.col("t")), of, "out").collect() == []


def test_counts_of_pairs_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, "b"), (3, ""), (4, None), (5, "b a")], "k long, t string")
    assert {(r["first"], r["second"]): r["n"] for r in features.bigrams(df, "k", T.words(F.col("t"))).collect()} == {("a", "b"): 2, ("b", "a"): 2}
    scores = {(r["first"], r["second"]): r["score"] for r in features.phrases(df, "k", T.words(F.col("t")), 1, 0.1).collect()}
    assert scores == pytest.approx({("a", "b"): (2 - 1) * 4 / (3 * 4), ("b", "a"): (2 - 1) * 4 / (3 * 4)})


@pytest.mark.parametrize("least", [0.3, 0.75, 1.0])
def test_overlap_join(spark, least):
    rng = random.Random(6)
    lists = lambda n: [[rng.choice("aaaabcdefgh") for _ in range(rng.randrange(7))] for _ in range(n)]
    a, b = lists(40), lists(30)
    table = lambda rows: spark.createDataFrame(list(enumerate(rows)), "k long, x array<string>")
    found = features.overlap_join(table(a), "k", F.col("x"), table(b), "k", F.col("x"), least)
    got = {(r["a"], r["b"]): round(r["overlap"], 9) for r in found.collect()}
    want = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if y and (o := sum((Counter(x) & Counter(y)).values()) / len(y)) >= least - 1e-9:
                want[i, j] = round(o, 9)
    assert got == want and "CartesianProduct" not in found._jdf.queryExecution().toString() and "BroadcastNestedLoop" not in found._jdf.queryExecution().toString()


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(metrics, "FETCHED", 20)
    rng = np.random.default_rng(3)
    for values in (list(rng.normal(size=3000)), [1.0] * 500, [1.0] * 400 + [2.0] * 401, list(np.exp(rng.normal(size=900) * 9)), [5.0] * 900 + list(rng.normal(size=300)), [7.0], [0.0, 1.0], list(range(100)) + [50] * 900):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
        at = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.951, "e": 1.0}
        got = metrics.exact_quantiles(df, "v", at)
        assert [got[n] for n in at] == pytest.approx([float(np.quantile(values, p)) for p in at.values()], rel=1e-12)
    assert metrics.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", {"a": 0.5}) == {"a": None}


def test_equal_items_are_compared_once(spark):
    """Many copies give all their pairs, from classes: no pair of keys is shuffled."""
    a = spark.createDataFrame([(i, ["x", "y", f"z{i % 2}"]) for i in range(300)], "k long, x array<string>")
    b = spark.createDataFrame([(i, ["y", "x"]) for i in range(40)], "k long, x array<string>")
    found = features.overlap_join(a, "k", F.col("x"), b, "k", F.col("x"), 1.0)
    assert found.count() == found.distinct().count() == 300 * 40
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and plan.lstrip().startswith("Project") and "explode" in plan.split("Join")[0]


def test_overlaps_are_counted_and_rounded_before_keys_are_put_in(spark, tmp_path):
    from lexisift.plans import registry

    names = [("customer", "c", [f"Customer#{i:05d}" for i in range(30)] * 4), ("supplier", "s", [f"Supplier#{i:05d}" for i in range(20)] * 3)]
    for table, c, rows in names:
        spark.createDataFrame(list(enumerate(rows)), f"{c}_{'cust' if c == 'c' else 'supp'}key long, {c}_name string").write.parquet(f"{tmp_path}/{table}.parquet")
    found = registry.queries()["V13_overlap_join"](spark, str(tmp_path))
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "explode" in above and "round(" not in above
    grams = lambda w: Counter(w[i : i + 3] for i in range(len(w) - 2))
    want = {}
    for i, x in enumerate(names[0][2]):
        for j, y in enumerate(names[1][2]):
            if (o := (grams(x) & grams(y)).total() / grams(y).total()) >= 0.5:
                want[i, j] = round(o, 6)
    assert want and {(r[0], r[1]): r[2] for r in found.collect()} == pytest.approx(want)


def test_tiles_of_overlaps_give_each_pair_once(spark, monkeypatch):
    """Tiles and chunks of a few multisets, with null items, which overlap with nothing."""
    monkeypatch.setattr(features, "OVERLAP_CHUNK", 3)
    rng = random.Random(8)
    a, b = ([[rng.choice(["a", "b", "c", None]) for _ in range(rng.randrange(5))] for _ in range(n)] for n in (400, 12))
    table = lambda rows: spark.createDataFrame(list(enumerate(rows)), "k long, x array<string>")
    got = [(r["a"], r["b"], r["overlap"]) for r in features.overlap_join(table(a), "k", F.col("x"), table(b), "k", F.col("x"), 0.5).collect()]
    shared = lambda x, y: sum((Counter(v for v in x if v) & Counter(v for v in y if v)).values())
    assert sorted(got) == sorted((i, j, shared(x, y) / len(y)) for i, x in enumerate(a) for j, y in enumerate(b) if y and shared(x, y) / len(y) >= 0.5)
