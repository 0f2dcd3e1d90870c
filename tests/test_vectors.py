"""Exact nearest neighbours by pivots, and oversampling by neighbours."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexisift.operators import relational, vectors

SCHEMA = "k long, v array<double>, g string"


def brute(asked, rows, k, metric, within):
    out = []
    for i, x, g in asked:
        scores = []
        for j, y, h in rows:
            if i == j or not x or not y or any(not math.isfinite(a) for a in [*x, *y]) or within and (g or "") != (h or ""):
                continue
            if metric == "cosine":
                n = math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(a * a for a in y))
                if n:
                    scores.append((-round(sum(a * b for a, b in zip(x, y, strict=True)) / n, 6), j))
            else:
                scores.append((round(math.dist(x, y), 6), j))
        out += [(i, j, abs(s) if metric != "cosine" else -s, r) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in df.collect())


def same(got, want):
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=1.1e-6)


def points(seed, n, clusters):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 6)) * 20
    x = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, 6)) if clusters else rng.normal(size=(n, 6))
    return [(i, [float(a) for a in row], random.Random(i).choice(["a", "b", None])) for i, row in enumerate(np.round(x, 3))]


@pytest.mark.parametrize(("metric", "within", "clusters"), [("cosine", None, 0), ("cosine", "g", 8), ("euclidean", None, 8), ("euclidean", "g", 0)])
def test_nearest_equals_brute_force(spark, metric, within, clusters):
    rows = points(clusters, 300, clusters)
    rows += [(400 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 5.0], "a") for i in range(60)]  # a common vector, over several blocks
    rows += [(500, None, "a"), (501, [0.0] * 6, "a"), (502, [float("nan")] * 6, "a"), (503, [float("inf")] * 6, "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(vectors.nearest(df, df, "k", "v", 4, metric=metric, within=within, cell=20, block=16)), brute(rows, rows, 4, metric, within))
    asked = [(900, rows[3][1], "a"), (901, [9.0, -9.0, 0.0, 1.0, 0.0, 0.0], "c"), (3, rows[3][1], rows[3][2])]
    same(found(vectors.nearest(spark.createDataFrame(asked, SCHEMA), df, "k", "v", 4, metric=metric, within=within, cell=20, block=16)), brute(asked, rows, 4, metric, within))


def test_chunks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_CHUNK", 16)
    rows = points(2, 200, 0)
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(vectors.nearest(df, df, "k", "v", 3, cell=50)), brute(rows, rows, 3, "cosine", None))


def test_vectors_of_clusters_are_sent_to_few_blocks(spark):
    for n in (400, 1600):
        rows = points(1, n, 10)
        df, copies = spark.createDataFrame(rows, SCHEMA), []
        same(found(vectors.nearest(df, df, "k", "v", 3, metric="euclidean", cell=20, copies=copies)), brute(rows, rows, 3, "euclidean", None))
        assert copies[0].count() < n * 12  # of 20 and 80 cells


def test_nothing_to_find(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0, 0.0], "a")], SCHEMA)
    for asked, there in ((none, none), (one, none), (none, one), (one, one)):
        assert vectors.nearest(asked, there, "k", "v", 3).collect() == []


def test_oversampled_points_lie_between_neighbours(spark):
    rng = random.Random(4)
    rows = [(i, "large", [rng.uniform(0, 9), rng.uniform(0, 9)]) for i in range(40)]
    rows += [(100 + i, "small", [rng.uniform(20, 29), rng.uniform(0, 9)]) for i in range(7)] + [(200, "single", [50.0, 50.0]), (300, None, [1.0, 1.0]), (301, "small", None)]
    df = spark.createDataFrame(rows, "k long, y string, x array<double>")
    found_rows = relational.oversample(df, "y", "k", "x", 3, seed=5).collect()
    assert sum(not r["synthetic"] for r in found_rows) == len(rows)
    made = [(r["y"], tuple(r["x"])) for r in found_rows if r["synthetic"]]
    want = []
    for label in ("small", "single"):
        own = [(k, x) for k, y, x in rows if y == label and x]
        order = sorted(own, key=lambda r: (r[0] * 7919 % 10007, r[0]))
        for at, (k, x) in enumerate(order):
            near = sorted((round(math.dist(x, o), 6), j) for j, o in own if j != k)[:3]
            for turn in range(1, (40 - len(own) - at - 1) // len(own) + 2):
                h = (k * 2654435761 + turn * 97003 + 5) % 1_000_003
                other = dict(own)[near[h % len(near)][1]] if near else x
                want.append((label, tuple(a + (b - a) * (h // 7 % 1000 / 1000) for a, b in zip(x, other, strict=True))))
    assert len(made) == 33 + 39
    assert [y for y, _ in sorted(made)] == [y for y, _ in sorted(want)]
    assert np.allclose(np.array([x for _, x in sorted(made)]), np.array([x for _, x in sorted(want)]))
    assert relational.oversample(df.where("false"), "y", "k", "x").collect() == []


@pytest.mark.parametrize("measure", [*vectors.MEASURES, "weighted"])
def test_tiles_of_pairs_have_the_values_of_single_pairs(spark, measure, monkeypatch):
    """Null, zero, empty and incomplete vectors, other lengths and repeated keys among them, over several tiles."""
    monkeypatch.setattr(vectors, "TILE", 7)
    monkeypatch.setattr(vectors, "TILE_QUERIES", 3)
    rng = np.random.default_rng(5)
    odd = [None, [], [1.0, None, 2.0], [0.0, 0.0, 0.0], [1.0], [1.0, 2.0, 3.0, 4.0], [float("inf"), 1.0, 0.0], [float("nan"), 1.0, 2.0]]
    rows = [(i // 2, v) for i, v in enumerate([x.tolist() for x in rng.normal(size=(30, 3))] + odd)]
    df = spark.createDataFrame(rows, "k long, v array<double>").repartition(3)
    weights = [1.0, 2.0, 3.0] if measure == "weighted" else None
    f = vectors.MEASURES[measure] if weights is None else lambda x, y: vectors.weighted_cosine(x, y, F.array(*[F.lit(w) for w in weights]))
    found = lambda m, **more: sorted((r[0], r[1], "none" if r[2] is None else str(r[2])) for r in vectors.measured(df.where("k % 3 = 0"), df, "k", "v", m, **more).withColumn("value", F.round("value", 9)).collect())
    assert found(measure if weights is None else "cosine", weights=weights) == found(f)


def test_pairs_by_name_are_not_compared_in_rows(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "k long, v array<double>")
    plan = vectors.measured(df, df, "k", "v", "cosine")._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "Join" not in plan


def test_scores_that_others_reach_are_not_handed_on(spark):
    """Only what comes up to the score that k others have is found in the other blocks, and not in the query's home."""
    there = spark.createDataFrame([(0, "", i, [math.cos(i / 10), math.sin(i / 10)], i % 2) for i in range(10)], "block int, kind string, key long, v array<double>, part int")
    asked = [(0, "", 100, [1.0, 0.0], None, 1, 0.9), (0, "", 101, [1.0, 0.0], [1], 0, 0.9), (0, "", 102, [1.0, 0.0], None, -1, None)]
    sent = spark.createDataFrame(asked, "block int, kind string, key long, v array<double>, parts array<int>, home int, reached double")
    got = {r["key"]: [n["key"] for n in r["near"]] for r in vectors._searched(sent, there, None, 4, 6, "cosine").collect()}
    assert got == {100: [0, 2, 4], 101: [1, 3], 102: [0, 1, 2, 3]}


def test_single_precision_decides_no_rank(spark):
    """Near copies, whose scores differ in the sixth digit."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 16))
    rows = [(i, [float(v) for v in base[i % 6] + rng.normal(size=16) * 2e-3], "x") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(vectors.nearest(df, df, "k", "v", 5, cell=50, block=64)), brute(rows, rows, 5, "cosine", None))
