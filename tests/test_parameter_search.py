"""Successive halving over coefficients against the full grid."""

import random

from lexisift.operators import decisions

SCHEMA = "q long, c array<struct<similarity: double, found: double, activity: double, key: long, right: boolean>>"
GRID = [(b / 4, g / 4) for b in range(4) for g in range(4)]


def brute(lists, b, g):
    hits = 0
    for _, c in lists:
        if c:
            hits += max(c, key=lambda x: (x[0] + b * x[1] + g * x[2], -x[3]))[4]
    return hits


def lists(n, seed=1):
    """The right candidate is the best by 0.5 and 0.25 in most lists."""
    rng = random.Random(seed)
    out = []
    for q in range(n):
        c = [(rng.random(), rng.random(), rng.random(), k) for k in range(6)]
        best = max(c, key=lambda x: x[0] + 0.5 * x[1] + 0.25 * x[2]) if rng.random() < 0.9 else rng.choice(c)
        out.append((q, [(*x, x is best) for x in c]))
    return out


def test_all_pairs_in_one_pass(spark):
    rows = [*lists(40), (100, []), (101, None), (102, [(1.0, 0.0, 0.0, 2, True), (1.0, 0.0, 0.0, 1, False)])]
    assert decisions.grid_hits(spark.createDataFrame(rows, SCHEMA), "c", GRID) == [brute(rows, b, g) for b, g in GRID]
    assert decisions.grid_hits(spark.createDataFrame([], SCHEMA), "c", GRID) == [0] * len(GRID)


def test_halving_finds_the_best_pair_of_the_full_grid(spark):
    rows = lists(320)
    full = sorted(((b, g, brute(rows, b, g)) for b, g in GRID), key=lambda x: (-x[2], x[0], x[1]))
    found = decisions.halving_search(spark.createDataFrame(rows, SCHEMA), "q", "c", GRID[::-1], rungs=2, eta=4)
    assert found[0] == full[0] and len(found) == 4 and all(x in full for x in found)
    assert decisions.halving_search(spark.createDataFrame(rows, SCHEMA), "q", "c", GRID, rungs=1) == full
