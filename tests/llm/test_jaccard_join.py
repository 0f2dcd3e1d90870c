import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexisift.llm import components, jaccard_join, shingles

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    w = SPLIT.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    return {k: (len(sets[i]), min(rows[j][0] for j in range(len(rows)) if find(j) == find(i))) for i, (k, _) in enumerate(rows)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\nç\x0b", max_size=40), min_size=1, max_size=8))
def test_set_sizes(texts):
    column = pa.array([None, *texts])
    got = shingles.shingle_sets(*shingles.text_buffer(column.slice(1)))
    assert [len(s) for s in got] == [len(brute_set(t)) for t in texts]
    same = [[bytes(a) == bytes(b) for b in got] for a in got]
    assert same == [[brute_set(a) == brute_set(b) for b in texts] for a in texts]


def family(random, size, members, edits, first):
    words = [f"w{random.integers(0, 5000)}" for _ in range(size)]
    for i in range(members):
        own = list(words)
        for at in random.integers(0, size, edits):
            own[at] = f"x{random.integers(0, 10**9)}"
        yield first + i, " ".join(own)


def corpus():
    random = np.random.default_rng(11)
    rows = [*family(random, 80, 40, 2, 0), *family(random, 300, 25, 6, 100), *family(random, 60, 30, 1, 200)]
    shared = " ".join(f"passage{i}" for i in range(60))
    rows += [(300 + i, shared + " " + " ".join(f"o{random.integers(0, 10**9)}" for _ in range(25))) for i in range(40)]
    rows += [(400 + i, "same text for all of these rows here") for i in range(30)] + [(500, None), (501, ""), (502, " \n"), (503, "two words"), (504, "TWO words"), (505, "one"), (506, "é É")]
    # a chain: each links with the next, the ends don't
    words = [f"c{i}" for i in range(140)]
    rows += [(600 + i, " ".join(words[i * 4 : i * 4 + 100])) for i in range(8)]
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS digest").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "PAIRWISE", 3)
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_null_and_repeated_keys_and_empty_table(spark):
    text = "five words make one shingle"
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (2, text), (9, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [("2", 1, 2), ("3", 1, 2), ("3", 1, 2), ("9", 0, 9), ("None", 1, None)]
    assert jaccard_join.near_duplicates(df.where("false")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=20), min_size=1, max_size=12))
def test_t_occurrence(sets):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    linked = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert sorted(jaccard_join.t_occurrence(arrays)) == linked


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 15), max_size=12), min_size=1, max_size=9), st.integers(1, 6))
def test_heap_merge_counts_all_that_reach_the_least(sets, least):
    lists = jaccard_join.InvertedLists([np.array(sorted(s), dtype=np.uint64) for s in sets])
    got = dict(lists.merge(list(zip(lists.begins.tolist(), lists.ends.tolist())), least))
    assert got == {i: len(s) for i, s in enumerate(sets) if len(s) >= least}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.sets(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 60))
def test_sets_that_link_share_enough_short_lists(base, more, cut):
    a, b = sorted(base), sorted(set(sorted(base)[cut:]) | more)
    both = len(set(a) & set(b))
    if b and 100 * both >= 75 * (len(a) + len(b) - both):
        first = [set(x[: len(x) - jaccard_join.least_overlap(len(x)) + int(jaccard_join.least_lists(len(x)))]) for x in (a, b)]
        assert len(first[0] & first[1]) >= jaccard_join.least_lists(min(len(a), len(b)))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=90), st.sets(st.integers(0, 2**64 - 1), max_size=6), st.integers(0, 30))
def test_bitmaps_never_drop_a_link(base, more, cut):
    a, b = np.array(sorted(base), np.uint64), np.array(sorted(set(sorted(base)[: max(1, len(base) - cut)]) | more), np.uint64)
    both = len(np.intersect1d(a, b))
    links = 100 * both >= 75 * (len(a) + len(b) - both)
    found = jaccard_join.Bitmaps([jaccard_join.parity_bitmap(a), jaccard_join.parity_bitmap(b)]).test(np.array([0]), np.array([1]), np.array([len(a), len(b)]), 75)
    assert found[0] or not links


@pytest.mark.parametrize("n", [1, 2, 9, 200])
def test_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(n)], "a long, b long")
    nodes = {i * 7919 % 1009 for i in range(n + 1)}
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {x: min(nodes) for x in nodes}


def test_long_lists_in_blocks_of_distinct_sets(spark, monkeypatch):
    """Documents of one template that do not link, and copies: no list has more than two blocks, results are exact."""
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 8)
    random = np.random.default_rng(3)
    common = " ".join(f"c{i}" for i in range(80))
    rows = [(i, common + " " + " ".join(f"o{i // 2 if i < 30 else i}x{j}" for j in range(20)) + " e" * (i % 2)) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(200)]
    df = spark.createDataFrame([rows[i] for i in random.permutation(len(rows)).tolist()], "doc_id long, text string")
    seen = []
    real = jaccard_join.prefix_lists
    monkeypatch.setattr(jaccard_join, "prefix_lists", lambda reps: seen.append(real(reps)) or seen[0])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == brute(rows)
    sizes = [r["count"] for r in seen[0].groupBy("h").count().collect()]
    assert 8 < max(sizes) < 40


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=25), st.integers(1, 4))
def test_lists_of_several_sets_stream(spark, rows, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    df = spark.createDataFrame([(h, d, 1) for h, d in rows], "h long, d long, n int").coalesce(1)
    got = sorted((r["h"], r["d"]) for r in jaccard_join.of_several_sets(df).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert got == sorted(x for x in set(rows) if sum(y[0] == x[0] for y in set(rows)) > 1)
