import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexisift.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def check(rows, pieces, tokenizer, window):
    want = {k: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for k, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(want)
    for k, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(want[k])
            assert p["ids_crc32"] == zlib.crc32(want[k][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(want[k])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    return by_sequence


ROWS = [(i, " ".join(f"word{(i * j) % 50}" for j in range(i * 9 % 260))) for i in range(60)] + [(100, None), (101, ""), (102, "<|endoftext|>"), (103, "z" * 9000)]


@pytest.mark.parametrize("window", [64, 1024])
def test_pieces(spark, tokenizer, window):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' AS shard", "1 AS length")
    pieces = packing.pack(df, window=window).collect()
    sequences = check(ROWS, pieces, tokenizer, window)
    assert sum(sum(p["length"] for p in own) < window for own in sequences.values()) <= 1  # one shard, one rest


def test_many_shards_and_ids(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 5)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    pieces = packing.pack(df, window=128)
    check(ROWS, pieces.collect(), tokenizer, 128)
    whole = packing.sequence_ids(df, pieces)
    sizes = {r["sequence_id"]: r["n"] for r in pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r["sequence_id"]: len(r["ids_le"]) // 4 for r in whole.collect()} == sizes


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    pieces = packing.pack(df).collect()
    assert len({p["sequence_id"] for p in pieces}) == 1 and sorted(p["offset"] for p in pieces) == [0, 4, 8]
    assert packing.pack(df.where("false")).count() == 0


def test_scores_are_bm25_and_neighbours_come_first():
    terms = [np.array(x, "<u2") for x in ([1, 2, 3], [1, 9], [2, 3], [7], [1, 2, 3, 8])]
    counts = [np.array(x, "<u2") for x in ([1, 2, 1], [3, 1], [1, 1], [5], [1, 1, 1, 1])]
    idf = np.linspace(0.1, 2, 1 << 16)
    index = packing.ShardIndex(terms, counts, idf, 4.0)
    for q in range(5):
        for d in range(5):
            length = counts[d].sum()
            want = sum(idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * length / 4.0)) for t, c in zip(terms[d], counts[d]) if t in terms[q])
            assert index.scores(q)[d] == pytest.approx(want)
    best = np.argsort(-index.scores(0)[1:], kind="stable")[0] + 1
    assert packing.fill_windows(np.array([50, 10, 10, 10, 10]), index, 60)[0] == [(0, 0, 50), (best, 0, 10)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=30))
def test_windows_are_full_but_the_last(lengths):
    index = packing.ShardIndex([np.array([i % 5 + 1], "<u2") for i in range(len(lengths))], [np.array([1], "<u2")] * len(lengths), np.ones(1 << 16), 1.0)
    made = packing.fill_windows(np.array(lengths), index, 64)
    assert [sum(n for _, _, n in w) for w in made][:-1] == [64] * (len(made) - 1)
    for d, n in enumerate(lengths):
        own = sorted((b, k) for w in made for x, b, k in w if x == d)
        assert [b for b, _ in own] == [sum(k for _, k in own[:i]) for i in range(len(own))] and sum(k for _, k in own) == n


def test_neighbours_are_retrieved_over_many_shards(spark, monkeypatch):
    """The nearest documents by brute-force BM25 over all are in a document's shard, whatever their row."""
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 32)
    random = np.random.default_rng(1)
    terms, counts = [], []
    for i in range(1024):  # 32 topics of 40 terms of their own, and terms of all
        own = np.concatenate([random.choice(40, 20, replace=False) + 1000 + 40 * (i % 32), random.choice(400, 30, replace=False) + 1])
        terms.append(np.sort(own).astype("<u2"))
        counts.append(np.ones(50, "<u4"))
    terms += [terms[0]] * 300  # copies don't fill one shard
    counts += [counts[0]] * 300
    n = np.bincount(np.concatenate(terms), minlength=1 << 16)
    idf = np.log(1 + (len(terms) - n + 0.5) / (n + 0.5))
    df = spark.createDataFrame([(i, bytearray(t.tobytes()), bytearray(c.tobytes())) for i, (t, c) in enumerate(zip(terms, counts))], "row long, terms binary, counts binary")
    got = {r["row"]: r["shard"] for r in packing.deal(df, spark.sparkContext.broadcast(idf), 50.0, len(terms)).collect()}
    shard = np.array([got[i] for i in range(len(terms))])
    index = packing.ShardIndex(terms, counts, idf, 50.0)
    near = [shard[np.argsort(-index.scores(q)[:1024], kind="stable")[1:6]] == shard[q] for q in range(1, 300)]
    assert np.mean(near) > 0.4 and np.bincount(shard).max() <= 4 * 32


def test_windows_hold_neighbours_more_often_than_random_ones(spark, monkeypatch):
    """Documents of one topic meet in windows far more often than by chance, over several shards."""
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 64)
    random = np.random.default_rng(4)
    words = [[f"{chr(97 + t)}{chr(97 + i % 26)}{chr(97 + i // 26)}zq" for i in range(60)] for t in range(16)]
    rows = [(i, " ".join(random.choice(words[i % 16], 30))) for i in range(480)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), window=512).collect()
    together: dict = {}
    for p in pieces:
        together.setdefault(p["sequence_id"], set()).add(p["doc_id"])
    same = [a % 16 == b % 16 for own in together.values() for a in own for b in own if a < b]
    assert np.mean(same) > 0.4  # 1 / 16 by chance


def test_query(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    sequences = check(rows, packing.op6_retrieval_packing(spark, folder).collect(), tokenizer, 1024)
    filled = sum(p["length"] for own in sequences.values() for p in own)
    assert filled >= 0.95 * 1024 * len(sequences)


def test_counts_beyond_two_bytes(spark, tokenizer):
    rows = [(1, "a" + " a" * 70_000), (2, "b")]
    check(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), tokenizer, 1024)
