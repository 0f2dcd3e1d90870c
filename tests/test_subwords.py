"""Subword classes against a plain version in one process, and on texts that weren't learned."""

import math
import zlib

import numpy as np
import pytest

from lexisift.operators import subwords as S

MASK = (1 << 64) - 1


def plain_buckets(text, lengths, bits):
    counts = {}
    for word in (text or "").lower().split():
        marked = f"<{word}>"
        for gram in [marked[i : i + n] for n in lengths for i in range(len(marked) - n + 1)] + [marked]:
            h = 0
            for c in gram:
                h = (h * 1_000_003 + ord(c)) & MASK
            b = (h * 0x9E3779B97F4A7C15 & MASK) >> (64 - bits)
            counts[b] = counts.get(b, 0) + 1
    norm = math.sqrt(sum(n * n for n in counts.values()))
    return {b: n / norm for b, n in sorted(counts.items())}


def plain_training(rows, labels, features, rounds, shard_rows, batch, rate):
    """Weights {(bucket, label): weight} by plain loops."""
    rows = [(k, labels.index(y), plain_buckets(t, features.lengths, features.bits)) for k, t, y in rows if t is not None and y is not None and t.split()]
    shards = -(-len(rows) // shard_rows)
    w = {}
    for turn in range(rounds):
        total = {}
        for s in range(shards):
            own, mine = dict(w), sorted(r for r in rows if zlib.crc32(str(r[0]).encode()) % shards == s)
            for at in range(0, len(mine), batch):
                group, changes = mine[at : at + batch], []
                for _, y, x in group:
                    z = [sum(v * own.get((b, c), 0.0) for b, v in x.items()) for c in range(len(labels))]
                    e = [math.exp(v - max(z)) for v in z]
                    changes.append((x, [v / sum(e) - (c == y) for c, v in enumerate(e)]))
                for x, errors in changes:
                    for b, v in x.items():
                        for c, e in enumerate(errors):
                            own[b, c] = own.get((b, c), 0.0) - rate / (1 + turn) / len(group) * v * e
            for cell, v in own.items():
                total[cell] = total.get(cell, 0.0) + (v - w.get(cell, 0.0)) * len(mine)
        for cell, d in total.items():
            w[cell] = w.get(cell, 0.0) + d / len(rows)
    return w


TEXTS = ["", "a", "Ab ab  AB", "boulangerie pâtisserie", "é\U0001f600 x", "un mot tres long " + "z" * 400]


@pytest.mark.parametrize("text", [None, *TEXTS])
def test_buckets(text):
    ids, values = S.buckets_of(text, S.Features((2, 3), 10))
    assert dict(zip(ids.tolist(), values.tolist(), strict=True)) == pytest.approx(plain_buckets(text, (2, 3), 10))


ROWS = [(i, f"{'pain four farine' if i % 3 == 0 else 'camion route fret' if i % 3 == 1 else 'ecole classe cours'} {i % 7} mot{i % 5}", "abc"[i % 3]) for i in range(60)] + [(100, None, "a"), (101, "texte", None), (102, "  ", "b")]


def test_training_equals_one_process(spark):
    features, args = S.Features((2, 3), 8), {"rounds": 2, "shard_rows": 20, "batch": 4, "rate": 2.0}
    df = spark.createDataFrame(ROWS, "k long, t string, y string")
    model = S.train(df.repartition(5), "k", "t", "y", features, **args)
    expected = np.zeros_like(model.weights)
    for (b, c), v in plain_training(ROWS, ["a", "b", "c"], features, **args).items():
        expected[b, c] = v
    assert model.labels == ["a", "b", "c"]
    assert np.abs(model.weights - expected).max() < 1e-5
    again = S.train(df.repartition(2), "k", "t", "y", features, **args)
    assert (again.weights == model.weights).all()


def test_classes(spark):
    df = spark.createDataFrame(ROWS, "k long, t string, y string").selectExpr("k", "t", "y", "1 AS label", "2 AS score", "3 AS text")
    model = S.train(df.where("k % 2 = 0"), "k", "t", "y", S.Features(bits=10), rounds=2)
    found = {r.k: r for r in S.classify(df, "k", "t", model).collect()}
    assert all(found[k].label == y for k, t, y in ROWS if k < 100)
    assert (found[100].label, found[100].score) == (None, 0.0) == (found[102].label, found[102].score)


def test_empty(spark):
    empty = spark.createDataFrame([], "k long, t string, y string")
    model = S.train(empty, "k", "t", "y")
    assert model.labels == []
    assert S.classify(empty, "k", "t", model).collect() == []
    with pytest.raises(ValueError):
        S.train(spark.createDataFrame(ROWS, "k long, t string, y string"), "k", "t", "y", most_labels=2)


def test_languages_that_were_not_learned(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    learned = documents.where("crc32(CAST(doc_id AS STRING)) % 4 <> 2")
    model = S.train(learned, "doc_id", "text", "lang", shard_rows=200)
    rest = documents.where("crc32(CAST(doc_id AS STRING)) % 4 = 2")
    found = S.classify(rest, "doc_id", "text", model).join(rest.select("doc_id", "lang"), "doc_id")
    good = found.selectExpr("avg(CASE WHEN label = lang THEN 1e0 ELSE 0e0 END)").first()[0]
    print("accuracy", good)
    assert good > 0.9
