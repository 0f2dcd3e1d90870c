import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexisift.llm import piecewise_hash as P


def rolled(data):
    out = []
    for i in range(len(data)):
        h = 0
        for j in range(7):
            c = data[i - j] if i >= j else 0
            h = ((h ^ (c << (5 * j % 32) & 0xFFFFFFFF)) + c * (2 * (7 - j) + 1)) & 0xFFFFFFFF
        out.append((h + 1) * P.TURN % 2**64 >> 34)
    return out


def brute(text):
    data = text.encode("utf-8", "surrogatepass")
    mixed, size = rolled(data), 3
    while sum(m % size == 0 for m in mixed) > 64:
        size *= 2

    def signature(size):
        stops, out, start = [i + 1 for i, m in enumerate(mixed) if m % size == 0], "", 0
        for end in stops + [len(data)] * (bool(data) and stops[-1:] != [len(data)]):
            h = sum((c + 1) * pow(P.RATIO, j, 2**64) for j, c in enumerate(data[start:end])) % 2**64
            out += chr(P.ALPHABET[((h ^ h >> 31) * P.MIX % 2**64) >> 58])
            start = end
        return out

    return f"{size}:{signature(size)}:{signature(2 * size)}"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijé", k=rng.randrange(2, 9))) for _ in range(n))


TEXTS = ["", "a", "é", "aaaa" * 500, "\x00" * 90, "ab" * 2000, *[words(random.Random(i), 3**i) for i in range(1, 7)]]


@pytest.mark.parametrize("block", [97, 1 << 20])
def test_fingerprints_against_brute_force(monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "_powers", [])
    found = P.fingerprints(TEXTS)
    assert found == [brute(t) for t in TEXTS]
    assert P.fingerprints(TEXTS[::-1]) == found[::-1] and [P.fingerprints([t])[0] for t in TEXTS] == found
    assert all(len(f.split(":")[1]) <= 65 for f in found)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i, *row[1:]] if (old := row) is None else [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


def alike(a, b):
    one = lambda x, y: 1 - distance(x, y) / max(len(x), len(y)) if x or y else 1.0
    (s, a1, a2), (t, b1, b2) = a.split(":"), b.split(":")
    s, t = int(s), int(t)
    return max(one(a1, b1), one(a2, b2)) if s == t else one(a1, b2) if s == 2 * t else one(a2, b1) if t == 2 * s else 0.0


def test_next_documents_and_edits_over_partitions(spark):
    rng = random.Random(1)
    docs = [(i * 7 % 101, rng.choice([words(rng, 60), words(rng, 400), "", "short", None, "é🙂" * 9])) for i in range(60)] + [(500, words(rng, 30_000))]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, part string").repartition(7)
    found = {r["doc_id"]: r for r in P.with_next(df).collect()}
    assert len(found) == len(docs)
    ordered = sorted((i, t or "") for i, t in docs)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        n = len(text) // 4
        made, r = text[: len(text) - n] + following[:n], found[i]
        own = brute(text) if len(text) < 5000 else P.fingerprints([text])[0]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), hashlib.sha256(made.encode()).hexdigest(), own, P.fingerprints([made])[0])
        assert r["near_edited"] == pytest.approx(alike(own, r["edited_fingerprint"])) and r["near_next"] == pytest.approx(alike(own, P.fingerprints([following])[0]))


def test_near_copies_are_alike_and_others_are_not(spark):
    rng = random.Random(5)
    text = words(rng, 800)
    pairs = [(text, text), (text, text[:1000] + "changed" + text[1010:]), (text, words(rng, 800)), (text, words(rng, 20))]
    rows = [(n, *P.fingerprints(p)) for n, p in enumerate(pairs)]
    same, near, other, short = [r[0] for r in spark.createDataFrame(rows, "n int, a string, b string").orderBy("n").select(P.likeness(F.col("a"), F.col("b"))).collect()]
    assert same == 1 and near > 0.9 and other < 0.3 and short < 0.3


def test_repeated_ids_one_row_and_no_rows(spark):
    schema = "doc_id long, text string"
    rows = [(1, "a" * 40), (1, "a" * 40), (1, None), (None, "tail"), (None, None)]
    found = P.with_next(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in found) == [(0, 0), (0, 4), (1, 0), (1, 40), (1, 40)]
    (one,) = P.with_next(spark.createDataFrame([(3, "own next")], schema)).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"own neow").hexdigest()
    assert P.with_next(spark.createDataFrame([], schema)).collect() == []
