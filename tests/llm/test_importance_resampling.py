import hashlib
import math
import random
import re
import zlib

import pytest

from lexisift.llm import importance_resampling as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, target, buckets, longest, least, percent):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    drawn = sorted([r for r in rows if r[4] >= least], key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = drawn[: percent * len(drawn) // 100]
    return [tuple(r[:4]) for r in rows], [(n, r[0], r[3]) for n, r in enumerate(drawn, 1)]


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["Alpha", "béta", "gamma7", "Δelta", "ÉTÉ", "x", "ß", "日本", "İ"]
    text = lambda: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randrange(12)))
    return [(i, text()) for i in range(n)]


@pytest.mark.parametrize("longest", [1, 3])
def test_against_brute_force(spark, longest):
    docs = corpus(120, longest) + [(500, None), (501, ""), (None, "alpha beta gamma delta"), (502, "x " * 30_000), (7, "alpha alpha x"), (7, "alpha alpha x")]
    target = ["alpha béta alpha", None, "", "gamma7 x"]
    rows, drawn = brute(docs, target, 50, longest, 2, 25)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, rank int, key string").repartition(5)
    found = I.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), buckets=50, longest=longest, least_words=2, percent=25).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:4] for r in found], key=order) == sorted(rows, key=order)
    assert sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["rank"]) == drawn


@pytest.mark.parametrize("cuts", [1, 2, 15])
def test_cutoff_takes_exactly_n_whatever_ties(spark, cuts):
    rng = random.Random(cuts)
    values = [(rng.choice([-(2**40), 3, 3, 3, 4, 9]), rng.choice([1, 1, 2]), i) for i in range(40)]
    df = spark.createDataFrame(values, "a long, b long, c long")
    for n in (1, 7, 20, 39, 40):
        cut = I.cutoff(df, ["a", "b", "c"], n, cuts)
        assert sorted(map(tuple, df.where(I._before(["a", "b", "c"], cut)).collect())) == sorted(values)[:n]


def test_repeated_rows_are_drawn_up_to_the_exact_number(spark):
    df = spark.createDataFrame([(1, "a b c")] * 30, "doc_id long, text string").repartition(4)
    found = I.resample(df, df, least_words=1).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3] and len({r["score"] for r in found}) == 1


def test_empty_tables_and_nothing_to_draw(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert I.resample(none, some).collect() == []
    found = I.resample(some, none).collect()
    assert [r["rank"] for r in found] == [None, None] and {r["n_features"] for r in found} == {0, 2}
