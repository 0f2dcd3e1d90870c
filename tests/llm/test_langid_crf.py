import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexisift.llm import langid_crf as L

EN, FR = "the quick brown fox jumps over that lazy dog with this thing", "le renard brun saute par dessus un chien paresseux avec cette chose"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 150), min_size=1, max_size=5), st.integers(2, 4), st.integers(0, 9))
def test_marginals_equal_plain_forward_backward(sizes, k, seed):
    random = np.random.default_rng(seed)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores, a, b = random.normal(size=(bounds[-1], k)) * 3, random.normal(size=(k, k)), random.normal(size=k)
    got = L.marginals(scores, bounds, a, b)
    for s, e in zip(bounds[:-1], bounds[1:]):
        n = e - s
        forward, backward = np.zeros((n, k)), np.ones((n, k))
        for t in range(n):
            forward[t] = np.exp(scores[s + t]) * (np.exp(b) if t == 0 else forward[t - 1] @ np.exp(a))
            forward[t] /= forward[t].sum()
        for t in range(n - 2, -1, -1):
            backward[t] = np.exp(a) @ (np.exp(scores[s + t + 1]) * backward[t + 1])
            backward[t] /= backward[t].sum()
        want = forward * backward
        if n:
            assert np.allclose(got[s:e], want / want.sum(axis=1, keepdims=True))


def test_pair_counts_equal_those_over_all_labellings():
    random = np.random.default_rng(3)
    n, k = 5, 3
    scores, a, b = random.normal(size=(n, k)) * 2, random.normal(size=(k, k)), random.normal(size=k)
    paths = np.stack(np.meshgrid(*[range(k)] * n, indexing="ij"), -1).reshape(-1, n)
    weight = np.exp(b[paths[:, 0]] + scores[np.arange(n), paths].sum(1) + a[paths[:, :-1], paths[:, 1:]].sum(1))
    want = np.zeros((k, k))
    np.add.at(want, (paths[:, :-1], paths[:, 1:]), np.broadcast_to((weight / weight.sum())[:, None], (len(paths), n - 1)))
    messages = L.forward_backward(scores, np.array([0, n]), a, b)
    assert np.allclose(L.pair_counts(scores, *messages, a, np.arange(1, n)), want)


def test_features_depend_on_the_word_alone():
    def cells(text):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, stops, _ = L.words_of(data, np.array([0, len(data)]))
        flat, at = L.word_features(data, starts, stops)
        return [sorted(flat[a:b].tolist()) for a, b in zip(at, [*at[1:], len(flat)])]

    assert cells("  Été x")[0] == cells("a été")[1] and cells("x yy")[0] == cells("yy x")[1] and cells("") == []
    data = np.frombuffer(b"abcd", np.uint8)  # two texts without a space between them
    starts, _, at = L.words_of(data, np.array([0, 2, 2, 4]))
    assert starts.tolist() == [0, 2] and at.tolist() == [0, 1, 1, 2]


@pytest.fixture(scope="module")
def model():
    random = np.random.default_rng(0)
    shuffled = lambda t: " ".join(random.permutation(t.split()))
    return L.fit([shuffled(EN) for _ in range(30)] + [shuffled(FR) for _ in range(30)], ["en"] * 30 + ["fr"] * 30)


def test_code_switched_text(spark, model):
    df = spark.createDataFrame([(1, f"{EN} {FR} {EN}"), (2, FR), (3, None), (4, ""), (5, "12 !!"), (6, EN + " " + FR * 2000)], "doc_id long, text string").selectExpr("*", "'old' AS Lang_Pred")
    got = {r["doc_id"]: r for r in L.identify(df, model, segments=True).collect()}
    n, m = len(EN.split()), len(FR.split())
    assert [tuple(s) for s in got[1]["segments"]] == [(0, n, "en"), (n, n + m, "fr"), (n + m, 2 * n + m, "en")]
    assert got[2]["lang_pred"] == "fr" and 0.5 < got[2]["score"] <= 1
    assert all((got[i]["lang_pred"], got[i]["score"], got[i]["segments"]) == ("und", 0.0, []) for i in (3, 4, 5))
    assert got[6]["lang_pred"] == "fr" and "Lang_Pred" not in L.identify(df, model).columns
    assert L.identify(df.where("false"), model).count() == 0


def test_no_and_one_language(spark):
    df = spark.createDataFrame([(1, "words here")], "doc_id long, text string")
    assert L.identify(df, L.fit([], [])).first()["lang_pred"] == "und"
    assert L.identify(df, L.fit(["some text"], ["xx"])).first()["lang_pred"] == "xx"


def test_held_out_accuracy(spark):
    rows = L.op8_langid_crf(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    kept = [r for r in rows if r["held_out"]]
    assert len(kept) > 100 and sum(r["lang_pred"] == r["lang"] for r in kept) / len(kept) >= 0.97


def test_query_with_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, None, "en"), (2, "", None), (None, "abc", None), (4, "the text", "en"), (4, "the text", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert L.op8_langid_crf(spark, str(tmp_path)).count() == 5


def test_language_of_long_texts_only_is_learned(spark):
    rows = [(i, EN, "en") for i in range(5)] + [(9, EN * 400, "en")] + [(10 + i, "12 " * 9000 + FR * (400 + i), "fr") for i in range(4)]
    texts, labels = L.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=3)
    assert sorted(labels) == ["en"] * 3 + ["fr"] * 3 and all(t == EN for t, x in zip(texts, labels) if x == "en")
    assert all(len(t) == L.LONGEST_TEXT and FR.startswith(t[:20]) for t, x in zip(texts, labels) if x == "fr")
