"""The deletion index against all pairs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexisift.functions import text as T
from lexisift.operators import fuzzy, search


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


LONG = "abcdefghijklmnopqrstuvwxyzabcd"
WORDS = ["", "a", "b", "ab", "ba", "abc", "acb", "xabc", "éa", "\U0001f600a", "abcdef", "abcdfe", "bcdef", "abcdefg", LONG, LONG[1:], LONG[:-2], LONG[:-6], LONG[:-7], LONG[:-5], LONG + "x", "xy" + LONG, LONG[:9] + LONG[11:], LONG[:25], LONG[:24], LONG[:26], "b" + LONG[:25], "a" * 40, "a" * 42, "a" * 43]


def found(df):
    return {(r["word"], r["candidate"]): r["distance"] for r in df.collect()}


def brute(words, candidates, most, prefix, allowed=None):
    return {(a, b): d for a in set(words) for b in set(candidates) if None not in (a, b) and a[:prefix] == b[:prefix] and (d := edits(a, b)) <= min(most, allowed(a) if allowed else most)}


@pytest.mark.parametrize("most", [0, 1, 2])
@pytest.mark.parametrize("prefix", [0, 1, 3])
def test_all_near_pairs(spark, most, prefix):
    df = spark.createDataFrame([(w, 1) for w in [*WORDS, *WORDS[:5], None]], "w string, word int")
    assert found(fuzzy.near_words(df, "w", df, "w", most, prefix)) == brute(WORDS, WORDS, most, prefix)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab", max_size=32), max_size=40), st.lists(st.text("ab", max_size=32), max_size=40), st.integers(0, 1))
def test_words_of_two_letters(spark, words, candidates, prefix):
    left, right = (spark.createDataFrame([(w,) for w in x], "w string") for x in (words, candidates))
    short = lambda w: 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2
    got = found(fuzzy.near_words(left, "w", right, "w", 2, prefix, search.edit_allowance(F.col("w"))))
    assert got == brute(words, candidates, 2, prefix, short)


def test_keys_stay_small(spark):
    """Thousands of words of one length and first letter, once a single block, leave no large key and few pairs to measure."""
    words = spark.range(4000).select(F.concat(F.lit("a"), F.substr(F.sha2(F.col("id").cast("string"), 256), F.lit(1), F.lit(11))).alias("w"))
    keys = words.select(F.explode(fuzzy.deletions(F.col("w"), 2)).alias("v")).groupBy("v").count().agg(F.max("count")).first()[0]
    assert keys < 10
    assert fuzzy.near_words(words, "w", words, "w").where("word = candidate").count() == 4000


def test_nearest_words_keeps_columns(spark):
    df = spark.createDataFrame([(1, "maison"), (2, "maisom"), (3, None), (4, "")], "k int, w string")
    vocabulary = spark.createDataFrame([("maison",), ("raison",), (None,), ("maison",)], "v string")
    got = {(r["k"], r["candidate"], r["distance"]) for r in T.nearest_words(df, "w", vocabulary, "v", 2).collect()}
    assert got == {(1, "maison", 0), (2, "maison", 1)}


def test_fuzzy_terms_without_prefix(spark):
    docs = spark.createDataFrame([(1, "maison"), (2, "raison"), (3, "ma")], "k long, t string")
    index = search.build_index(docs, "k", {"t": T.words(F.col("t"))})
    terms = search.query_terms(spark.createDataFrame([(9, "maison ma")], "q long, t string"), "q", T.words(F.col("t")))
    expand = lambda prefix: {r["term"]: r["weight"] for r in search.fuzzy_terms(index, terms, "t", prefix).collect()}
    assert expand(1) == {"maison": 1.0, "ma": 1.0}
    assert expand(0) == {"maison": 1.0, "ma": 1.0, "raison": pytest.approx(1 - 1 / 6)}
    assert search.fuzzy_terms(index, terms.where("false"), "t").count() == 0
