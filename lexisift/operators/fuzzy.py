"""Words within a few edits of others, by an index of what is left when characters are taken out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many characters (after the prefix) a word is indexed by deletions, of which it has some n * n / 2; beyond by segments.
LONGEST = 24


def _without_one(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda i: F.concat(F.left(c, i - 1), F.substr(c, i + 1))))


def deletions(c: Column, most: int, allowed: Column | None = None) -> Column:
    """A word and what is left of it without up to most of its characters, each once; allowed lowers most row by row."""
    level, every = F.array(c), [F.array(c)]
    for n in range(1, most + 1):
        level = F.array_distinct(F.flatten(F.transform(level, _without_one)))
        every.append(level if allowed is None else F.when(allowed >= n, level).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*every))


def _segments(length: Column, most: int) -> Column:
    """(i, start, size) of a word's most + 1 segments, start from 1."""
    at = lambda i: F.floor(length * i / (most + 1)).cast("int")
    return F.array(*[F.struct(F.lit(i).alias("i"), (at(i) + 1).alias("start"), (at(i + 1) - at(i)).alias("size")) for i in range(most + 1)])


def near_words(words: DataFrame, word: str, vocabulary: DataFrame, candidate: str, most: int = 2, prefix: int = 1, allowed: Column | None = None) -> DataFrame:
    """(word, candidate, distance): all pairs of distinct values with the same first characters and an edit distance up to most.

    allowed is a column of words that lowers most for each. Two words within d edits have a text in common that either gives
    without up to d characters, so short words meet by the hashes of those: a key holds words a few letters longer than its
    text, whatever the vocabulary's size. Of a longer word's d + 1 segments one stands unchanged in the other word, moved by
    up to d. Pairs that meet are measured once. Nulls are left out; an empty word is near like any other where prefix is 0.
    """
    limit = F.lit(most) if allowed is None else F.least(allowed, F.lit(most))
    cut = lambda c: (F.left(c, F.lit(prefix)), F.substr(c, F.lit(prefix + 1)))
    head, rest = cut(F.col(word))
    left = words.where(F.col(word).isNotNull()).select(F.col(word).alias("word"), head.alias("head"), rest.alias("rest"), limit.alias("allowed")).distinct().withColumn("n", F.char_length("rest"))
    head, rest = cut(F.col(candidate))
    right = vocabulary.where(F.col(candidate).isNotNull()).select(F.col(candidate).alias("candidate"), head.alias("head"), rest.alias("rest")).distinct().withColumn("n", F.char_length("rest"))

    hashed = lambda *c: F.xxhash64("head", *c).alias("h")
    short_left = left.where(F.col("n") <= LONGEST + most).select("word", "allowed", "head", F.explode(deletions(F.col("rest"), most, F.col("allowed"))).alias("v")).select("word", "allowed", hashed("v"))
    short_right = right.where(F.col("n") <= LONGEST).select("candidate", "head", F.explode(deletions(F.col("rest"), most)).alias("v")).select("candidate", hashed("v"))

    long_right = right.where(F.col("n") > LONGEST).select("candidate", "head", "rest", "n", F.inline(_segments(F.col("n"), most)))
    long_right = long_right.select("candidate", hashed("n", "i", F.substr("rest", F.col("start"), F.col("size"))))
    lengths = F.sequence(F.greatest(F.col("n") - F.col("allowed"), F.lit(LONGEST + 1)), F.col("n") + F.col("allowed"))
    probes = left.where(F.col("n") + F.col("allowed") > LONGEST).select("word", "allowed", "head", "rest", F.col("n").alias("own"), F.explode(lengths).alias("n"))
    probes = probes.select("*", F.inline(_segments(F.col("n"), most))).withColumn("start", F.explode(F.sequence(F.col("start") - F.col("allowed"), F.col("start") + F.col("allowed"))))
    inside = (F.col("start") >= 1) & (F.col("start") + F.col("size") - 1 <= F.col("own"))
    long_left = probes.where(inside).select("word", "allowed", hashed("n", "i", F.substr("rest", F.col("start"), F.col("size"))))

    met = short_left.join(short_right, "h").unionByName(long_left.join(long_right, "h")).select("word", "candidate", "allowed").distinct()
    same = F.left("word", F.lit(prefix)) == F.left("candidate", F.lit(prefix))  # equal hashes prove nothing
    return met.withColumn("distance", F.levenshtein("word", "candidate", most)).where((F.col("distance") >= 0) & (F.col("distance") <= F.col("allowed")) & same).select("word", "candidate", "distance")
