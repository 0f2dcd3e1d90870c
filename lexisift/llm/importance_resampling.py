"""Importance resampling towards a target distribution, over hashed word features.

Every text becomes runs of consecutive words, each hashed to one of a fixed number of buckets. What a bucket gains is the
logarithm of its share of the target's features against its share of all documents'; a document's weight is the sum over its
features, looked up in an array of gains. Adding a Gumbel number made from the document's id turns "the highest scores" into
a draw without replacement by those weights.

The draw takes an exact number of rows without a global sort: scores are written once as slim rows, and the cutoff is found by
bisection, each step an exact count job over them. Rows that tie at the cutoff are told apart by bisecting their ids, and
rows that tie there too by the place where they were written. Only what is drawn is then range-partitioned for ranks.

A null text has no words, a null id counts as an empty one in the hash and comes after all others among ties. A document
without features has weight 0. With no eligible rows, or an empty table, nothing is drawn. An empty target gives every bucket
the gain of no occurrence.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.common import materialise, small_batches, table, unused

BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Cuts that one count job tries at once; 1 is plain bisection.
CUTS = 15
#: Bytes to bytes: A-Z to lower case, whatever can't be in a word to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: str | None, longest: int = LONGEST_RUN) -> tuple[int, Counter]:
    """The number of a text's words, and its features (as bytes) with their counts."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    found = Counter(words)
    for n in range(2, longest + 1):
        found.update(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return len(words), found


def _bucket_counts(found: Counter, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.fromiter((zlib.crc32(w) % buckets for w in found), np.int64, len(found))
    return at, np.fromiter(found.values(), np.int64, len(found))


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """(bucket, n): how often df's features fall into each bucket that any falls into. A task sends one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                at, n = _bucket_counts(features(t.as_py(), longest)[1], buckets)
                np.add.at(total, at, n)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    return df.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What each bucket gains, in thousandths and rounded down, from two tables of bucket counts. It has as many numbers as there are buckets."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for df, counts in ((source, s), (target, t)):
        for bucket, n in df.toPandas().itertuples(index=False):  # a row for each bucket at most
            counts[bucket] = n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(df: DataFrame, gain: np.ndarray, text: str = "text", longest: int = LONGEST_RUN, keep: Sequence[str] = ()) -> DataFrame:
    """The columns to keep and n_words, n_features, weight of every row."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(unused(df, "text_")))
    names = [*keep, "n_words", "n_features", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, t in enumerate(batch.column(batch.num_columns - 1)):
                words, found = features(t.as_py(), longest)
                at, n = _bucket_counts(found, len(gain))
                out[:, i] = words, n.sum(), (gain[at] * n).sum()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, out)], names)

    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} long" for n in names[len(keep) :]])
    return kept.mapInArrow(weigh, schema)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """A Gumbel number of a key, in thousandths and rounded down, from the first 32 bits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _before(order: Sequence[str], cut: Sequence[int]) -> Column:
    """Whether a row's order columns come before or at a cut, which may name the first of them only."""
    first, at = F.col(order[0]), F.lit(cut[0])
    return first <= at if len(cut) == 1 else (first < at) | ((first == at) & _before(order[1:], cut[1:]))


def cutoff(rows: DataFrame, order: Sequence[str], n: int, cuts: int = CUTS) -> list[int]:
    """The cut up to which exactly n rows come, in order of whole-number columns that together are unique.

    One column is bisected after the other, among the rows that are equal at the cut so far: each job counts the rows up to
    some cuts between the bounds, exactly, and the bounds close in. Columns that aren't needed are left out of the cut.
    """
    cut: list[int] = []
    left = n
    for column in order:
        tied = rows.where(F.lit(True) if not cut else F.expr(" AND ".join(f"`{c}` = {v}" for c, v in zip(order, cut, strict=False))))
        low, high, total = tied.agg(F.min(column), F.max(column), F.count("*")).first()
        below, at_high = 0, total  # rows under low, rows up to high
        while low < high and at_high > left:
            tries = sorted({low + (high - low) * (i + 1) // (cuts + 1) for i in range(cuts)})
            counts = tied.agg(*[F.count(F.when(F.col(column) <= v, 1)).alias(f"c{i}") for i, v in enumerate(tries)]).first()
            for v, c in zip(tries, counts, strict=True):
                if c >= left:
                    high, at_high = v, c
                    break
                low, below = v + 1, c
        cut.append(high)
        if at_high == left:
            break
        left -= below
    return cut


def ranked(rows: DataFrame, order: Sequence[str], rank: str = "rank") -> DataFrame:
    """Rows numbered from 1 in a global order: range partitions, sorted each, and how many rows come before a partition."""
    part, place, before = "_part", "_place", "_before"
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # an id has the partition's number in its upper bits and the place in the partition, from 0, in the lower 33
    ranged = materialise(ranged.withColumn(place, F.monotonically_increasing_id()).withColumns({part: F.shiftright(place, 33), place: F.col(place).bitwiseAND(2**33 - 1)}), "drawn")
    sizes, done, offsets = ranged.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect(), 0, []  # a row for each partition
    for p, n in sizes:
        offsets.append((p, done))
        done += n
    starts = rows.sparkSession.createDataFrame(offsets, f"{part} long, {before} long")
    return ranged.join(F.broadcast(starts), part).withColumn(rank, F.col(before) + F.col(place) + 1).drop(part, place, before)


def resample(
    documents: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", buckets: int = BUCKETS,
    longest: int = LONGEST_RUN, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, cuts: int = CUTS,
) -> DataFrame:
    """Every document's key, n_features, weight, score and rank: rank counts the drawn ones from 1, the best first; it is null for others.

    Drawn are, of the documents with so many words at least, the given percentage (rounded down) with the highest scores, ties
    by the smaller key. key: a whole number. Rows that repeat a key and score are drawn up to the exact number.
    """
    gain = gains(bucket_counts(documents, text, buckets, longest), bucket_counts(target, target_text, buckets, longest), buckets)
    made = weighted(documents.select(F.col(key).alias("key"), F.col(text).alias("text")), gain, "text", longest, ["key"])
    order = ["_falling", "_key", "_row"]
    scored = made.withColumn("score", F.col("weight") + gumbel(F.col("key"), seed)).withColumns(
        {"_falling": -F.col("score"), "_key": F.coalesce(F.col("key").cast("long"), F.lit(2**63 - 1)), "_row": F.monotonically_increasing_id()}
    )
    scored = materialise(scored, "scores")
    enough = F.col("n_words") >= least_words
    eligible = scored.where(enough)
    n = percent * eligible.count() // 100
    out = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    if not n:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*out)
    drawn = enough & _before(order, cutoff(eligible, order, n, cuts))
    return ranked(scored.where(drawn), order).select(*out).unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*out))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' weights towards the benchmark's texts, and the ranks of the tenth that is drawn."""
    small_batches(spark)
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: A step of crc32 for a bit, eight of which are one byte; each distinct word is hashed once, from the hex digits of its bytes.
_BIT = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
OP11_SQL = rf"""
WITH RECURSIVE byte(b, c, i) AS (SELECT range, range, 0 FROM range(0, 256) UNION ALL SELECT b, {_BIT.format("c")}, i + 1 FROM byte WHERE i < 8),
steps AS (SELECT list(c ORDER BY b) AS t FROM byte WHERE i = 8),
d AS (SELECT doc_id, row_number() OVER () AS row, {_WORDS.format('"text"')} AS w FROM documents),
b AS (SELECT {_WORDS.format('"text"')} AS w FROM benchmark),
words AS (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM d UNION ALL SELECT unnest(w) AS w FROM b)),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(w) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT))), lambda x, y: xor(x >> 8, t[1 + (xor(x, y) & 255)])), 4294967295) % {BUCKETS} AS bucket FROM words, steps),
dw AS (SELECT row, h.bucket, count(*) AS n FROM (SELECT row, unnest(w) AS w FROM d) x JOIN hashed h ON x.w = h.w GROUP BY row, h.bucket),
s AS (SELECT bucket, sum(n) AS n FROM dw GROUP BY bucket),
t AS (SELECT h.bucket, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) x JOIN hashed h ON x.w = h.w GROUP BY h.bucket),
gain AS (SELECT range AS bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS} AS DOUBLE) / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS g
  FROM range(0, {BUCKETS}) r LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
weights AS (SELECT row, CAST(sum(n * g) AS BIGINT) AS weight FROM dw JOIN gain USING (bucket) GROUP BY row),
h AS (SELECT row, doc_id, len(w) AS n_words, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN weights USING (row)),
scores AS (SELECT row, doc_id, CAST(n_words AS BIGINT) AS n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM h),
ranks AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS rank, count(*) OVER () AS n FROM scores WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank FROM scores LEFT JOIN ranks USING (row)
"""
