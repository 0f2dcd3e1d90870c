"""What each of several filters removes, in every order of applying them, kept up to date as documents stream in.

Four filters look at a document alone, the fifth (E) fails a text that a smaller id has too, anywhere in the table. So a
document's failures are known only when all ids have been seen. The audit is incremental: documents come in micro-batches,
each is turned into its part, the mask of filters it fails, and a hash of its text. State keyed by the hash keeps the
smallest id so far and what its rows counted for. When a smaller id arrives, the mask that the earlier rows were counted
under is taken back and they count again with E; the counters of parts are sums of such changes, so they're right after
every batch, whatever the order in which documents come.

A copied text's rows are reduced in each task before they're dealt out by hash, so a text that a third of all rows hold is a row
for each task. State is a table in the shared folder that only grows: a batch adds rows where a text's smallest id is new
or met again, and of a text's rows those with its smallest id count. A batch's state and changes are written under its
number and it reads only what earlier batches wrote, so a repeated batch gives the same again and overwrites its own.

A null text is an empty one, a null part an empty string. A row without an id never fails E and isn't smaller than any other.
Rows that repeat an id and text fail E or pass it together. A document is good or toxic if any of its labels says so. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisift.llm.common import fresh_path, small_batches, table

FILTERS = "ABCDE"
COPY = 16  # the bit of E
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Texts whose reduced rows a task holds at once before it sends them on.
HELD = 100_000
MICRO_BATCHES = 4
COUNTERS = "part string, good boolean, toxic boolean, mask int, n long"
STATE = "digest binary, part string, good boolean, toxic boolean, mask int, id long, n long"


def failures(text: str) -> int:
    """The mask of the filters A to D that a text fails; words are what ASCII white space separates."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    few = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)
    shouted = 100 * (len(data) - len(data.translate(None, CAPITALS))) > MOST_CAPITALS_PERCENT * len(text)
    marked = len(data.translate(None, MARKS)) < len(data)
    return few + 2 * repeated + 4 * shouted + 8 * marked


def _slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(2)]
        digests = pa.array([hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digests, pa.array([failures(t) for t in texts], pa.int32())], ["id", "part", "digest", "mask"])


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, part, kind of label and whether there is an id: the smallest id, its rows, and the rows of larger ids."""
    held: dict[tuple, list] = {}

    def rows() -> pa.RecordBatch:
        keys, values = list(zip(*held, strict=True)), list(zip(*held.values(), strict=True))
        kinds = [pa.binary(), pa.string(), pa.bool_(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*keys[:5], *values], kinds, strict=True)], ["digest", "part", "good", "toxic", "mask", "id", "n_at", "n_over"])

    for batch in batches:
        for digest, part, good, toxic, mask, i in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            key = digest, part, good, toxic, mask, i is None
            own = held.get(key)
            if own is None:
                held[key] = [i, 1, 0]
            elif i is None or i == own[0]:
                own[1] += 1
            elif i > own[0]:
                own[2] += 1
            else:
                own[:] = i, 1, own[1] + own[2]
        if len(held) >= HELD:
            yield rows()
            held.clear()
    if held:
        yield rows()


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table at a path that a batch writes anew."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slim_rows(stream: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """(id, part, digest, mask) of documents, a stream or a table."""
    rows = stream.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    return rows.mapInArrow(_slim, "id long, part string, digest binary, mask int")


def reduced(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Slim rows with what labels (key, quality, toxic) say of them, reduced in each task to a row for each text, part and kind."""
    # rows without an id match nothing and are spread by their texts
    rows = rows.withColumn("spread", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(0))
    told = labels.where("quality = 1 OR toxic = 1").groupBy(F.col(key).cast("long").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    joined = rows.join(told.withColumn("spread", F.lit(0).cast("long")), ["id", "spread"], "left")
    each = joined.select("digest", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "mask", "id")
    return each.mapInArrow(_reduced, "digest binary, part string, good boolean, toxic boolean, mask int, id long, n_at long, n_over long")


def update(batch: DataFrame, state: DataFrame) -> DataFrame:
    """A batch's reduced rows and the state of their texts, each with the smallest ids before (old_least) and after the batch (least).

    state: (digest, part, good, toxic, mask, id, n), the rows that had their text's smallest id at some time.
    """
    new = batch.withColumn("old", F.lit(False))
    old = state.join(batch.select("digest").distinct(), "digest", "left_semi").select("digest", "part", "good", "toxic", "mask", "id", F.col("n").alias("n_at"), F.lit(0).cast("long").alias("n_over"), F.lit(True).alias("old"))
    text = Window.partitionBy("digest")
    return new.unionByName(old).withColumns({"least": F.min("id").over(text), "old_least": F.min(F.when(F.col("old"), F.col("id"))).over(text)})


def changes(updated: DataFrame) -> DataFrame:
    """What the rows of update() change in the counters."""
    change = lambda copy, n: F.struct((F.col("mask").bitwiseOR(F.lit(COPY)) if copy else F.col("mask")).alias("mask"), n.alias("n"))
    first = F.col("id").isNull() | (F.col("id") == F.col("least"))
    fresh = F.array(change(False, F.when(first, F.col("n_at")).otherwise(0)), change(True, F.col("n_over") + F.when(first, 0).otherwise(F.col("n_at"))))
    taken_back = F.col("old") & (F.col("id") == F.col("old_least")) & (F.col("least") < F.col("old_least"))
    back = F.when(taken_back, F.array(change(False, -F.col("n_at")), change(True, F.col("n_at"))))
    rows = updated.select("part", "good", "toxic", F.explode(F.when(F.col("old"), back).otherwise(fresh)).alias("c"))
    return rows.groupBy("part", "good", "toxic", "c.mask").agg(F.sum("c.n").alias("n")).where("n <> 0")


def keep_counters(stream: DataFrame, labels: DataFrame, root: str, text: str = "text", key: str = "doc_id", part: str = "lang") -> None:
    """Run a stream of documents to its end; state, counters and checkpoint are kept under root, and a later run goes on from there."""
    spark = stream.sparkSession

    def write(rows: DataFrame, number: int) -> None:
        batch = written(reduced(rows, labels, key), f"{root}/rows")
        earlier = [f"{root}/state/{n}" for n in range(number)]
        state = spark.read.schema(STATE).parquet(*earlier) if earlier else spark.createDataFrame([], STATE)
        updated = written(update(batch, state), f"{root}/updated")
        held = updated.where(~F.col("old") & (F.col("id") == F.col("least"))).groupBy("digest", "part", "good", "toxic", "mask", "id").agg(F.sum("n_at").alias("n"))
        held.write.mode("overwrite").parquet(f"{root}/state/{number}")
        changes(updated).coalesce(1).write.mode("overwrite").parquet(f"{root}/counters/{number}")

    slim = slim_rows(stream, text, key, part)
    slim.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def counters(spark: SparkSession, root: str) -> DataFrame:
    """The counters after the batches so far: how many documents of a part, good or not, toxic or not, fail just the filters of a mask."""
    spark.createDataFrame([], COUNTERS).write.mode("overwrite").parquet(f"{root}/counters/none")
    every = spark.read.schema(COUNTERS).option("recursiveFileLookup", True).parquet(f"{root}/counters")
    return every.groupBy("part", "good", "toxic", "mask").agg(F.sum("n").alias("n")).where("n <> 0")


def orders_of(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, the step's bit, the bits of the steps before it) for every order of the filters."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << filters.index(f)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def report(counted: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from the counters; of them there are 128 a part at most."""
    spark, steps = counted.sparkSession, orders_of()
    numbered = spark.createDataFrame([(i, *s) for i, s in enumerate(steps)], "number int, filter_order string, step int, bit int, before int")
    each = counted.withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).join(F.broadcast(numbered), "number")  # 600 rows
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    here = fails & ~gone
    rows = each.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"), total(here & F.col("toxic")).alias("toxic_lost"),
    )
    shares = rows.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "bit"]).drop("bit")


def audit(spark: SparkSession, path: str, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang", micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The report over all files of a Parquet table, read as a stream in about so many micro-batches."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", -(-files.getContentSummary(there).getFileCount() // micro_batches))
    if files.getFileStatus(there).isFile():  # a stream reads folders
        reader, path = reader.option("pathGlobFilter", there.getName()), there.getParent().toString()
    stream = reader.parquet(path)
    root = fresh_path(spark, "audit")
    keep_counters(stream, labels, root, text, key, part)
    return report(counters(spark, root))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the five filters over all documents."""
    small_batches(spark)
    return audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce("text", '') AS t FROM documents),
w AS (SELECT doc_id, part, t, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
m AS (SELECT part, doc_id IN (SELECT doc_id FROM good) AS good, doc_id IN (SELECT doc_id FROM toxic) AS toxic,
  CASE WHEN len(w) < {LEAST_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS_PERCENT} * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask FROM w),
c AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, mask, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, coalesce(CAST(list_sum(bits[1:i - 1]) AS INTEGER), 0) AS before FROM o, range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, bit, n, good, toxic, mask, mask & bit <> 0 AS fails, mask & before <> 0 AS gone FROM c, s),
r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails, coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))}, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
