"""Search indexes on disk: blocks of documents with maxima for the best hits, and segments that take new records.

A block is so many documents of a field, put together by their rarest terms, so that few different terms meet in one. For each
of its terms it has the largest frequency and the smallest length, which bound what the term can add to any of its documents,
whatever the mean length is by then, and the postings themselves. The best k of a query are found in two steps: its most
promising blocks are scored, which gives a score that k documents reach; then only blocks whose bound comes up to that are.

A growing index is a folder of segments, one a batch of records. A segment has its documents, postings and blocks, the keys whose
earlier record it replaces, and what it changes in the counts of terms and fields: records that it replaces are subtracted, so
sums over segments are the counts of a fresh index. A segment counts once its last table is complete, and a repeated batch
overwrites its own. Compaction writes what is live as a new base, of which the last complete one counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexisift.operators.relational import numbered
from lexisift.operators.search import Index, inverse_frequency, postings_of, term_part, top
from lexisift.sources.shared import written

BLOCK = 128
#: Of a document's terms, rarest first, so many decide beside which others it is put.
LEADING = 4
#: Most promising blocks that are scored to find what k documents reach.
TRIED = 2
#: Scores are compared when rounded to six digits.
MARGIN = 2e-6
_SEPARATOR = "\x1f"

TABLES = {
    "postings": "segment int, term string, key long, length int, tf long, field string",
    "documents": "segment int, key long, published long",
    "blocks": "segment int, block long, term string, max_tf long, min_length int, entries array<struct<key: bigint, tf: bigint, length: int>>, field string",
    "replaced": "segment int, key long",
    "terms": "segment int, field string, term string, df long",
    "fields": "segment int, field string, documents long, total_length long",
}


def blocks_of(postings: DataFrame, size: int = BLOCK) -> DataFrame:
    """(field, block, term, max_tf, min_length, entries) of postings (field, term, key, tf, length): entries are a block's at most."""
    counts = postings.groupBy("field", "term").agg(F.count("*").alias("df"))
    rare = F.sort_array(F.collect_list(F.struct("df", "term")))
    documents = postings.join(counts, ["field", "term"]).groupBy("field", "key").agg(F.array_join(F.slice(rare, 1, LEADING)["term"], _SEPARATOR).alias("leading"), F.first("length").alias("length"))
    placed = numbered(documents, ["field", "leading", "length", "key"], "place", 0).select("field", "key", F.floor(F.col("place") / size).cast("long").alias("block"))
    entry = F.struct("key", "tf", "length")
    return postings.join(placed, ["field", "key"]).groupBy("field", "block", "term").agg(F.max("tf").alias("max_tf"), F.min("length").alias("min_length"), F.collect_list(entry).alias("entries"))


def _live(rows: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """Rows of segments whose key no later segment replaces."""
    if replaced is None:
        return rows
    r, gone = rows.alias("r"), replaced.alias("g")
    return r.join(gone, (F.col("r.key") == F.col("g.key")) & (F.col("r.segment") < F.col("g.segment")), "left_anti")


def top_match(index: Index, terms: DataFrame, field: str, k: int = 10, boost: float = 1.0, norms: bool = True, tried: int = TRIED, blocks_scored: list | None = None) -> DataFrame:
    """(q, key, score, rank): what top(match(...), k) gives, from the blocks that can hold a query's best only.

    terms: (q, term, weight). blocks_scored, if given, gets the DataFrames of (q, segment, block) that are scored.
    """
    mean = F.broadcast(index.fields.where(F.col("field") == field).select("mean_length"))  # one row
    rated = terms.join(index.terms.where(F.col("field") == field), "term").select("q", "term", (F.col("weight") * F.col("idf") * boost).alias("rate"))
    blocks = index.blocks.where(F.col("field") == field)
    most = F.col("rate") * term_part(F.col("max_tf"), F.col("min_length"), norms)
    rated = written(rated, "rated")
    bounds = written(rated.join(blocks.select("segment", "block", "term", "max_tf", "min_length"), "term").join(mean).groupBy("q", "segment", "block").agg(F.sum(most).alias("bound")), "bounds")

    def scored(chosen: DataFrame) -> DataFrame:
        if blocks_scored is not None:
            blocks_scored.append(chosen)
        entries = chosen.join(rated, "q").join(blocks.select("segment", "block", "term", "entries"), ["segment", "block", "term"]).select("q", "segment", "rate", F.inline("entries"))
        own = F.col("rate") * term_part(F.col("tf"), F.col("length"), norms)
        return _live(entries, index.replaced).join(mean).groupBy("q", "key").agg(F.sum(own).alias("score"))

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "segment", "block"))
    first = bounds.withColumn("rank", rank).where(F.col("rank") <= tried).select("q", "segment", "block")
    hits = written(scored(first), "first-hits")
    kth = top(hits, k).where(F.col("rank") == k).select("q", F.col("score").alias("reached"))
    rest = bounds.join(kth, "q", "left").where(F.col("reached").isNull() | (F.col("bound") >= F.col("reached") - MARGIN)).select("q", "segment", "block").join(first, ["q", "segment", "block"], "left_anti")
    return top(hits.unionByName(scored(rest)), k)


def write_index(index: Index, path: str, size: int = BLOCK) -> None:
    """Write an index to be searched many times: folders by field; postings and blocks in order of their terms.

    A search reads its fields' folders only; where it names few terms, of those only the row groups that may hold them.
    """
    one = F.lit(0).alias("segment")
    index.postings.select(one, *[F.col(c) for c in ("term", "key", "length", "tf", "field")]).repartitionByRange("field", "term").sortWithinPartitions("field", "term", "key").write.partitionBy("field").parquet(f"{path}/postings")
    postings = index.postings.sparkSession.read.schema(TABLES["postings"]).parquet(f"{path}/postings")
    blocks_of(postings, size).select(one, "*").repartitionByRange("field", "term", "block").sortWithinPartitions("field", "term", "block").write.partitionBy("field").parquet(f"{path}/blocks")
    index.terms.write.partitionBy("field").parquet(f"{path}/terms")
    index.fields.write.parquet(f"{path}/fields")


def open_index(spark: SparkSession, path: str) -> Index:
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return Index(read("postings", TABLES["postings"]), read("terms", "term string, idf double, field string"), read("fields", "field string, documents long, mean_length double"), read("blocks", TABLES["blocks"]))


def table_version(spark: SparkSession, path: str) -> str:
    """What changes whenever a table's files do: a hash of their names, sizes and times. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    n, mark = files.select(F.xxhash64("path", "length", "modificationTime").alias("h")).agg(F.count("*"), F.expr("bit_xor(h)")).first()
    return f"{n}-{mark}"


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


class SegmentedIndex:
    """An index in a folder that takes batches of records, replaces those with the same key, and can be searched at any time.

    fields: analyzed columns by name. A record counts from the batch that brings it, unless a live one of its key was published
    later; of equal times the later batch's counts, and within a batch the larger hash of the record. Records without a key are
    left out, and so are those without terms, but for what they replace.
    """

    def __init__(self, spark: SparkSession, root: str, fields: Mapping[str, Column], key: str, published: str = "published", size: int = BLOCK):
        self.spark, self.root, self.fields, self.key, self.published, self.size = spark, root.rstrip("/"), fields, key, published, size

    def _names(self, before: int | None = None) -> list[str]:
        """The complete segments that count, the base first; before: only those of earlier batches."""
        there = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(there):
            return []
        names = sorted(x.getPath().getName() for x in files.listStatus(there))
        names = [n for n in names if exists(self.spark, f"{self.root}/{n}/fields/_SUCCESS") and (before is None or int(n.rpartition("-")[2]) < before)]
        base = max((n for n in names if n.startswith("base-")), default=None)
        last = -1 if base is None else int(base.rpartition("-")[2])
        return ([base] if base else []) + [n for n in names if n.startswith("segment-") and int(n.rpartition("-")[2]) > last]

    def _read(self, kind: str, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], TABLES[kind])
        return self.spark.read.schema(TABLES[kind]).parquet(*[f"{self.root}/{n}/{kind}" for n in names])

    def documents(self, before: int | None = None) -> DataFrame:
        """(segment, key, published) of the live records."""
        names = self._names(before)
        return _live(self._read("documents", names), self._read("replaced", names))

    def _delete(self, name: str) -> None:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        there.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(there, True)

    def _write(self, name: str, number: int, tables: Mapping[str, DataFrame]) -> None:
        """The tables of a segment, fields last: it counts when that is complete."""
        self._delete(name)
        for kind in ("documents", "postings", "replaced", "blocks", "terms", "fields"):
            df = blocks_of(self._read("postings", [name]), self.size) if kind == "blocks" else tables[kind]
            columns = [F.lit(number).alias(c) if c == "segment" else F.col(c) for c in StructType.fromDDL(TABLES[kind]).names]
            df.select(*columns).write.parquet(f"{self.root}/{name}/{kind}")

    def add(self, batch: DataFrame, number: int) -> None:
        """A batch of records as the segment of its number; numbers must rise, and a number that comes again is written anew."""
        newest = batch.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("key")).agg(F.max_by(F.struct(*batch.columns), F.struct(F.col(self.published), F.xxhash64(*batch.columns))).alias("r"))
        live = self.documents(number).select("key", F.col("published").alias("live_since"), F.lit(True).alias("known"))
        since = F.coalesce(F.col(f"r.{self.published}").cast("long"), F.lit(-(2**63)))
        accepted = newest.withColumn("published", since).join(live, "key", "left").where(F.col("known").isNull() | (F.col("published") >= F.col("live_since")))
        kept = f"{self.root}/batch-{number}"
        accepted.select("key", "published", F.coalesce("known", F.lit(False)).alias("known"), "r").write.mode("overwrite").parquet(kept)
        accepted = self.spark.read.parquet(kept)
        postings = postings_of(accepted.select("r.*"), self.key, self.fields)
        replaced = accepted.where("known").select("key")
        names = self._names(number)
        old = _live(self._read("postings", names), self._read("replaced", names)).join(replaced, "key", "left_semi")
        each = postings.select("field", "term", "key", "length", F.lit(1).alias("n")).unionByName(old.select("field", "term", "key", "length", F.lit(-1).alias("n")))
        terms = each.groupBy("field", "term").agg(F.sum("n").alias("df")).where("df <> 0")
        lengths = each.groupBy("field", "key", "n").agg(F.first("length").alias("length")).groupBy("field").agg(F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("length")).alias("total_length"))
        self._write(f"segment-{number:09d}", number, {"documents": accepted, "postings": postings, "replaced": replaced, "terms": terms, "fields": lengths})
        self._delete(f"batch-{number}")

    def compact(self) -> None:
        """What is live as a new base; earlier segments no longer count, and are deleted."""
        names = self._names()
        if len(names) < 2:
            return
        number, gone = int(names[-1].rpartition("-")[2]), self._read("replaced", names)
        tables = {
            "documents": _live(self._read("documents", names), gone), "postings": _live(self._read("postings", names), gone), "replaced": self.spark.createDataFrame([], "key long"),
            "terms": self._read("terms", names).groupBy("field", "term").agg(F.sum("df").alias("df")).where("df <> 0"),
            "fields": self._read("fields", names).groupBy("field").agg(F.sum("documents").alias("documents"), F.sum("total_length").alias("total_length")),
        }
        self._write(f"base-{number:09d}", number, tables)
        for name in names:
            self._delete(name)

    def open(self) -> Index:
        """The live index as it is now; batches that come later aren't seen by it."""
        names = self._names()
        replaced = self._read("replaced", names)
        fields = self._read("fields", names).groupBy("field").agg(F.sum("documents").alias("documents"), F.sum("total_length").alias("total_length"))
        fields = fields.where("documents > 0").select("field", "documents", (F.col("total_length") / F.col("documents")).alias("mean_length"))
        counts = self._read("terms", names).groupBy("field", "term").agg(F.sum("df").alias("df")).where("df > 0")
        terms = counts.join(F.broadcast(fields), "field").select("field", "term", inverse_frequency().alias("idf"))  # as many rows as fields
        return Index(_live(self._read("postings", names), replaced), terms, fields, self._read("blocks", names), replaced)
