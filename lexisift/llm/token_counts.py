"""Token counts from flat token files without an index: a scan for the end-of-document id.

A token file is nothing but little-endian unsigned ids, one document after another, each closed by the
end-of-document id. The files are cut into blocks of a fixed number of ids wherever the cuts fall. Each
block is searched by one numpy comparison; what a block can't know, the last separator before it and the
number of documents before it, comes from a prefix scan over the blocks of its file. The scan sees only a
count and a last place of each block, in two levels: within ranges of ``SCAN_BLOCKS`` blocks, and over the ranges.
Blocks are dealt out by number to as many tasks as their bytes need, so one file that holds most of the tokens is
shared by all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisift.llm.byte_bpe import Encoder, in_worker, share
from lexisift.llm.common import block_slices, fresh_path, materialise, small_batches, table

END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 20
#: Blocks that a task searches, about, and blocks of a file that are scanned together.
TASK_BLOCKS, SCAN_BLOCKS = 4, 4096


def open_store(path: str):
    """The file system of a URI or local path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", end_id: int = END_OF_DOCUMENT, dtype: str = "<u2") -> DataFrame:
    """Write every document's ids and the end id to flat files, one file for each task; return which document is where.

    Returned (and written in the folder): file, ordinal from 0, the key. A null text counts as empty: only its end
    id is written. A file is named after its task's attempt, so a repeated or doubled attempt never mixes with
    another; files of attempts that failed are not in the returned table and are never read.
    """
    spark = docs.sparkSession
    shared = share(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType

    def run(batches):
        encoder, end = in_worker(shared, Encoder, dtype), np.array([end_id], dtype=dtype).tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name = f"tokens-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.bin"
        ordinal = 0
        with store.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                texts = batch.column("text")
                for a, b in block_slices(pc.binary_length(texts).to_pylist(), 1 << 20):
                    for ids in encoder(texts.slice(a, b - a)):
                        out.write(ids)
                        out.write(end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column("key")], names=["file", "ordinal", "key"]
                )
                ordinal += n

    placed = rows.mapInArrow(run, f"file string, ordinal long, key {kind.simpleString()}")
    placed.write.parquet(f"{folder}/documents")
    return spark.read.parquet(f"{folder}/documents").withColumnRenamed("key", key)


def scan_token_files(files: DataFrame, folder: str, end_id: int = END_OF_DOCUMENT, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each document in the files named in column ``file``: file, ordinal, start, n_tokens, terminated.

    start and n_tokens count ids from the file's begin, n_tokens without the end id. Ids after the last end id are
    one more document with terminated false. An empty file has no documents; two end ids in a row enclose an empty one.
    Bytes that don't fill an id at a file's end are ignored.
    """
    width = np.dtype(dtype).itemsize

    def sizes(batches):
        store, root = open_store(folder)
        for batch in batches:
            names = batch.column("file").to_pylist()
            n = [store.get_file_info(f"{root}/{x}").size // width for x in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())], names=["file", "n"])

    def search(batches):
        store, root = open_store(folder)
        for batch in batches:
            for file, block, n in zip(*[batch.column(c).to_pylist() for c in ("file", "block", "n")]):
                first = block * block_tokens
                with store.open_input_file(f"{root}/{file}") as f:
                    ids = np.frombuffer(f.read_at(min(block_tokens, n - first) * width, first * width), dtype=dtype)
                ends = np.flatnonzero(ids == end_id) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.string()), pa.array([block], pa.int64()), pa.array([n], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "n", "ends"],
                )

    last = F.expr(f"(n - 1) div {block_tokens}")
    known = materialise(files.select("file").distinct().mapInArrow(sizes, "file string, n long").where("n > 0"), "token-file-sizes")
    total = known.agg(F.sum(last + 1)).first()[0] or 1
    # by a given number of partitions, which is kept however small the rows that name the blocks are
    blocks = known.withColumn("block", F.explode(F.sequence(F.lit(0), last))).repartition(-(-total // TASK_BLOCKS), "file", "block")
    found = materialise(blocks.mapInArrow(search, "file string, block long, n long, ends array<long>"), "separators")
    slim = found.select("file", "block", "n", F.size("ends").alias("count"), F.try_element_at("ends", F.lit(-1)).alias("last"), F.expr(f"block div {SCAN_BLOCKS}").alias("range"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ranges = slim.groupBy("file", "range").agg(F.sum("count").alias("count"), F.max("last").alias("last"))
    ranges = ranges.select("file", "range", *[f(c).over(before("file").orderBy("range")).alias(f"range_{c}") for f, c in ((F.sum, "count"), (F.max, "last"))])
    within = slim.select("file", "block", "range", *[f(c).over(before("file", "range").orderBy("block")).alias(f"own_{c}") for f, c in ((F.sum, "count"), (F.max, "last"))])
    scanned = within.join(ranges, ["file", "range"]).select(
        "file", "block", (F.coalesce("own_count", F.lit(0)) + F.coalesce("range_count", F.lit(0))).alias("base"), F.coalesce("own_last", "range_last", F.lit(-1)).alias("previous")
    )
    stitched = (
        found.join(scanned.hint("merge"), ["file", "block"])
        # the last block also closes what has no end id
        .withColumn("closed", F.coalesce(F.try_element_at("ends", F.lit(-1)), "previous") == F.col("n") - 1)
        .withColumn("ends", F.when((F.col("block") == last) & ~F.col("closed"), F.concat("ends", F.array("n"))).otherwise(F.col("ends")))
        .withColumn("begins", F.transform(F.concat(F.array("previous"), "ends"), lambda x: x + 1))
        .select("file", "n", "base", F.posexplode(F.arrays_zip("ends", F.slice("begins", 1, F.size("ends")).alias("begins"))).alias("at", "document"))
    )
    return stitched.select(
        "file", (F.col("base") + F.col("at")).alias("ordinal"), F.col("document.begins").alias("start"),
        (F.col("document.ends") - F.col("document.begins")).alias("n_tokens"), (F.col("document.ends") < F.col("n")).alias("terminated"),
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to flat token files, and the scan's token counts by doc_id."""
    small_batches(spark)
    folder = fresh_path(spark, "token-files")
    placed = write_token_files(table(spark, sf_dir, "documents"), folder)
    counted = scan_token_files(placed, folder)
    # both sides grow with the documents: never broadcast
    return placed.join(counted.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens", "start", "terminated")
