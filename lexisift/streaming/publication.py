"""Structured Streaming: validated records into an index as they come, counts by week, open-to-close times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexisift.operators.search_index import SegmentedIndex
from lexisift.sources.shared import fresh_path


def file_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def publish(stream: DataFrame, target: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append each batch's records, the last of each key, to an index table, exactly once per batch.

    A batch's folder is overwritten if the batch is repeated. latest() reads the newest record of each key by ``published``,
    whatever the order in which batches came.
    """

    def write(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.struct(F.col("published"), F.xxhash64(*batch.columns))).alias("r")).select("r.*")
        newest.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/part={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def publish_to_index(stream: DataFrame, index: SegmentedIndex, checkpoint: str, compact_every: int = 16) -> StreamingQuery:
    """Take each batch's records into a search index as a segment; what is searched next finds them.

    Every so many batches the segments are compacted. A repeated batch writes its segment anew.
    """

    def write(batch: DataFrame, number: int) -> None:
        index.add(batch, number)
        if (number + 1) % compact_every == 0:
            index.compact()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, key: str) -> DataFrame:
    rows = spark.read.parquet(target).drop("part")
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct("published", "batch")).alias("r")).select(key, "r.*")


def weekly_counts(df: DataFrame, time: str, keys: tuple[str, ...] = (), lateness: str = "30 days") -> DataFrame:
    """Counts by week and keys; the same plan for a stream (with a watermark) and a table."""
    rows = df.withColumn(time, F.col(time).cast("timestamp"))
    rows = rows.withWatermark(time, lateness) if df.isStreaming else rows
    return rows.groupBy(F.window(time, "7 days", startTime="4 days").alias("w"), *keys).agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd").alias("week"), *keys, "n")


def to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that a stream has, as a table: the stream is run until it is at its end."""
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", fresh_path(spark, f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def complete_counts(stream: DataFrame, name: str) -> DataFrame:
    """The last complete result of a streaming aggregation."""
    spark = stream.sparkSession
    path = fresh_path(spark, name)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    stream.writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", fresh_path(spark, f"{name}-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
