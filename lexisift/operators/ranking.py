"""Top-k, ranks and re-ranks. Every order ends in a key, so ties have one answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; Spark keeps k rows of a group in each task before it shuffles."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def rank_of_truth(items: Column, truth: Column) -> Column:
    """1-based place of the truth in a list, -1 where it isn't there, -2 where the list is null."""
    return F.when(items.isNull(), F.lit(-2)).when(F.array_position(items, truth) > 0, F.array_position(items, truth).cast("int")).otherwise(F.lit(-1))


def rank_or_sentinel(items: Column, truth: Column, absent: int = 10) -> Column:
    """0-based place of the truth in a list, a sentinel where it isn't there, null where the list is null."""
    return F.when(items.isNull(), F.lit(None).cast("int")).when(F.array_position(items, truth) > 0, F.array_position(items, truth).cast("int") - 1).otherwise(F.lit(absent))


def prefer_first(df: DataFrame, keys: Sequence[str], preferred: Column, rank: str) -> DataFrame:
    """A stable re-rank: rows that are preferred come first, each part in its old order."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(F.when(preferred, 0).otherwise(1), rank)).cast("int"))


def gap_features(df: DataFrame, keys: Sequence[str], score: str, rank: str = "rank") -> DataFrame:
    """Scores of the first two of each group with their gap, normalised gap and ratio; the second's is 0 where there is none."""
    two = df.where(F.col(rank) <= 2).groupBy(*keys).agg(F.max(F.when(F.col(rank) == 1, F.col(score))).alias("score1"), F.coalesce(F.max(F.when(F.col(rank) == 2, F.col(score))), F.lit(0.0)).alias("score2"))
    gap = F.col("score1") - F.col("score2")
    nonzero = F.nullif(F.col("score1"), F.lit(0.0))
    return two.withColumn("diff", gap).withColumn("normdiff", gap / nonzero).withColumn("ratio", F.col("score2") / nonzero)


def wide(df: DataFrame, keys: Sequence[str], fields: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """top_{i}_{field} columns of each group's first k rows, by one aggregation."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(rank) == i, F.col(f))).alias(f"top_{i}_{f}") for i in range(1, k + 1) for f in fields])


def long(df: DataFrame, keys: Sequence[str], fields: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """The reverse of wide: one row for each rank whose first field isn't null."""
    rows = F.array(*[F.struct(F.lit(i).alias(rank), *[F.col(f"top_{i}_{f}").alias(f) for f in fields]) for i in range(1, k + 1)])
    return df.select(*keys, F.inline(rows)).where(F.col(fields[0]).isNotNull())
