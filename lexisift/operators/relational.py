"""Relational helpers over DataFrames."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.operators.vectors import nearest
from lexisift.sources.shared import written

#: Multiplier of the deterministic split; a fixed odd number that spreads consecutive keys.
SPREAD = 2654435761
#: Rows that one list of a join holds.
LISTED = 1024


def columns_like(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if re.search(pattern, c)])


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose column is in a list; a long list is a table joined by key, not a filter of that length."""
    if len(values) <= 1000:
        return df.where(F.col(column).isin(*values))
    keys = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], [column])
    return df.join(keys, column, "left_semi")


def flag_member(df: DataFrame, column: str, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Whether a column's value is among keys; a null is not."""
    found = keys.select(F.col(key).alias(column)).distinct().withColumn(flag, F.lit(True))
    return df.join(found, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def label_encode(df: DataFrame, column: str, code: str) -> DataFrame:
    """0, 1, ... for a column's values in order; rows with a null are left out; the order is over distinct values only."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return df.join(numbered(values, [column], code, 0), column)


def update_by_key(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """df with columns replaced where changes has the key; keys of changes must be unique."""
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_changed"))
    out = df.join(new, key, "left")
    return out.withColumns({c: F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def ensure_columns(df: DataFrame, structure: Mapping[str, str]) -> DataFrame:
    """The columns of a structure in order, cast to its types; absent ones are null, others are dropped."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in structure.items()])


def split(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the test holds, and all others (also where it is null)."""
    holds = F.coalesce(test, F.lit(False))
    return df.where(holds), df.where(~holds)


def in_lists(df: DataFrame, by: Sequence[str], name: str, size: int = LISTED) -> DataFrame:
    """(by, name): the other columns of each group's rows as structs in lists of about so many."""
    others = [c for c in df.columns if c not in by]
    largest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    part = F.pmod(F.xxhash64(*others), F.lit(max(1, -(-largest // size)))).alias("_part")
    return df.groupBy(*by, part).agg(F.collect_list(F.struct(*others)).alias(name)).drop("_part")


def with_lists(rows: DataFrame, lists: DataFrame, by: Sequence[str], name: str, *spread: str) -> DataFrame:
    """rows with each element of the lists that have their values of by: pairs are made after the join, so none is shuffled or sorted.

    Rows are dealt into blocks by columns, and each block gets every list once: a few blocks for each core, whatever the number of partitions. Partitions are
    by number: what is read is small beside the pairs. Lists are merged, not broadcast: copies for all blocks are larger than Spark takes them for.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = min(partitions, 2 * spark.sparkContext.defaultParallelism)
    there = rows.withColumn("_block", F.pmod(F.xxhash64(*spread), F.lit(blocks)).cast("int")).repartition(partitions, *by, "_block")
    met = there.join(lists.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).hint("merge"), [*by, "_block"])
    return met.select(*rows.columns, F.explode(name).alias("_one")).select(*rows.columns, "_one.*")


def all_pairs(asked: DataFrame, rows: DataFrame, *spread: str) -> DataFrame:
    """A stated set of queries against all rows, in blocks: rows are dealt out by columns, each block gets every query once, in lists."""
    return with_lists(rows, in_lists(asked, [], "_asked"), [], "_asked", *spread)


def checked_left_join(left: DataFrame, right: DataFrame, key: str, contract: str = "one_to_one") -> DataFrame:
    """A left join that fails while it runs if a side that should have unique keys has not."""

    def unique(df: DataFrame) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(key))
        return df.withColumn("_n", n).withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))).cast("long")).otherwise(F.col("_n"))).where("_n = 1").drop("_n")

    return (unique(left) if contract.startswith("one") else left).join(unique(right) if contract.endswith("one") else right, key, "left")


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """A left join on all columns that both have."""
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


def lookup(df: DataFrame, scores: DataFrame, keys: Sequence[str], value: str, default) -> DataFrame:
    """A value by one or more keys, or a default where there is none."""
    return df.join(scores.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, F.lit(default)))


def redirect(df: DataFrame, column: str, current: DataFrame, code: str, history: DataFrame, old: str, new: str) -> DataFrame:
    """A code that isn't current is replaced by what the history gives for it, if anything."""
    known = current.select(F.col(code).alias(column), F.lit(True).alias("_known"))
    moved = history.select(F.col(old).alias(column), F.col(new).alias("_new"))
    out = df.join(known, column, "left").join(moved, column, "left")
    return out.withColumn(column, F.when(F.col("_known").isNull() & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(column))).select(*df.columns)


def in_given_order(df: DataFrame, column: str, order: Sequence, place: str) -> DataFrame:
    """Rows whose column is in a sequence, with their place in it from 0."""
    at = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)).cast("int") - 1
    return df.withColumn(place, at).where(F.col(place) >= 0).orderBy(place)


def in_ranges(df: DataFrame, order: Sequence[str | Column], sums: Mapping[str, Column]) -> DataFrame:
    """Rows in a global order with running totals up to and with each, without bringing all rows to one task.

    Rows are range-partitioned and written; what comes before a partition is a sum over partitions, of which there are few.
    Values of the order should be distinct: rows that tie are in any order.
    """
    ranged = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    own = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    each = ranged.withColumns({n: F.sum(c).over(own) for n, c in sums.items()}).join(before, "_part")
    return each.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_part", "_at", *[f"_{n}" for n in sums])


def numbered(df: DataFrame, order: Sequence[str | Column], number: str, first: int = 1) -> DataFrame:
    """Rows numbered from first in a global order."""
    return in_ranges(df, order, {number: F.lit(1)}).withColumn(number, (F.col(number) + (first - 1)).cast("long"))


def batches(df: DataFrame, order: Sequence[str], size: int, batch: str) -> DataFrame:
    """Numbers of batches of equal size in a global order."""
    return numbered(df, order, batch, 0).withColumn(batch, F.floor(F.col(batch) / size))


def sample_at_most(df: DataFrame, key: str, n: int, multiplier: int = 7919, modulus: int = 10007) -> DataFrame:
    """n rows by a spread of their integer key: the same rows wherever and whenever it runs."""
    return df.orderBy((F.col(key) * multiplier) % modulus, key).limit(n)


def grouped_split(df: DataFrame, key: str, percent: int, part: str) -> DataFrame:
    """train or test by a spread of a key: rows that share the key stay together."""
    return df.withColumn(part, F.when((F.col(key) * SPREAD) % 100 < percent, "train").otherwise("test"))


def oversample(df: DataFrame, label: str, key: str, features: str, neighbours: int = 5, seed: int = 0) -> DataFrame:
    """(label, features, synthetic): df, and its smaller classes filled up to the largest with points between neighbours.

    A new point lies between a member and one of its nearest in the class by Euclidean distance (ties by key). Members take
    turns in a spread order of their keys; which neighbour and how far between them follow from key, turn and seed by whole-number
    arithmetic, so the same points come out wherever it runs. The numbering is by range partitions and the neighbours are
    searched by blocks: no class comes to one task. Keys are unique whole numbers; classes are few; a class of one member
    is repeated; rows without a label, key or features stay as they are and make no points.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(key).isNotNull() & F.col(features).isNotNull()).select(F.col(label).alias("_label"), F.col(key).cast("long").alias("_key"), F.col(features).alias("_x"))
    sizes = rows.groupBy("_label").agg(F.count("*").alias("_n"))
    most = sizes.agg(F.max("_n").alias("_most"))
    placed = numbered(rows.withColumn("_spread", (F.col("_key") * 7919) % 10007), ["_label", "_spread", "_key"], "_place", 0)
    firsts = placed.groupBy("_label").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    turns = placed.join(F.broadcast(firsts), "_label").join(F.broadcast(most))  # as many rows as classes, and one
    place, missing = F.col("_place") - F.col("_first"), F.col("_most") - F.col("_n")
    turns = turns.withColumn("_turns", F.floor((missing - place - 1) / F.col("_n")) + 1).where("_turns > 0")
    near = nearest(rows, rows, "_key", "_x", neighbours, metric="euclidean", within="_label")
    lists = near.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("_key").alias("other")))).alias("_near"))
    new = turns.join(lists, F.col("_key") == F.col("query_id"), "left").withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_turns").cast("long"))))
    number = F.pmod(F.col("_key") * SPREAD + F.col("_turn") * 97003 + seed, F.lit(1_000_003))
    size = F.coalesce(F.nullif(F.size("_near"), F.lit(-1)), F.lit(0))
    new = new.withColumns({"_number": number, "_other": F.when(size > 0, F.get("_near", (number % size).cast("int"))["other"]).otherwise(F.col("_key"))})
    ends = rows.select(F.col("_key").alias("_other"), F.col("_x").alias("_y"))
    share = F.floor(F.col("_number") / 7) % 1000 / 1000.0
    between = F.zip_with("_x", "_y", lambda a, b: a + (b - a) * share)
    made = new.join(ends, "_other").select(F.col("_label").alias(label), between.alias(features), F.lit(True).alias("synthetic"))
    return df.select(label, features, F.lit(False).alias("synthetic")).union(made)
