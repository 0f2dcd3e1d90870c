"""Dates, numbers, coordinates and token arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARTH_METRES = 6371008.8


def seconds_between(start: Column, end: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return micros(end) / 1e6 - micros(start) / 1e6


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / 2


def grid(spark: SparkSession, first: float, last: float, n: int) -> DataFrame:
    """n numbers from first to last at equal steps."""
    return spark.range(n).select((first + F.col("id") * ((last - first) / max(n - 1, 1))).alias("x"))


def argmax(c: Column) -> Column:
    """0-based place of the largest item, the first on ties."""
    return F.array_position(c, F.array_max(c)).cast("int") - 1


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns less their mean, over their deviation; a constant column becomes 0."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = df.join(F.broadcast(stats))  # one row
    return joined.withColumns({c: F.coalesce((F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(0.0)) for c in columns}).select(*df.columns)


def lengths(column: str) -> Column:
    return F.transform(F.split(column, " "), lambda w: F.char_length(w))


def text_of(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: x.cast("string")), ",")


def pad(items: Column, n: int, value: int = 0) -> Column:
    """The first n items, filled up to n."""
    return F.slice(F.concat(items, F.array_repeat(F.lit(value).cast("int"), n)), 1, n)


def field_numbers(*fields: Column) -> Column:
    """For each token of the fields in turn, the number of its field from 1."""
    return F.concat(*[F.array_repeat(F.lit(i), F.size(f)) for i, f in enumerate(fields, 1)])


def positions(*fields: Column) -> Column:
    """For each token of the fields in turn, its place in its field from 1."""
    return F.concat(*[F.transform(f, lambda w, i: i + 1) for f in fields])


def lookup(c: Column, table: Mapping[str, int], default: int) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, c), F.lit(default))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points given in degrees."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_METRES * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def parse_point(c: Column) -> Column:
    """A point from "lat, lon"; null where it is malformed or out of range."""
    parts = F.split(c, ",")
    lat, lon = (F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))
    return F.when((F.size(parts) == 2) & lat.between(-90, 90) & lon.between(-180, 180), F.struct(lat.alias("lat"), lon.alias("lon")))
