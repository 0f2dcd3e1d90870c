"""A geocoding decision over what several services answered, as one ordered list of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.30
SURE = 0.9
PREFERENCE = 1.2


def normalised_kind(c: Column) -> Column:
    return F.when(c.isin("village", "town", "city"), "municipality").when(c == "place", "locality").otherwise(c)


def decide(df: DataFrame) -> DataFrame:
    """longitude, latitude, score, kind and the rule that gave them, for each row.

    df has the key columns, ``commune``, ``c_lat`` and ``c_lon`` (the commune's centre, null if unknown), and for each of
    the two services a and b ``{s}_lat, {s}_lon, {s}_score, {s}_kind`` (null if it found nothing); ``before_*`` and
    ``after_*`` are answers for the numbers two below and above; ``poi_*`` a point of interest. Absent columns count
    as null. The first rule that holds wins; an ill-formed commune gives an empty row with score 0.
    """
    for s in ("a", "b", "before", "after", "poi"):
        for c, t in (("lat", "double"), ("lon", "double"), ("score", "double"), ("kind", "string")):
            if f"{s}_{c}" not in df.columns:
                df = df.withColumn(f"{s}_{c}", F.lit(None).cast(t))
    kind = lambda s: normalised_kind(F.col(f"{s}_kind"))
    score = lambda s: F.coalesce(F.col(f"{s}_score"), F.lit(0.0))
    is_ = lambda s, k: F.coalesce(kind(s) == k, F.lit(False))
    of = lambda s, rule: F.struct(F.col(f"{s}_lon").alias("longitude"), F.col(f"{s}_lat").alias("latitude"), F.round(score(s), 2).alias("score"), kind(s).alias("kind"), F.lit(rule).alias("rule"))
    middle = F.struct(
        F.round((F.col("before_lon") + F.col("after_lon")) / 2, 6).alias("longitude"), F.round((F.col("before_lat") + F.col("after_lat")) / 2, 6).alias("latitude"),
        F.round((score("before") + score("after")) / 2, 2).alias("score"), F.lit("interpolation").alias("kind"), F.lit("between").alias("rule"),
    )
    nothing = F.struct(F.lit(None).cast("double").alias("longitude"), F.lit(None).cast("double").alias("latitude"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("kind"), F.lit("no commune").alias("rule"))
    centre = F.struct(F.col("c_lon").alias("longitude"), F.col("c_lat").alias("latitude"), F.lit(0.0).alias("score"), F.lit("municipality").alias("kind"), F.lit("centre").alias("rule"))
    good = lambda s: score(s) > LEAST
    rules = F.when(~F.coalesce(F.col("commune").rlike("^[0-9]{5}$"), F.lit(False)), nothing)
    for level in ("housenumber", "street"):
        both = is_("a", level) & is_("b", level)
        rules = rules.when(both & good("a") & (score("a") >= score("b") / PREFERENCE), of("a", f"a {level}"))
        rules = rules.when(is_("a", level) & good("a") & ~both, of("a", f"a {level}")).when(is_("b", level) & good("b"), of("b", f"b {level}"))
        if level == "housenumber":
            rules = rules.when(is_("before", level) & is_("after", level) & (score("before") > 0.5) & good("after"), middle)
    rules = rules.when(good("a"), of("a", "a any")).when(good("b"), of("b", "b any")).when(score("poi") > 0.7, of("poi", "point of interest")).otherwise(centre)
    return df.withColumn("_g", rules).select("*", "_g.*").drop("_g")
