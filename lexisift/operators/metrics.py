"""Counters, accuracy curves, confusion rates and threshold searches, as aggregations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.operators.relational import in_ranges


def conditional_counts(df: DataFrame, keys: Sequence[str], tests: Mapping[str, Column]) -> DataFrame:
    """One count per test and group, in one pass."""
    counts = [F.count(F.when(t, 1)).alias(n) for n, t in tests.items()]
    return df.groupBy(*keys).agg(*counts) if keys else df.agg(*counts)


def batch_counters(df: DataFrame, keys: Sequence[str], first: str, second: str) -> DataFrame:
    """The nine counters of a work batch over two status columns: N none, A waiting, V done, null not asked."""
    a, b = F.col(first), F.col(second)
    done = ((a == "V") & (b == "V")) | ((a == "V") & b.isNull()) | (a.isNull() & (b == "V"))
    return conditional_counts(
        df,
        keys,
        {
            "nb_all": F.lit(True), "nb_first": a.isNotNull(), "nb_first_wait": a == "A", "nb_first_done": a == "V",
            "nb_second": b.isNotNull(), "nb_second_wait": b == "A", "nb_second_done": b == "V",
            "nb_wait": F.coalesce(a == "A", F.lit(False)) | F.coalesce(b == "A", F.lit(False)), "nb_done": done,
        },
    )


def reconcile(stored: DataFrame, counted: DataFrame, key: str, counters: Sequence[str], status: str, total: str, done: str, closed: str = "T") -> DataFrame:
    """Stored counters against counted ones: whether any is wrong, and the status, closed where all is done and one was wrong."""
    both = stored.join(counted.withColumnsRenamed({c: f"{c}_counted" for c in counters}), key, "left")
    wrong = F.lit(False)
    for c in counters:
        wrong = wrong | ~F.col(c).eqNullSafe(F.coalesce(F.col(f"{c}_counted"), F.lit(0)))
    closes = wrong & (F.col(f"{total}_counted") == F.col(f"{done}_counted")) & (F.col(status) != closed)
    return both.select(key, wrong.alias("wrong"), F.when(F.coalesce(closes, F.lit(False)), F.lit(closed)).otherwise(F.col(status)).alias(status))


def topk_curve(df: DataFrame, rank: str, k: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose 1-based rank is at most 1..k; ranks below 1 or null are misses."""
    hits = [F.count(F.when((F.col(rank) > 0) & (F.col(rank) <= i), 1)).alias(f"h{i}") for i in range(1, k + 1)]
    n = df.groupBy(*keys).agg(F.count("*").alias("n"), *hits)
    rows = F.array(*[F.struct(F.lit(i).alias("k"), (F.col(f"h{i}") / F.col("n")).alias("accuracy")) for i in range(1, k + 1)])
    return n.select(*keys, F.inline(rows))


def podium(df: DataFrame, rank: str, places: Sequence[int]) -> DataFrame:
    """Cumulated counts of ranks up to each place, and how many were not found (place null)."""
    tests = {f"p{p}": (F.col(rank) > 0) & (F.col(rank) <= p) for p in places} | {"none": ~F.coalesce(F.col(rank) > 0, F.lit(False))}
    one = conditional_counts(df, [], tests)
    return one.select(F.inline(F.array(*[F.struct(F.lit(p).alias("place"), F.col(f"p{p}").alias("n")) for p in places], F.struct(F.lit(None).cast("int").alias("place"), F.col("none").alias("n")))))


def confusion(df: DataFrame, truth: Column, predicted: Column, probability: Column | None = None) -> DataFrame:
    """Cells of a binary confusion matrix and the rates derived from them; a rate over nothing is null."""
    counts = conditional_counts(df, [], {"tp": truth & predicted, "fp": ~truth & predicted, "fn": truth & ~predicted, "tn": ~truth & ~predicted})
    over = lambda a, b: a / F.nullif(b, F.lit(0).cast("long"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    beta = lambda b: over((1 + b * b) * tp, ((1 + b * b) * tp + b * b * fn + fp).cast("long")) if b == int(b) else (1 + b * b) * tp / F.nullif((1 + b * b) * tp + b * b * fn + fp, F.lit(0.0))
    rates = {
        "tpr": over(tp, tp + fn), "fnr": over(fn, tp + fn), "tnr": over(tn, tn + fp), "fpr": over(fp, tn + fp), "ppv": over(tp, tp + fp), "fdr": over(fp, tp + fp),
        "npv": over(tn, tn + fn), "accuracy": over(tp + tn, tp + fp + fn + tn), "f1": over(2 * tp, 2 * tp + fp + fn), "f2": beta(2), "f05": beta(0.5),
    }
    out = counts.select("tp", "fp", "fn", "tn", *[v.alias(k) for k, v in rates.items()])
    if probability is None:
        return out
    p = F.greatest(F.least(probability, F.lit(1 - 1e-15)), F.lit(1e-15))
    scores = df.agg(F.avg(-F.when(truth, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"), F.avg(F.pow(probability - truth.cast("double"), 2)).alias("brier"))
    return out.join(F.broadcast(scores))  # both are one row


def score_steps(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """Cumulated positives and negatives from the highest score down, one row for each distinct score."""
    by = df.groupBy(score).agg(F.count(F.when(truth, 1)).alias("p"), F.count(F.when(~truth, 1)).alias("n"))
    every = by.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    return in_ranges(by, [F.desc(score)], {"tp": F.col("p"), "fp": F.col("n")}).join(F.broadcast(every))  # one row


def curves(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """Precision, recall and false positive rate at each distinct score."""
    s = score_steps(df, score, truth)
    return s.select(score, (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.nullif(F.col("positives"), F.lit(0).cast("long"))).alias("recall"), (F.col("fp") / F.nullif(F.col("negatives"), F.lit(0).cast("long"))).alias("fpr"))


def areas(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """ROC area by trapezoids (ties count half) and average precision."""
    s = score_steps(df, score, truth)
    s = s.withColumns({"tp0": F.col("tp") - F.col("p"), "fp0": F.col("fp") - F.col("n")})
    roc = F.sum((F.col("fp") - F.col("fp0")) * (F.col("tp") + F.col("tp0")) / 2.0) / F.max(F.col("positives") * F.col("negatives"))
    ap = F.sum((F.col("tp") - F.col("tp0")) / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return s.agg(roc.alias("roc_auc"), ap.alias("average_precision"))


def threshold_sweep(df: DataFrame, score: str, truth: Column, thresholds: Sequence[float]) -> DataFrame:
    """Coverage and precision of the rows at or above each threshold, all in one pass."""
    cells = []
    for i, t in enumerate(thresholds):
        kept = F.col(score) >= t
        cells += [F.count(F.when(kept, 1)).alias(f"n{i}"), F.count(F.when(kept & truth, 1)).alias(f"p{i}")]
    one = df.agg(F.count("*").alias("total"), *cells)
    rows = [F.struct(F.lit(t).alias("threshold"), (F.col(f"n{i}") / F.col("total")).alias("coverage"), (F.col(f"p{i}") / F.nullif(F.col(f"n{i}"), F.lit(0).cast("long"))).alias("precision")) for i, t in enumerate(thresholds)]
    return one.select(F.inline(F.array(*rows)))


def best_threshold(df: DataFrame, score: str, truth: Column, least_precision: float, default: float = 0.5) -> DataFrame:
    """The threshold of largest recall among those of enough precision, the first on ties; a default if none has."""
    c = curves(df, score, truth).where(F.col("precision") >= least_precision)
    return c.agg(F.coalesce(F.max_by(F.col(score), F.struct(F.col("recall"), -F.col(score))), F.lit(default)).alias("threshold"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (k * n_c) for each class."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("all"), F.count("*").alias("k"))
    return sizes.join(F.broadcast(total)).select(label, (F.col("all") / (F.col("k") * F.col("n"))).alias("weight"))


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Counts, shares and cumulated shares of a column's values, most frequent first."""
    counts = (df.where(F.col(column).isNotNull()) if dropna else df).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return in_ranges(counts, [F.desc("n"), F.col(column)], {"cumulated": F.col("n")}).join(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("all")).alias("share"), (F.col("cumulated") / F.col("all")).alias("cumulated_share"))


#: Values that are fetched at once for a rank, and ranges that one pass counts.
FETCHED, RANGES = 10_000, 64


def value_at_rank(df: DataFrame, column: str, rank: int) -> float:
    """The value at a rank from 0 among a column's non-null values in order; exact, without sorting them in one task.

    Approximate percentiles cut the values into ranges of about equal counts, which are then counted exactly; the search goes
    on in the range that holds the rank, until it has few values or only one.
    """
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    while True:
        low, high, n = rows.agg(F.min("v"), F.max("v"), F.count("*")).first()
        if low == high:
            return low
        if n <= FETCHED:
            return rows.orderBy("v").limit(rank + 1).agg(F.max("v")).first()[0]
        cuts = sorted({*rows.agg(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], 10_000)).first()[0]} - {high})
        counted = rows.agg(*[F.count(F.when(F.col("v") <= c, 1)).alias(f"c{i}") for i, c in enumerate(cuts)]).first() if cuts else []
        below = [(c, v) for c, v in zip(cuts, counted, strict=True) if v <= rank]
        above = [c for c, v in zip(cuts, counted, strict=True) if v > rank]
        start, skipped = below[-1] if below else (None, 0)
        end = above[0] if above else high
        narrower = rows.where(F.col("v") <= end) if start is None else rows.where((F.col("v") > start) & (F.col("v") <= end))
        if start is None and end == high:  # no cut but the largest value: it has most of the rows
            largest = rows.where(F.col("v") == high).count()
            if rank >= n - largest:
                return high
            narrower = rows.where(F.col("v") < high)
        rows, rank = narrower, rank - skipped


def exact_quantiles(df: DataFrame, column: str, at: Mapping[str, float]) -> dict[str, float | None]:
    """Quantiles by name, between the two values beside each by its share; None of an empty column."""
    n = df.where(F.col(column).isNotNull()).count()
    found: dict[int, float] = {}

    def value(rank: int) -> float:
        if rank not in found:
            found[rank] = value_at_rank(df, column, rank)
        return found[rank]

    out = {}
    for name, p in at.items():
        place = p * (n - 1)
        low = math.floor(place)
        out[name] = None if not n else value(low) + (value(min(low + 1, n - 1)) - value(low)) * (place - low)
    return out
