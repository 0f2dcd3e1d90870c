"""Decisions: acceptance of top answers, non-codable returns, and the establishment flow end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.operators import ranking

FEATURES = ("activity_1", "activity_2", "nb_1", "nb_2", "similarity_1", "similarity_2", "final_1", "final_2", "gap")


def score_candidates(echoes: DataFrame, similarities: DataFrame, activities: DataFrame, beta: float = 0.0, gamma: float = 0.0, k: int = 10) -> DataFrame:
    """q, key, similarity, nb, activity, final, rank: candidates scored by similarity, how often they were found, and activity.

    echoes (q, key, template, score), similarities (q, key, similarity), activities (q, key, activity). Candidates
    without a similarity are dropped, without an activity they count 0.
    """
    counts = echoes.groupBy("q", "key").agg(F.count("*").alias("nb"))
    joined = counts.join(similarities, ["q", "key"]).join(activities, ["q", "key"], "left").withColumn("activity", F.coalesce("activity", F.lit(0.0)))
    scored = joined.withColumn("final", F.round(F.col("similarity") + beta * F.col("nb") + gamma * F.col("activity"), 6))
    return ranking.top_k(scored, ["q"], [F.desc("final"), F.col("key")], k)


def decision_features(top: DataFrame) -> DataFrame:
    """One row for each q with the nine features of its first two candidates; missing ones are 0."""
    two = ranking.wide(top.where("rank <= 2"), ["q"], ["activity", "nb", "similarity", "final"], 2)
    named = {f"{f}_{i}": F.coalesce(F.col(f"top_{i}_{f}").cast("double"), F.lit(0.0)) for i in (1, 2) for f in ("activity", "nb", "similarity", "final")}
    return two.select("q", *[c.alias(n) for n, c in named.items()]).withColumn("gap", F.col("final_1") - F.col("final_2"))


def fit_acceptance(df: DataFrame, label: str, features: Sequence[str] = FEATURES):
    """A logistic model of whether the first answer is right."""
    rows = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)
    return LogisticRegression(featuresCol="_features", labelCol=label, maxIter=30, regParam=0.01).fit(rows)


def accept(df: DataFrame, model, threshold: float = 0.5, features: Sequence[str] = FEATURES) -> DataFrame:
    """Probability, and whether it reaches the threshold."""
    rows = model.transform(VectorAssembler(inputCols=list(features), outputCol="_features").transform(df))
    return rows.withColumn("probability_1", F.get(vector_to_array("probability"), F.lit(1))).withColumn("accepted", F.col("probability_1") >= threshold).drop("_features", "rawPrediction", "probability", "prediction")


def non_codable(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    """Whether a return can't be coded; a null probability leaves it undecided."""
    return df.withColumn("non_codable", F.col(probability) >= threshold)


def grid_hits(lists: DataFrame, candidates: str, grid: Sequence[tuple[float, float]]) -> list[int]:
    """For how many lists the best candidate is right, by pair of coefficients; all pairs in one pass, without a row for each.

    candidates: an array of struct(similarity, found, activity, key, right); the best has the largest similarity + beta * found +
    gamma * activity, ties by the smallest key. Empty and null lists have none.
    """
    pairs = F.array(*[F.struct(F.lit(float(b)).alias("beta"), F.lit(float(g)).alias("gamma")) for b, g in grid])

    def best(p: Column) -> Column:
        rated = F.transform(candidates, lambda c: F.struct((c["similarity"] + p["beta"] * c["found"] + p["gamma"] * c["activity"]).alias("score"), (-c["key"]).alias("key"), c["right"].alias("right")))
        return F.coalesce(F.array_max(rated)["right"], F.lit(False)).cast("long")

    hits = lists.select(F.posexplode(F.transform(pairs, best)).alias("pair", "hit")).groupBy("pair").agg(F.sum("hit").alias("hits")).collect()  # a row for each pair
    return [dict(hits).get(i, 0) for i in range(len(grid))]


def halving_search(lists: DataFrame, key: str, candidates: str, grid: Sequence[tuple[float, float]], rungs: int = 3, eta: int = 4) -> list[tuple[float, float, int]]:
    """(beta, gamma, hits) of the coefficients that come through successive halving, best first.

    The first rung scores the whole grid on lists whose key is divisible by eta to the power rungs - 1, each later one the best
    1 / eta of the pairs before on eta times as many, the last on all lists: samples are nested, and each rung is one
    aggregation. Ties go to the smaller beta and then gamma; one pair stays at least. key: a whole number.
    """
    left = sorted({(float(b), float(g)) for b, g in grid})
    for rung in range(rungs):
        share = eta ** (rungs - 1 - rung)
        hits = grid_hits(lists.where(F.col(key) % share == 0), candidates, left)
        ranked = sorted(zip(left, hits, strict=True), key=lambda x: (-x[1], x[0]))
        if rung == rungs - 1:
            return [(b, g, n) for (b, g), n in ranked]
        left = sorted(pair for pair, _ in ranked[: max(1, -(-len(left) // eta))])
    return []
