"""Decisions, whole flows, streaming and campaign reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.operators import decisions, metrics, ranking, relational
from lexisift.operators import search as S
from lexisift.plans.registry import query
from lexisift.plans.search import CTES, Register, _top
from lexisift.sources.shared import fresh_path, written
from lexisift.streaming import publication

SIMILAR = "SELECT q, k AS key, round(1e0 / (1 + abs(qs - ks)), 6) AS similarity FROM pairs"
ECHO = " UNION ALL ".join(f"SELECT q, key, score FROM ({_top(c).removeprefix(CTES)})" for c in ("SELECT * FROM s_name", "SELECT * FROM s_type", "SELECT * FROM code"))
FINAL = f"{CTES}, e AS ({ECHO}), c AS (SELECT q, key, count(*) AS nb FROM e GROUP BY 1, 2), f AS (SELECT c.q, c.key, similarity, nb, CASE WHEN qb = kb THEN 1e0 ELSE 0e0 END AS activity, round(similarity + 0.1e0 * nb + 0.3e0 * CASE WHEN qb = kb THEN 1e0 ELSE 0e0 END, 6) AS final FROM c JOIN ({SIMILAR}) s ON c.q = s.q AND c.key = s.key JOIN pairs p ON c.q = p.q AND c.key = p.k WHERE c.q <> c.key)"


def _candidates(t):
    r = Register(t)
    found = written(S.without_self(S.echoes({"name": r.best("name"), "type": r.best("type"), "code": S.top(r.codes())})), "echoes")
    both = found.select("q", "key").distinct().join(r.parts.select(F.col("p_partkey").alias("q"), F.col("p_size").alias("qs"), F.col("p_brand").alias("qb")), "q")
    sizes = both.join(r.parts.select(F.col("p_partkey").alias("key"), F.col("p_size").alias("ks"), F.col("p_brand").alias("kb")), "key")
    similar = sizes.select("q", "key", F.round(1.0 / (1 + F.abs(F.col("qs") - F.col("ks"))), 6).alias("similarity"))
    return decisions.score_candidates(found, similar, sizes.where("qb = kb").select("q", "key", F.lit(1.0).alias("activity")), 0.1, 0.3)


query("Flow1_candidates", f"{FINAL} SELECT q, key, similarity, nb, activity, final, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY final DESC, key) AS rank FROM f) WHERE rank <= 10")(_candidates)
query("K7_acceptance_features", f"{FINAL}, r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY final DESC, key) AS rank FROM f) SELECT q, " + ", ".join(f"coalesce(max(CASE WHEN rank = {i} THEN CAST({c} AS DOUBLE) END), 0) AS {c}_{i}" for i in (1, 2) for c in ("activity", "nb", "similarity", "final")) + ", round(coalesce(max(CASE WHEN rank = 1 THEN final END), 0) - coalesce(max(CASE WHEN rank = 2 THEN final END), 0), 6) AS gap FROM r GROUP BY q")(
    lambda t: decisions.decision_features(_candidates(t)).withColumn("gap", F.round("gap", 6))
)


@query("K7_accepted_answers")
def _(t):
    """A fitted acceptance model's decisions, also on returns that it didn't see (held_out); no SQL fits a model.

    An answer is right if it is of the type that the return has, which no feature tells alone. Two thirds of the returns are learned from.
    """
    found = written(_candidates(t), "candidates")
    rows = decisions.decision_features(found).join(found.where("rank = 1").select("q", "key"), "q")
    truth = t.part.select(F.col("p_partkey").alias("q"), F.col("p_type").alias("own"))
    other = t.part.select(F.col("p_partkey").alias("key"), F.col("p_type").alias("found"))
    rows = rows.join(truth, "q").join(other, "key").withColumn("right", (F.col("own") == F.col("found")).cast("double"))
    learned, held = relational.split(rows, F.col("q") / 100 % 3 < 2)
    both = learned.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))
    judged = decisions.accept(both, decisions.fit_acceptance(learned, "right"))
    return judged.select("q", "key", F.round("probability_1", 6).alias("probability"), "accepted", (F.col("right") == 1).alias("right"), "held_out")


@query("K8_top1_validator")
def _(t):
    """A classifier over scores of the first answers, swept over twenty thresholds on groups that it didn't see; no SQL fits a model."""
    ranked = ranking.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 2)
    first = ranked.where("rank = 1").select("o_custkey", (F.col("o_orderstatus") == "F").cast("double").alias("right"))
    rows = ranking.gap_features(ranked, ["o_custkey"], "o_totalprice").fillna(0.0).join(first, "o_custkey")
    names = ["score1", "score2", "diff", "normdiff", "ratio"]
    learned, held = relational.split(rows, F.col("o_custkey") % 3 < 2)
    judged = decisions.accept(held, decisions.fit_acceptance(learned, "right", names), 0.5, names)
    swept = metrics.threshold_sweep(judged, "probability_1", F.col("right") == 1, [i / 20.0 for i in range(20)])
    return swept.select("threshold", F.round("coverage", 6).alias("coverage"), F.round("precision", 6).alias("precision"))


query("K11_non_codable", "SELECT doc_id, round(least(n_chars / 5000.0, 1.0), 2) >= 0.5 AS non_codable FROM documents")(
    lambda t: decisions.non_codable(t.documents.withColumn("p", F.round(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)), 2)), "p").select("doc_id", "non_codable")
)
query("K12_rows_from_one", "SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word FROM part")(lambda t: t.part.select("p_partkey", F.explode(F.split("p_type", " ")).alias("word")))


GRID = [(b / 10, g) for b in range(6) for g in range(-3, 4)]
_PAIRS = "SELECT b / 10e0 AS beta, CAST(g AS DOUBLE) AS gamma FROM range(0, 6) x(b), range(-3, 4) y(g)"
_RUNG = "SELECT beta, gamma, count(*) FILTER (best = truth) AS hits FROM (SELECT beta, gamma, l_orderkey, arg_max(l_linenumber, (s, -l_linenumber)) AS best, any_value(truth) AS truth FROM (SELECT c.*, beta, gamma, l_discount + beta * l_tax + gamma * (l_quantity / 50e0) AS s FROM c, {pairs} WHERE l_orderkey % {share} = 0) GROUP BY 1, 2, 3) GROUP BY 1, 2"


@query(
    "K9_parameter_search",
    f"WITH c AS (SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_quantity, arg_max(l_linenumber, (l_extendedprice, -l_linenumber)) OVER (PARTITION BY l_orderkey) AS truth FROM lineitem), g AS ({_PAIRS}), one AS ({_RUNG.format(pairs='g', share=16)}), two AS (SELECT beta, gamma FROM one ORDER BY hits DESC, beta, gamma LIMIT 11), three AS ({_RUNG.format(pairs='two', share=4)}), four AS (SELECT beta, gamma FROM three ORDER BY hits DESC, beta, gamma LIMIT 3), five AS ({_RUNG.format(pairs='four', share=1)}) SELECT CAST(row_number() OVER (ORDER BY hits DESC, beta, gamma) AS INTEGER) AS rank, beta, gamma, hits FROM five",
)
def _(t):
    """The coefficients of three signals by which the dearest line of an order comes first most often, by successive halving."""
    rows = t.lineitem.select("l_orderkey", F.struct(F.col("l_extendedprice").alias("price"), (-F.col("l_linenumber")).alias("line")).alias("dear"), F.struct(F.col("l_discount").alias("similarity"), F.col("l_tax").alias("found"), (F.col("l_quantity") / 50).alias("activity"), F.col("l_linenumber").alias("key")).alias("c"))
    lists = rows.groupBy("l_orderkey").agg(F.max("dear").alias("dear"), F.collect_list("c").alias("c"))
    candidates = F.transform("c", lambda c: F.struct(c["similarity"].alias("similarity"), c["found"].alias("found"), c["activity"].alias("activity"), c["key"].alias("key"), (c["key"] == -F.col("dear.line")).alias("right")))
    found = decisions.halving_search(written(lists.select("l_orderkey", candidates.alias("candidates")), "candidate-lists"), "l_orderkey", "candidates", GRID)
    return t.spark.createDataFrame([(i, b, g, n) for i, (b, g, n) in enumerate(found, 1)], "rank int, beta double, gamma double, hits long")


def _events(t):
    path = fresh_path(t.spark, "events")
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    rows.repartition(3, "event_id").write.parquet(path)
    return publication.file_stream(t.spark, path, rows.schema), rows


@query("R1_published_records", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def _(t):
    """Records of a stream, the last of each user by id, in the index after all batches."""
    path, target = fresh_path(t.spark, "validated"), fresh_path(t.spark, "published")
    rows = t.events.select("user_id", "event_id", F.col("event_id").alias("published"))
    # three files, one a batch
    for i in range(3):
        rows.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(path)
    stream = publication.file_stream(t.spark, path, rows.schema)
    publication.publish(stream, target, fresh_path(t.spark, "published-state"), "user_id").awaitTermination()
    return publication.latest(t.spark, target, "user_id").select("user_id", "event_id")


WEEK = "strftime(date_trunc('week', ts), '%Y-%m-%d')"


@query("R2_weekly_series", f"SELECT {WEEK} AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    stream, _ = _events(t)
    return publication.complete_counts(publication.weekly_counts(stream, "ts", ("event_type",)), "weekly")


query("R2_weekly_series_of_table", f"SELECT {WEEK} AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")(lambda t: publication.weekly_counts(t.events, "ts", ("event_type",)))
query("R3_campaign_counters", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS large FROM events GROUP BY 1")(
    lambda t: publication.complete_counts(metrics.conditional_counts(_events(t)[0], ["event_type"], {"n": F.lit(True), "large": F.col("value") > 50}), "campaign")
)
query("R4_open_to_close", "SELECT user_id, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 3) AS seconds FROM events GROUP BY 1")(
    lambda t: t.events.groupBy("user_id").agg(F.round(F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6, 3).alias("seconds"))
)

# shapes of campaign reports

query("Shape6_hardest_names", "SELECT c_mktsegment, count(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IS NULL GROUP BY 1 ORDER BY n DESC")(
    lambda t: t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
)
query("Shape7_collection_modes", "SELECT o_orderpriority, count(*) AS every, count(*) FILTER (o_orderstatus <> 'F') AS open FROM orders GROUP BY 1")(
    lambda t: metrics.conditional_counts(t.orders, ["o_orderpriority"], {"every": F.lit(True), "open": F.col("o_orderstatus") != "F"})
)
query("Shape9_two_vocabularies", "SELECT DISTINCT p_brand AS name FROM part UNION SELECT DISTINCT c_mktsegment FROM customer")(lambda t: t.part.select(F.col("p_brand").alias("name")).union(t.customer.select("c_mktsegment")).distinct())
query(
    "P20_comparison_flags",
    "WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_discount > 0.05 AS auto, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber % 7 * 2 END AS rank FROM lineitem) SELECT count(*) FILTER (auto AND rank = 0) AS encoded_correctly, count(*) FILTER (auto AND rank > 0) AS encoded_incorrectly, count(*) FILTER (rank = 0) AS top1, count(*) FILTER (rank < 5) AS top5, count(*) FILTER (rank < 10) AS top10, count(*) FILTER (rank = 10) AS not_found, count(*) FILTER (rank IS NULL) AS not_calculated FROM r",
)(lambda t: _comparison(t))


def _comparison(t):
    rank, auto = F.col("rank"), F.col("auto")
    rows = t.lineitem.select((F.col("l_discount") > 0.05).alias("auto"), F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") % 7 * 2).alias("rank"))
    return metrics.conditional_counts(rows, [], {"encoded_correctly": auto & (rank == 0), "encoded_incorrectly": auto & (rank > 0), "top1": rank == 0, "top5": rank < 5, "top10": rank < 10, "not_found": rank == 10, "not_calculated": rank.isNull()})
