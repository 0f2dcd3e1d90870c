"""Counts, rates, curves and quantiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexisift.operators import metrics, vectors
from lexisift.plans.registry import query


@query("A1_global_count", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.where("o_orderstatus = 'F'").agg(F.count("*").alias("n"))


@query("A2_group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"))


@query("A3_count_of_column", "SELECT nullif(l_returnflag, 'N') AS flag, count(nullif(l_returnflag, 'N')) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag")).groupBy("flag").agg(F.count("flag").alias("n"))


@query("A4_value_counts", "SELECT c_mktsegment, n, round(n / sum(n) OVER (), 6) AS share, round(sum(n) OVER (ORDER BY n DESC, c_mktsegment) / sum(n) OVER (), 6) AS cumulated_share FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)")
def _(t):
    return metrics.value_counts(t.customer, "c_mktsegment").withColumns({c: F.round(c, 6) for c in ("share", "cumulated_share")})


@query("A5_size_and_pivot", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)


@query("A6_count_all_columns", "SELECT l_linestatus, count(nullif(l_returnflag, 'N')) AS flags, count(l_orderkey) AS orders FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.withColumn("flags", F.nullif(F.col("l_returnflag"), F.lit("N"))).groupBy("l_linestatus").agg(F.count("flags").alias("flags"), F.count("l_orderkey").alias("orders"))


@query("A7_distinct_and_null_share", "SELECT count(DISTINCT nullif(l_returnflag, 'N')) AS n_distinct, count(*) FILTER (l_returnflag = 'N') AS n_null, round(avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END), 6) AS null_share FROM lineitem")
def _(t):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return t.lineitem.agg(F.countDistinct(flag).alias("n_distinct"), F.count(F.when(flag.isNull(), 1)).alias("n_null"), F.round(F.avg(flag.isNull().cast("double")), 6).alias("null_share"))


STATUSES = "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'V' END AS first, CASE WHEN l_linestatus = 'O' THEN 'V' WHEN l_linenumber % 2 = 0 THEN 'A' END AS second FROM lineitem"
COUNTERS = ["nb_all", "nb_first", "nb_first_wait", "nb_first_done", "nb_second", "nb_second_wait", "nb_second_done", "nb_wait", "nb_done"]
COUNTERS_SQL = f"""SELECT l_orderkey, count(*) AS nb_all, count(first) AS nb_first, count(*) FILTER (first = 'A') AS nb_first_wait, count(*) FILTER (first = 'V') AS nb_first_done,
count(second) AS nb_second, count(*) FILTER (second = 'A') AS nb_second_wait, count(*) FILTER (second = 'V') AS nb_second_done, count(*) FILTER (first = 'A' OR second = 'A') AS nb_wait,
count(*) FILTER ((first = 'V' AND second = 'V') OR (first = 'V' AND second IS NULL) OR (first IS NULL AND second = 'V')) AS nb_done FROM ({STATUSES}) GROUP BY l_orderkey"""


def _statuses(t):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(flag == "A", "A").when(flag == "R", "V").alias("first"), F.when(status == "O", "V").when(F.col("l_linenumber") % 2 == 0, "A").alias("second"))


@query("A8_batch_counters", COUNTERS_SQL)
def _(t):
    return metrics.batch_counters(_statuses(t), ["l_orderkey"], "first", "second")


@query("A9_wave_counters", "SELECT o_custkey, count(*) AS nb_lots, count(*) FILTER (o_orderstatus = 'O') AS nb_open, count(*) FILTER (o_orderstatus = 'F') AS nb_closed FROM orders GROUP BY 1")
def _(t):
    status = F.col("o_orderstatus")
    return metrics.conditional_counts(t.orders, ["o_custkey"], {"nb_lots": F.lit(True), "nb_open": status == "O", "nb_closed": status == "F"})


@query(
    "A10_reconciliation",
    f"WITH c AS ({COUNTERS_SQL}), s AS (SELECT l_orderkey, nb_all + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS nb_all, nb_done, 'E' AS status FROM c) SELECT s.l_orderkey, s.nb_all <> c.nb_all AS wrong, CASE WHEN s.nb_all <> c.nb_all AND c.nb_all = c.nb_done THEN 'T' ELSE status END AS status FROM s JOIN c USING (l_orderkey)",
)
def _(t):
    counted = metrics.batch_counters(_statuses(t), ["l_orderkey"], "first", "second").select("l_orderkey", "nb_all", "nb_done")
    stored = counted.select("l_orderkey", (F.col("nb_all") + F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(0)).alias("nb_all"), "nb_done", F.lit("E").alias("status"))
    return metrics.reconcile(stored, counted, "l_orderkey", ["nb_all", "nb_done"], "status", "nb_all", "nb_done")


@query("A11_proportion", "SELECT round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS share FROM events")
def _(t):
    return t.events.agg(F.round(F.avg((F.col("value") > 50).cast("double")), 6).alias("share"))


@query("A12_proportion_per_group", "SELECT n_regionkey, round(avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END), 6) AS share FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    both = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return both.groupBy("n_regionkey").agg(F.round(F.avg((F.col("c_acctbal") > 0).cast("double")), 6).alias("share"))


COSINE = "round(list_cosine_similarity(a.e, b.e), 6)"
NEAREST = f"""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT a.vec_id, a.label, b.label AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY {COSINE} DESC, b.vec_id) AS rank FROM v a JOIN v b ON a.vec_id <> b.vec_id),
f AS (SELECT vec_id, any_value(label) AS label, min(CASE WHEN other = label THEN rank END) AS first FROM n WHERE rank <= 10 GROUP BY vec_id)"""


def _first_hits(t):
    near = vectors.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 10)
    labels = t.embeddings.select("vec_id", "label")
    near = near.join(labels.withColumnsRenamed({"vec_id": "query_id"}), "query_id").join(labels.withColumnsRenamed({"label": "other"}), "vec_id")
    return near.groupBy("query_id", "label").agg(F.min(F.when(F.col("other") == F.col("label"), F.col("rank"))).alias("first"))


@query("A13_topk_accuracy_curve", f"{NEAREST} SELECT CAST(k AS INTEGER) AS k, round(count(*) FILTER (first <= k) / count(*), 6) AS accuracy FROM f, range(1, 11) r(k) GROUP BY k")
def _(t):
    return metrics.topk_curve(_first_hits(t), "first").withColumn("accuracy", F.round("accuracy", 6))


@query("A13_topk_accuracy_by_label", f"{NEAREST} SELECT label, CAST(k AS INTEGER) AS k, round(count(*) FILTER (first <= k) / count(*), 6) AS accuracy FROM f, range(1, 11) r(k) GROUP BY label, k")
def _(t):
    return metrics.topk_curve(_first_hits(t), "first", keys=["label"]).withColumn("accuracy", F.round("accuracy", 6))


SCORED = "SELECT round(least(n_chars / 5000.0, 1.0), 2) AS score, quality = 1 AS truth FROM labels JOIN documents USING (doc_id)"


def _scored(t):
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(F.round(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)), 2).alias("score"), (F.col("quality") == 1).alias("truth"))


@query("A14_threshold_sweep", f"SELECT i / 20.0 AS threshold, round(count(*) FILTER (score >= i / 20.0) / count(*), 6) AS coverage, round(count(*) FILTER (score >= i / 20.0 AND truth) / nullif(count(*) FILTER (score >= i / 20.0), 0), 6) AS precision FROM (SELECT CAST(score AS DOUBLE) AS score, truth FROM ({SCORED})), range(0, 20) r(i) GROUP BY i")
def _(t):
    swept = metrics.threshold_sweep(_scored(t), "score", F.col("truth"), [i / 20.0 for i in range(20)])
    return swept.withColumns({c: F.round(c, 6) for c in ("coverage", "precision")})


@query("A15_podium", f"{NEAREST} SELECT CAST(p AS INTEGER) AS place, count(*) FILTER (first <= p) AS n FROM f, (VALUES (1), (2), (3), (5), (10)) v(p) GROUP BY p UNION ALL SELECT NULL, count(*) FILTER (first IS NULL) FROM f")
def _(t):
    return metrics.podium(_first_hits(t), "first", [1, 2, 3, 5, 10])


@query("A16_recall_at_candidates", "SELECT round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS recall FROM (SELECT o_orderkey, bool_or(contains(CAST(l_suppkey AS VARCHAR), CAST(o_orderkey % 10 AS VARCHAR))) AS hit FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)")
def _(t):
    pairs = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    hit = F.bool_or(F.contains(F.col("l_suppkey").cast("string"), (F.col("o_orderkey") % 10).cast("string")))
    return pairs.groupBy("o_orderkey").agg(hit.alias("hit")).agg(F.round(F.avg(F.col("hit").cast("double")), 6).alias("recall"))


@query(
    "A17_confusion_rates",
    f"""WITH s AS ({SCORED}), c AS (SELECT count(*) FILTER (truth AND score >= 0.5) AS tp, count(*) FILTER (NOT truth AND score >= 0.5) AS fp, count(*) FILTER (truth AND score < 0.5) AS fn, count(*) FILTER (NOT truth AND score < 0.5) AS tn,
avg(-CASE WHEN truth THEN ln(greatest(least(CAST(score AS DOUBLE), 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(CAST(score AS DOUBLE), 1 - 1e-15), 1e-15)) END) AS log_loss, avg(power(CAST(score AS DOUBLE) - CASE WHEN truth THEN 1 ELSE 0 END, 2)) AS brier FROM s)
SELECT tp, fp, fn, tn, round(tp / nullif(tp + fn, 0), 6) AS tpr, round(fn / nullif(tp + fn, 0), 6) AS fnr, round(tn / nullif(tn + fp, 0), 6) AS tnr, round(fp / nullif(tn + fp, 0), 6) AS fpr, round(tp / nullif(tp + fp, 0), 6) AS ppv, round(fp / nullif(tp + fp, 0), 6) AS fdr,
round(tn / nullif(tn + fn, 0), 6) AS npv, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 6) AS f2, round(1.25 * tp / nullif(1.25 * tp + 0.25 * fn + fp, 0), 6) AS f05, round(log_loss, 4) AS log_loss, round(brier, 6) AS brier FROM c""",
)
def _(t):
    out = metrics.confusion(_scored(t), F.col("truth"), F.col("score") >= 0.5, F.col("score"))
    return out.select("tp", "fp", "fn", "tn", *[F.round(c, 4 if c == "log_loss" else 6).alias(c) for c in out.columns[4:]])


@query("A18_precision_recall_f1", f"WITH s AS ({SCORED}), c AS (SELECT count(*) FILTER (truth AND score >= 0.3) AS tp, count(*) FILTER (score >= 0.3) AS p, count(*) FILTER (truth) AS t FROM s) SELECT round(tp / nullif(p, 0), 6) AS precision, round(tp / nullif(t, 0), 6) AS recall, round(2 * tp / nullif(p + t, 0), 6) AS f1 FROM c")
def _(t):
    out = metrics.confusion(_scored(t), F.col("truth"), F.col("score") >= 0.3)
    return out.select(F.round("ppv", 6).alias("precision"), F.round("tpr", 6).alias("recall"), F.round("f1", 6).alias("f1"))


CURVE = f"WITH s AS (SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (truth) AS p, count(*) FILTER (NOT truth) AS n FROM ({SCORED}) GROUP BY 1), c AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS ps, sum(n) OVER () AS ns, p, n FROM s WINDOW w AS (ORDER BY score DESC))"


@query("A19_best_threshold", f"{CURVE} SELECT coalesce((SELECT score FROM c WHERE tp / (tp + fp) >= 0.4 ORDER BY tp / ps DESC, score LIMIT 1), 0.5) AS threshold")
def _(t):
    return metrics.best_threshold(_scored(t), "score", F.col("truth"), 0.4)


@query("A20_curves", f"{CURVE} SELECT score, round(tp / (tp + fp), 6) AS precision, round(tp / ps, 6) AS recall, round(fp / ns, 6) AS fpr FROM c")
def _(t):
    return metrics.curves(_scored(t), "score", F.col("truth")).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "fpr")})


@query("A20_areas", f"{CURVE} SELECT round(sum(n * (2 * tp - p) / 2.0) / max(ps * ns), 6) AS roc_auc, round(sum(p / ps * tp / (tp + fp)), 6) AS average_precision FROM c")
def _(t):
    return metrics.areas(_scored(t), "score", F.col("truth")).select(F.round("roc_auc", 6).alias("roc_auc"), F.round("average_precision", 6).alias("average_precision"))


@query("A21_quantiles", "SELECT round(quantile_cont(value, 0.1), 6) AS d1, round(quantile_cont(value, 0.5), 6) AS d5, round(quantile_cont(value, 0.95), 6) AS q95, round((SELECT avg(value) FROM events WHERE value < (SELECT quantile_cont(value, 0.95) FROM events)), 6) AS trimmed FROM events")
def _(t):
    q = metrics.exact_quantiles(t.events, "value", {"d1": 0.1, "d5": 0.5, "q95": 0.95})
    trimmed = t.events.where(F.col("value") < q["q95"]).agg(F.round(F.avg("value"), 6).alias("trimmed"))
    return trimmed.select(*[F.round(F.lit(v), 6).alias(n) for n, v in q.items()], "trimmed")


@query("A22_duration_mean", "SELECT user_id, round(avg(gap), 3) AS mean_seconds FROM (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) WHERE gap IS NOT NULL GROUP BY 1")
def _(t):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    gap = seconds - F.lag(seconds).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t.events.select("user_id", gap.alias("gap")).where("gap IS NOT NULL").groupBy("user_id").agg(F.round(F.avg("gap"), 3).alias("mean_seconds"))


@query("A23_occurrences_per_key", "SELECT l_orderkey, l_suppkey, count(*) AS nb FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("nb"))


@query("A24_distinct_of_lists", "SELECT DISTINCT unnest(string_split(p_type, ' ')) AS word FROM part")
def _(t):
    return t.part.select(F.explode(F.split("p_type", " ")).alias("word")).distinct()


@query("A25_column_means", "SELECT round(sum(quality) / count(*), 6) AS quality, round(sum(toxic) / count(*), 6) AS toxic FROM labels")
def _(t):
    return t.labels.agg(*[F.round(F.sum(c) / F.count("*"), 6).alias(c) for c in ("quality", "toxic")])


@query("A26_frequency_top_n", "SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1 HAVING count(*) >= 2) ORDER BY n DESC, word LIMIT 30")
def _(t):
    words = t.documents.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2").orderBy(F.desc("n"), "word").limit(30)


@query("A27_max_lengths", "SELECT max(length(text)) AS longest, max(len(string_split(text, ' '))) AS most_tokens FROM documents")
def _(t):
    return t.documents.agg(F.max(F.char_length("text")).cast("long").alias("longest"), F.max(F.size(F.split("text", " "))).cast("long").alias("most_tokens"))


@query("A28_document_frequency", "SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1) ORDER BY n DESC, word LIMIT 25")
def _(t):
    words = t.documents.select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(25)


@query("A29_latest_per_key", "SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("A30_class_weights", "SELECT label, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)")
def _(t):
    return metrics.class_weights(t.embeddings, "label").withColumn("weight", F.round("weight", 6))


@query("A31_extrapolated_volumes", f"WITH c AS (SELECT count(*) FILTER (truth AND score >= 0.3) AS tp, count(*) FILTER (score >= 0.3) AS p, count(*) FILTER (truth) AS t FROM ({SCORED})) SELECT round(1400000 * 0.15 * tp / t, 3) AS found, round(1400000 * 0.15 * tp / t / (tp / p), 3) AS flagged FROM c")
def _(t):
    out = metrics.confusion(_scored(t), F.col("truth"), F.col("score") >= 0.3)
    found = F.lit(1400000 * 0.15) * F.col("tpr")
    return out.select(F.round(found, 3).alias("found"), F.round(found / F.col("ppv"), 3).alias("flagged"))
