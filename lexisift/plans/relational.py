"""Projections, filters, joins, ranking, sets and nested data."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexisift.functions import scalars
from lexisift.operators import nested, ranking, relational
from lexisift.plans.registry import query

# projections, filters, derived columns


@query("P1_projection", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name")


@query("P2_columns_by_pattern", "SELECT c_custkey, c_nationkey FROM customer")
def _(t):
    return relational.columns_like(t.customer, "key$")


@query("P3_constant_column", "SELECT n_nationkey, 0 AS blank, CAST(NULL AS VARCHAR) AS missing FROM nation")
def _(t):
    return t.nation.select("n_nationkey", F.lit(0).alias("blank"), F.lit(None).cast("string").alias("missing"))


@query("P4_rename", "SELECT n_nationkey AS code, n_name AS label FROM nation")
def _(t):
    return t.nation.withColumnsRenamed({"n_nationkey": "code", "n_name": "label"}).select("code", "label")


@query("P5_drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    return t.customer.drop("c_nationkey", "c_acctbal")


@query("P6_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AND o_totalprice BETWEEN 1000 AND 200000")
def _(t):
    o = t.orders
    return o.where((o.o_orderstatus == "F") & (o.o_orderpriority != "1-URGENT") & o.o_totalprice.between(1000, 200000)).select("o_orderkey")


@query("P7_null_or_blank", "SELECT l_orderkey, l_linenumber FROM (SELECT *, nullif(l_returnflag, 'N') AS f FROM lineitem) WHERE f IS NULL OR trim(f) = ''")
def _(t):
    flags = t.lineitem.withColumn("f", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return flags.where(scalars.is_blank(F.col("f"))).select("l_orderkey", "l_linenumber")


@query("P8_and_or_precedence", "SELECT o_orderkey FROM orders WHERE 1 = 1 AND o_orderstatus = 'P' OR o_totalprice < 5000")
def _(t):
    return t.orders.where("1 = 1 AND o_orderstatus = 'P' OR o_totalprice < 5000").select("o_orderkey")


@query("P9_in_list", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(t):
    return relational.in_list(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey")


@query("P10_membership", "SELECT c_custkey, c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS known FROM customer")
def _(t):
    keys = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("key"))
    return relational.flag_member(t.customer, "c_nationkey", keys, "key", "known").select("c_custkey", "known")


@query("P11_anti_membership", "SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 45)")
def _(t):
    return t.part.join(t.part.where("p_size > 45").select("p_brand"), "p_brand", "left_anti").select("p_brand").distinct()


@query("P12_like", "SELECT p_partkey FROM part WHERE p_name LIKE '%a%e%'")
def _(t):
    return t.part.where(F.col("p_name").like("%a%e%")).select("p_partkey")


@query("P13_prefix_suffix_substring", "SELECT c_custkey, left(c_name, 4) AS head, right(c_name, 3) AS tail, substring(c_name, 3, 5) AS middle, substring(c_name, 6) AS rest FROM customer")
def _(t):
    name = F.col("c_name")
    return t.customer.select("c_custkey", F.left(name, F.lit(4)).alias("head"), F.right(name, F.lit(3)).alias("tail"), F.substring(name, 3, 5).alias("middle"), scalars.cut_front(name, 5).alias("rest"))


KEY_SQL = "lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || lpad(CAST(o_custkey AS VARCHAR), 5, '0')"


@query("P14_concatenated_key", f"SELECT o_orderkey, {KEY_SQL} AS siret FROM orders")
def _(t):
    return t.orders.select("o_orderkey", scalars.padded_key(("o_orderkey", 9), ("o_custkey", 5)).alias("siret"))


@query(
    "P15_first_non_blank",
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment WHEN n_name NOT LIKE 'A%' THEN n_name ELSE '' END AS value, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'segment' WHEN n_name NOT LIKE 'A%' THEN 'nation' END AS source FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(t):
    both = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    pairs = [("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))), ("nation", F.when(~F.col("n_name").like("A%"), F.col("n_name")))]
    value, source = scalars.first_non_blank(pairs)
    return both.select("c_custkey", F.coalesce(value, F.lit("")).alias("value"), source.alias("source"))


@query("P16_prefer_manual", "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE l_linestatus END AS code FROM lineitem")
def _(t):
    value, _ = scalars.first_non_blank([("m", F.nullif(F.col("l_returnflag"), F.lit("N"))), ("c", F.col("l_linestatus"))])
    return t.lineitem.select("l_orderkey", "l_linenumber", value.alias("code"))


@query("P17_fill_missing", "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_returnflag, 'N'), 'lreturnflaginconnue') AS l_returnflag FROM lineitem")
def _(t):
    flags = t.lineitem.withColumn("l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return scalars.fill_sentinel(flags, ["l_returnflag"]).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("P18_replace_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN '' ELSE o_orderstatus END AS status FROM orders")
def _(t):
    return t.orders.replace({"F": "final", "O": ""}, subset=["o_orderstatus"]).select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("P19_cast_frame", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def _(t):
    return relational.all_strings(t.supplier.select("s_suppkey", "s_name", "s_nationkey"))


@query("P20_flag_algebra", "SELECT l_orderkey, l_linenumber, (l_returnflag = 'R' OR l_linestatus = 'O') AND NOT l_quantity > 25 AS flagged FROM lineitem")
def _(t):
    returned, open_, large = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_quantity") > 25
    return t.lineitem.select("l_orderkey", "l_linenumber", ((returned | open_) & ~large).alias("flagged"))


@query("P21_prefix_classes", "SELECT p_partkey, CASE WHEN left(p_type, 2) = 'ST' OR p_brand IN ('Brand#11', 'Brand#12') THEN 'A' WHEN left(p_type, 2) = 'PR' THEN 'B' ELSE 'other' END AS class FROM part")
def _(t):
    return t.part.select("p_partkey", scalars.prefix_class("p_type", [("A", ["ST"], ("p_brand", ["Brand#11", "Brand#12"])), ("B", ["PR"], None)], "other").alias("class"))


@query("P22_conditional_target", "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS target FROM lineitem")
def _(t):
    blank = [F.nullif(F.col("l_returnflag"), F.lit("N")).isNull(), F.nullif(F.col("l_linestatus"), F.lit("O")).isNull()]
    return t.lineitem.select("l_orderkey", "l_linenumber", (blank[0] & blank[1]).cast("long").alias("target"))


@query("P23_row_arithmetic", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 8) AS charge FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 8).alias("charge"))


@query("P24_label_encoding", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part")
def _(t):
    return relational.label_encode(t.part, "p_brand", "code").select("p_partkey", "code")


@query("P25_update_subset", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN 'region ' || r_name ELSE n_name END AS n_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey = 1")
def _(t):
    changes = t.nation.where("n_regionkey = 1").join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat(F.lit("region "), "r_name").alias("n_name"))
    return relational.update_by_key(t.nation, changes, "n_nationkey", ["n_name"]).select("n_nationkey", "n_name")


@query("P26_add_missing_columns", "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS r_comment FROM region")
def _(t):
    return relational.ensure_columns(t.region, {"r_regionkey": "int", "r_name": "string", "r_comment": "string"})


@query("P27_split_by_predicate", "SELECT CASE WHEN c_acctbal > 0 THEN 'yes' ELSE 'no' END AS part, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    yes, no = relational.split(t.customer, F.col("c_acctbal") > 0)
    return yes.agg(F.lit("yes").alias("part"), F.count("*").alias("n")).union(no.agg(F.lit("no"), F.count("*")))


@query("P28_columns_differ", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 25 <> l_suppkey % 25")
def _(t):
    return t.lineitem.where(F.col("l_partkey") % 25 != F.col("l_suppkey") % 25).select("l_orderkey", "l_linenumber")


# joins


@query("J1_inner_join_on_expressions", f"SELECT o_orderkey, c_name FROM (SELECT *, {KEY_SQL} AS k FROM orders) JOIN customer ON right(k, 5) = lpad(CAST(c_custkey AS VARCHAR), 5, '0')")
def _(t):
    keyed = t.orders.withColumn("k", scalars.padded_key(("o_orderkey", 9), ("o_custkey", 5)))
    return keyed.join(t.customer, F.right("k", F.lit(5)) == scalars.padded_key(("c_custkey", 5))).select("o_orderkey", "c_name")


@query("J2_left_join_chain", "SELECT l_orderkey, l_linenumber, o_orderstatus, c_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name")


@query("J3_implicit_join", "SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey")
def _(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("J4_anti_join", "SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IS NULL")
def _(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("J5_not_in_subquery", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30)")
def _(t):
    used = t.lineitem.where("l_quantity > 30").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return t.part.join(used, "p_partkey", "left_anti").select("p_partkey")


@query("J6_semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(t):
    return t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("J7_left_join_made_inner", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey IN (1, 2)")
def _(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").where("n_regionkey IN (1, 2)").select("c_custkey", "n_name")


@query("J8_checked_left_join", "SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return relational.checked_left_join(t.nation, t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "many_to_one").select("n_name", "r_name")


@query("J9_index_join", "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    return t.supplier.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey", "left").select("s_suppkey", "s_name", "n_name")


@query("J10_outer_join", "SELECT coalesce(c_nationkey, s_nationkey) AS nationkey, c, s FROM (SELECT c_nationkey, count(*) AS c FROM customer WHERE c_acctbal > 9000 GROUP BY 1) FULL JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey")
def _(t):
    c = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("c"))
    return c.join(t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("s")), "nationkey", "outer")


SUPPLIER_RANKS = "SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier"


@query("J11_top1_with_top2", f"WITH r AS ({SUPPLIER_RANKS}) SELECT a.s_nationkey, a.s_suppkey AS suppkey_1, b.s_suppkey AS suppkey_2 FROM r a JOIN r b ON a.s_nationkey = b.s_nationkey AND a.rank = 1 AND b.rank = 2")
def _(t):
    ranked = ranking.top_k(t.supplier, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 2)
    return ranking.wide(ranked.withColumnRenamed("s_suppkey", "suppkey"), ["s_nationkey"], ["suppkey"], 2).where("top_2_suppkey IS NOT NULL").select("s_nationkey", F.col("top_1_suppkey").alias("suppkey_1"), F.col("top_2_suppkey").alias("suppkey_2"))


@query("J12_merge_on_shared_columns", "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return relational.natural_left_join(t.nation, t.region.withColumnRenamed("r_regionkey", "n_regionkey")).select("n_nationkey", "n_name", "r_name")


@query("J13_lookup_join", "SELECT o_orderkey, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def _(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    return t.orders.join(lines, "o_orderkey", "left").select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("J14_candidates_with_vectors", "SELECT d.doc_id, e.label FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id")
def _(t):
    return t.documents.select("doc_id").join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id").select("doc_id", "label")


@query("J15_two_key_lookup_default", "SELECT c_custkey, coalesce(s, 0) AS score FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey")
def _(t):
    scores = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("score"))
    return relational.lookup(t.customer.withColumn("status", F.lit("F")), scores, ["c_custkey", "status"], "score", 0).select("c_custkey", "score")


@query("J19_redirect_codes", "SELECT s_suppkey, CASE WHEN s_nationkey >= 20 THEN s_nationkey - 20 ELSE s_nationkey END AS code FROM supplier")
def _(t):
    current = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("code"))
    history = t.nation.where("n_nationkey >= 20").select(F.col("n_nationkey").alias("old"), (F.col("n_nationkey") - 20).alias("new"))
    return relational.redirect(t.supplier, "s_nationkey", current, "code", history, "old", "new").select("s_suppkey", F.col("s_nationkey").alias("code"))


@query("J20_dictionary_enrichment", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label FROM orders")
def _(t):
    return t.orders.select("o_orderkey", scalars.map_lookup(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("label"))


# ranking


@query("W1_topk_per_group", "SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def _(t):
    return ranking.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("W2_argsort_topk", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def _(t):
    return t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20).select("p_partkey")


@query("W3_rerank_coefficients", "SELECT * FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY round(l_discount + 0.01 * l_quantity + 0.5 * l_tax, 6) DESC, l_linenumber) AS rank FROM lineitem) WHERE rank <= 2")
def _(t):
    score = F.round(F.col("l_discount") + 0.01 * F.col("l_quantity") + 0.5 * F.col("l_tax"), 6)
    return ranking.top_k(t.lineitem.withColumn("final", score), ["l_orderkey"], [F.desc("final"), F.col("l_linenumber")], 2).select("l_orderkey", "l_linenumber", "rank")


LISTS = "SELECT l_orderkey, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS items, max(l_suppkey) AS truth FROM lineitem GROUP BY l_orderkey"


def _lists(t):
    pairs = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey")))
    return t.lineitem.groupBy("l_orderkey").agg(F.transform(pairs, lambda p: p["l_suppkey"]).alias("items"), F.max("l_suppkey").alias("truth")).withColumn("truth", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-5)).otherwise(F.col("truth")))


LISTED = f"SELECT l_orderkey, items, CASE WHEN l_orderkey % 3 = 0 THEN -5 ELSE truth END AS truth FROM ({LISTS})"


@query("W4_rank_of_truth", f"SELECT l_orderkey, CAST(CASE WHEN list_contains(items, truth) THEN list_position(items, truth) ELSE -1 END AS INTEGER) AS rank FROM ({LISTED})")
def _(t):
    return _lists(t).select("l_orderkey", ranking.rank_of_truth(F.col("items"), F.col("truth")).alias("rank"))


@query("W5_rank_with_sentinel", f"SELECT l_orderkey, CAST(CASE WHEN l_orderkey % 5 = 0 THEN NULL WHEN list_contains(items, truth) THEN list_position(items, truth) - 1 ELSE 10 END AS INTEGER) AS rank FROM ({LISTED})")
def _(t):
    items = F.when(F.col("l_orderkey") % 5 != 0, F.col("items"))
    return _lists(t).select("l_orderkey", ranking.rank_or_sentinel(items, F.col("truth")).alias("rank"))


PREFER_SQL = "WITH r AS (SELECT o_custkey, o_orderkey, {flag} AS same, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN same THEN 0 ELSE 1 END, rank) AS INTEGER) AS rank FROM r WHERE rank <= 10"


@query("W6_same_place_first", PREFER_SQL.format(flag="o_orderstatus = 'F'"))
def _(t):
    ranked = ranking.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10)
    return ranking.prefer_first(ranked, ["o_custkey"], F.col("o_orderstatus") == "F", "rank").select("o_custkey", "o_orderkey", "rank")


@query("W7_same_department_first", PREFER_SQL.format(flag="left(o_orderpriority, 1) = '1'"))
def _(t):
    ranked = ranking.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10)
    return ranking.prefer_first(ranked, ["o_custkey"], F.left("o_orderpriority", F.lit(1)) == "1", "rank").select("o_custkey", "o_orderkey", "rank")


@query(
    "W8_gap_features",
    f"WITH r AS ({SUPPLIER_RANKS}), g AS (SELECT s_nationkey, max(CASE WHEN rank = 1 THEN s_acctbal END) AS score1, coalesce(max(CASE WHEN rank = 2 THEN s_acctbal END), 0) AS score2 FROM r GROUP BY 1) SELECT s_nationkey, score1, score2, round(score1 - score2, 6) AS diff, round((score1 - score2) / nullif(score1, 0), 6) AS normdiff, round(score2 / nullif(score1, 0), 6) AS ratio FROM g",
)
def _(t):
    ranked = ranking.top_k(t.supplier, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 2)
    return ranking.gap_features(ranked, ["s_nationkey"], "s_acctbal").withColumns({c: F.round(c, 6) for c in ("diff", "normdiff", "ratio")})


@query("W9_order_by", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey DESC, o_orderkey LIMIT 100")
def _(t):
    return t.orders.orderBy(F.desc("o_custkey"), "o_orderkey").limit(100).select("o_orderkey", "o_custkey")


@query("W10_given_order", "SELECT n_nationkey, CASE n_regionkey WHEN 3 THEN 0 WHEN 1 THEN 1 WHEN 4 THEN 2 END AS place FROM nation WHERE n_regionkey IN (3, 1, 4)")
def _(t):
    return relational.in_given_order(t.nation, "n_regionkey", [3, 1, 4], "place").select("n_nationkey", "place")


@query("W11_limit", "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 15")
def _(t):
    return t.customer.orderBy("c_custkey").limit(15).select("c_custkey")


@query("W12_default_size", "SELECT * FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 10")
def _(t):
    return ranking.top_k(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 10).select("c_nationkey", "c_custkey", "rank")


@query("W13_batches_by_key", "SELECT s_suppkey, (row_number() OVER (ORDER BY s_nationkey, s_suppkey) - 1) // 8 AS batch FROM supplier")
def _(t):
    return relational.batches(t.supplier, ["s_nationkey", "s_suppkey"], 8, "batch").select("s_suppkey", "batch")


@query("W14_cumulative_histogram", "SELECT p_size, CAST(sum(n) OVER (ORDER BY p_size) AS BIGINT) AS cumulated FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1)")
def _(t):
    counts = t.part.groupBy("p_size").agg(F.count("*").alias("n"))
    return counts.select("p_size", F.sum("n").over(Window.orderBy("p_size")).alias("cumulated"))


WIDE_SQL = f"SELECT s_nationkey, max(CASE WHEN rank = 1 THEN s_suppkey END) AS top_1_s_suppkey, max(CASE WHEN rank = 2 THEN s_suppkey END) AS top_2_s_suppkey, max(CASE WHEN rank = 3 THEN s_suppkey END) AS top_3_s_suppkey FROM ({SUPPLIER_RANKS}) GROUP BY 1"


def _wide(t):
    return ranking.wide(ranking.top_k(t.supplier, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 3), ["s_nationkey"], ["s_suppkey"], 3)


@query("W15_long_to_wide", WIDE_SQL)
def _(t):
    return _wide(t)


@query("W16_wide_to_long", f"SELECT s_nationkey, CAST(rank AS INTEGER) AS rank, s_suppkey FROM ({SUPPLIER_RANKS}) WHERE rank <= 3")
def _(t):
    return ranking.long(_wide(t), ["s_nationkey"], ["s_suppkey"], 3)


# sets and samples


@query("U1_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("U2_union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey"))


@query("U3_distinct", "SELECT DISTINCT p_brand, p_size FROM part")
def _(t):
    return t.part.select("p_brand", "p_size").distinct()


@query("U4_distinct_on", f"SELECT s_nationkey, s_suppkey FROM ({SUPPLIER_RANKS}) WHERE rank = 1")
def _(t):
    return ranking.top_k(t.supplier, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 1).select("s_nationkey", "s_suppkey")


@query("U5_set_difference_intersection", "SELECT k, 'both' AS part FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'first' FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def _(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    return a.intersect(b).withColumn("part", F.lit("both")).union(a.exceptAll(b).distinct().join(b, "k", "left_anti").withColumn("part", F.lit("first")))


@query("U6_concatenated_lists", "SELECT l_orderkey, array_to_string(list_concat(list(l_suppkey ORDER BY l_linenumber, l_suppkey, l_partkey), list(l_partkey ORDER BY l_linenumber, l_suppkey, l_partkey)), ',') AS merged FROM lineitem GROUP BY l_orderkey")
def _(t):
    pairs = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    lists = t.lineitem.groupBy("l_orderkey").agg(pairs.alias("p"))
    both = F.concat(F.transform("p", lambda x: x["l_suppkey"]), F.transform("p", lambda x: x["l_partkey"]))
    return lists.select("l_orderkey", F.array_join(F.transform(both, lambda x: x.cast("string")), ",").alias("merged"))


@query("U7_sample_capped", "SELECT c_custkey FROM customer ORDER BY c_custkey * 7919 % 10007, c_custkey LIMIT 100")
def _(t):
    return relational.sample_at_most(t.customer, "c_custkey", 100).select("c_custkey")


@query("U8_split_by_key", "SELECT o_orderkey, CASE WHEN o_custkey * 2654435761 % 100 < 70 THEN 'train' ELSE 'test' END AS part FROM orders")
def _(t):
    return relational.grouped_split(t.orders, "o_custkey", 70, "part").select("o_orderkey", "part")


@query("U9_oversampling", "SELECT toxic, greatest(count(*), max(max(n)) OVER ()) AS n FROM labels JOIN (SELECT toxic AS k, count(*) AS n FROM labels GROUP BY 1) ON k = toxic GROUP BY toxic")
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").withColumn("x", F.array(F.col("n_chars").cast("double")))
    return relational.oversample(rows, "toxic", "doc_id", "x").groupBy("toxic").agg(F.count("*").alias("n"))


@query(
    "U9_smote",
    """WITH d AS (SELECT toxic AS label, l.doc_id AS k, CAST(n_chars AS DOUBLE) AS a, CAST(l.doc_id % 97 AS DOUBLE) AS b FROM labels l JOIN documents USING (doc_id)),
z AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS most FROM d GROUP BY 1), p AS (SELECT d.*, n, most, row_number() OVER (PARTITION BY label ORDER BY k * 7919 % 10007, k) - 1 AS place FROM d JOIN z USING (label)),
t AS (SELECT *, unnest(range(1, CAST(floor((most - n - place - 1) / CAST(n AS DOUBLE)) AS BIGINT) + 2)) AS turn FROM p WHERE most - n > place),
m AS (SELECT DISTINCT k, label, a, b FROM t), r AS (SELECT m.k, o.k AS other, o.a, o.b, row_number() OVER (PARTITION BY m.k ORDER BY round(sqrt((m.a - o.a) * (m.a - o.a) + (m.b - o.b) * (m.b - o.b)), 6), o.k) - 1 AS i FROM m JOIN d o ON m.label = o.label AND m.k <> o.k),
s AS (SELECT *, (k * 2654435761 + turn * 97003) % 1000003 AS h FROM t)
SELECT s.label AS toxic, round(s.a + (r.a - s.a) * (h // 7 % 1000 / 1000e0), 6) AS x, round(s.b + (r.b - s.b) * (h // 7 % 1000 / 1000e0), 6) AS y FROM s JOIN r ON s.k = r.k AND r.i = h % 5""",
)
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").withColumn("x", F.array(F.col("n_chars").cast("double"), (F.col("doc_id") % 97).cast("double")))
    made = relational.oversample(rows, "toxic", "doc_id", "x").where("synthetic")
    return made.select("toxic", F.round(F.get("x", F.lit(0)), 6).alias("x"), F.round(F.get("x", F.lit(1)), 6).alias("y"))


@query("U10_table_exists", "SELECT true AS there, false AS missing")
def _(t):
    t.region.createOrReplaceTempView("region_there")
    catalog = t.spark.catalog
    return t.spark.range(1).select(F.lit(catalog.tableExists("region_there")).alias("there"), F.lit(catalog.tableExists("region_not_there")).alias("missing"))


@query("U11_update", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def _(t):
    return relational.update_by_key(t.customer, t.customer.where("c_acctbal < 0").select("c_custkey", F.lit(0.0).alias("c_acctbal")), "c_custkey", ["c_acctbal"]).select("c_custkey", "c_acctbal")


# nested data


@query("N1_flatten", "SELECT n_nationkey AS nation_key, n_name AS nation_name, r_name AS nation_region_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nested.flatten(both.select(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation")))


@query("N2_hits_to_rows", "SELECT l_orderkey AS id, l_suppkey AS _id, l_quantity AS _score FROM lineitem")
def _(t):
    hits = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.struct(F.col("l_suppkey").alias("_id"), F.col("l_quantity").alias("_score"))).alias("hits"))
    return nested.hits_to_rows(hits, "id", "hits")


@query("N3_parse_list_text", "SELECT l_orderkey, count(*) AS n, CAST(sum(l_suppkey) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def _(t):
    text = t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.col("l_suppkey"))).alias("text"))
    parsed = text.select("l_orderkey", nested.parse_list(F.col("text"), "bigint").alias("items"))
    return parsed.select("l_orderkey", F.size("items").cast("long").alias("n"), F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("N4_serialise_list", "SELECT l_orderkey, '[' || string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_suppkey, l_linenumber) || ']' AS text FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.sort_array(F.collect_list("l_suppkey"))).alias("text"))


@query("N5_zip_lists", "SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey) AS pairs FROM lineitem GROUP BY 1")
def _(t):
    lists = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("p"))
    zipped = nested.zip_lists(F.transform("p", lambda x: x["l_linenumber"]), F.transform("p", lambda x: x["l_suppkey"]))
    return lists.select("l_orderkey", F.array_join(F.transform(zipped, lambda x: F.concat_ws(":", x["code"], x["score"])), ",").alias("pairs"))


@query("N6_list_to_columns", "SELECT c_custkey, string_split(c_name, '#')[1] AS part_0, string_split(c_name, '#')[2] AS part_1, CAST(NULL AS VARCHAR) AS part_2 FROM customer")
def _(t):
    return nested.list_to_columns(t.customer.withColumn("parts", F.split("c_name", "#")), "parts", "part", 3).select("c_custkey", "part_0", "part_1", "part_2")


@query("N7_columns_to_list", "SELECT p_partkey, p_brand || '|' || p_type AS joined FROM part")
def _(t):
    return t.part.select("p_partkey", F.array_join(F.array("p_brand", "p_type"), "|").alias("joined"))


@query("N8_template_rendering", "SELECT c_custkey, 'name=' || c_name || '&segment=' || c_mktsegment || '&' AS rendered FROM customer")
def _(t):
    return t.customer.select("c_custkey", nested.render("name={{c_name}}&segment={{ c_mktsegment }}&{{absent}}", t.customer.columns).alias("rendered"))


@query("N9_error_rows", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'ok' ELSE 'no prediction' END AS status FROM customer")
def _(t):
    return nested.with_error_rows(t.customer.select("c_custkey"), t.customer.where("c_acctbal >= 0").select("c_custkey"), "c_custkey", "no prediction").select("c_custkey", "status")


@query("N10_integrated_results", "SELECT c_custkey, o.n AS orders_n, b.b AS big_n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o.o_custkey LEFT JOIN (SELECT o_custkey, count(*) AS b FROM orders WHERE o_totalprice > 100000 GROUP BY 1) b ON c_custkey = b.o_custkey")
def _(t):
    per = lambda df: df.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return nested.integrate(t.customer.select("c_custkey"), "c_custkey", {"orders": per(t.orders), "big": per(t.orders.where("o_totalprice > 100000"))})


@query("N11_merged_configuration", "SELECT 'local[2]' AS master, '9' AS depth, 'x' AS own")
def _(t):
    merged = nested.merge_configuration({"spark": {"master": "local", "depth": "3"}, "own": "x"}, {"spark": {"depth": "9"}}, {"SPARK__MASTER": "local[2]"})
    return t.spark.createDataFrame([(merged["spark"]["master"], merged["spark"]["depth"], merged["own"])], "master string, depth string, own string")
