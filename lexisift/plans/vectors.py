"""Vector measures, all-pairs joins, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.functions import text as T
from lexisift.functions.scalars import rounded
from lexisift.operators import features as G
from lexisift.operators import ranking, relational, tree
from lexisift.operators import vectors as V
from lexisift.plans.registry import query
from lexisift.sources.shared import written

VEC = "WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
#: The stated query set: ids divisible by 100, against all rows.
ASKED = "a.vec_id % 100 = 0"


def _measured(t, measure, name, column="embedding", weights=None):
    rows = V.measured(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, "vec_id", column, measure, weights=weights)
    return rows.select(F.col("query_id").alias("a"), F.col("vec_id").alias("b"), F.col("value").alias(name))


def _rounded(t, measure, name="s", weights=None):
    return _measured(t, measure, name, weights=weights).withColumn(name, F.round(name, 6))


PAIRS = f"{VEC} SELECT a.vec_id AS a, b.vec_id AS b, {{e}} FROM v a JOIN v b ON {ASKED}"
query("V1_weighted_cosine", PAIRS.format(e="round(sum_w(a.e, b.e), 6) AS s").replace("sum_w(a.e, b.e)", "list_dot_product(list_transform(list_zip(a.e, range(1, 65)), lambda z: z[1] * z[2]), b.e) / sqrt(list_dot_product(list_transform(list_zip(a.e, range(1, 65)), lambda z: z[1] * z[2]), a.e) * list_dot_product(list_transform(list_zip(b.e, range(1, 65)), lambda z: z[1] * z[2]), b.e))"))(
    lambda t: _rounded(t, "cosine", weights=range(1, 65))
)
query("V2_vector_to_matrix", f"{VEC} SELECT b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS s FROM v a JOIN v b ON a.vec_id = 0 AND b.vec_id <> 0")(
    lambda t: V.measured(t.embeddings.where("vec_id = 0"), t.embeddings.where("vec_id <> 0"), "vec_id", "embedding", "cosine").select(F.col("vec_id").alias("b"), F.round("value", 6).alias("s"))
)
query("V3_matrix_to_matrix", PAIRS.format(e="round(list_cosine_similarity(a.e, b.e), 6) AS s"))(lambda t: _rounded(t, "cosine"))
query("V4_pairwise", f"{VEC} SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS s FROM v a JOIN v b ON {ASKED} AND b.vec_id < a.vec_id")(
    lambda t: V.pairwise(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, "vec_id", "embedding", "cosine").select(F.col("query_id").alias("a"), F.col("vec_id").alias("b"), F.round("value", 6).alias("s"))
)
query("V5_vector_to_matrix_by_measure", f"{VEC} SELECT b.vec_id AS b, round(list_distance(a.e, b.e), 6) AS euclidean, round(list_sum(list_transform(list_zip(a.e, b.e), lambda z: abs(z[1] - z[2]))), 6) AS manhattan FROM v a JOIN v b ON a.vec_id = 0")(
    lambda t: V.measured(t.embeddings.where("vec_id = 0"), t.embeddings, "vec_id", "embedding", lambda x, y: F.struct(V.euclidean(x, y).alias("e"), V.manhattan(x, y).alias("m"))).select(F.col("vec_id").alias("b"), F.round("value.e", 6).alias("euclidean"), F.round("value.m", 6).alias("manhattan"))
)
query("V6_matrix_to_matrix_by_measure", PAIRS.format(e="round(list_sum(list_transform(list_zip(a.e, b.e), lambda z: abs(z[1] - z[2]))), 6) AS s"))(lambda t: _rounded(t, "manhattan"))
query("V7_pairwise_by_measure", f"{VEC} SELECT a.vec_id AS a, b.vec_id AS b, round(list_max(list_transform(list_zip(a.e, b.e), lambda z: abs(z[1] - z[2]))), 6) AS s FROM v a JOIN v b ON {ASKED} AND b.vec_id < a.vec_id")(
    lambda t: V.pairwise(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, "vec_id", "embedding", "chebyshev").select(F.col("query_id").alias("a"), F.col("vec_id").alias("b"), F.round("value", 6).alias("s"))
)
query("V8_cosine_distance", PAIRS.format(e="round(1 - list_cosine_similarity(a.e, b.e), 6) AS d"))(lambda t: _rounded(t, "cosine_distance", "d"))
query("V9_dot_product", PAIRS.format(e="round(list_dot_product(a.e, b.e), 6) AS s"))(lambda t: _rounded(t, "dot"))
query("V10_normalised", f"{VEC} SELECT vec_id, round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first, round(e[64] / sqrt(list_dot_product(e, e)), 6) AS last FROM v")(
    lambda t: t.embeddings.withColumn("n", V.normalised(F.col("embedding"))).select("vec_id", F.round(F.get("n", F.lit(0)), 6).alias("first"), F.round(F.get("n", F.lit(63)), 6).alias("last"))
)
query("V11_multi_signal", "SELECT l_orderkey, l_linenumber, l_suppkey, round(l_discount + 0.1 * l_quantity + 0.5 * l_tax, 6) AS s FROM lineitem")(
    lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.round(V.multi_signal("l_discount", "l_quantity", "l_tax", 0.1, 0.5), 6).alias("s"))
)
query("V15_label_targets", PAIRS.format(e="CAST(a.label = b.label AS INTEGER) AS target"))(lambda t: _measured(t, V.label_targets, "target", "label"))
query("V16_projection", "SELECT c_custkey, round(0.5 * c_acctbal - c_nationkey, 6) AS p0, round(2e0 * c_nationkey, 6) AS p1 FROM customer")(
    lambda t: V.projected(t.customer, ["c_acctbal", "c_nationkey"], [[0.5, -1.0], [0.0, 2.0]], "p").select("c_custkey", F.round(F.get("p", F.lit(0)), 6).alias("p0"), F.round(F.get("p", F.lit(1)), 6).alias("p1"))
)
query("V17_topk_with_truth", f"{VEC}, n AS (SELECT a.vec_id AS query_id, a.label, b.vec_id, b.label AS other, round(list_cosine_similarity(a.e, b.e), 6) AS similarity, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.e, b.e), 6) DESC, b.vec_id) AS rank FROM v a JOIN v b ON a.vec_id <> b.vec_id) SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank, label = other AS hit FROM n WHERE rank <= 10")(
    lambda t: _with_truth(t)
)


def _with_truth(t):
    near = V.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 10)
    labels = t.embeddings.select("vec_id", "label")
    return near.join(labels.withColumnsRenamed({"vec_id": "query_id", "label": "own"}), "query_id").join(labels, "vec_id").select("query_id", "vec_id", "similarity", "rank", (F.col("own") == F.col("label")).alias("hit"))


query("J16_all_pairs_similarity", f"{VEC} SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS similarity FROM v a JOIN v b ON a.vec_id % 100 = 0")(
    lambda t: V.measured(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, "vec_id", "embedding", "cosine").select("query_id", "vec_id", F.round("value", 6).alias("similarity"))
)
query("J16_nearest_neighbours", f"{VEC}, n AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS similarity, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.e, b.e), 6) DESC, b.vec_id) AS rank FROM v a JOIN v b ON a.vec_id <> b.vec_id) SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM n WHERE rank <= 10")(
    lambda t: V.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 10)
)

# the tree of regions, nations and suppliers

NODES = "SELECT 'r' || r_regionkey AS code, r_name AS label, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, s_name, 'n' || s_nationkey FROM supplier"
UP = f"WITH RECURSIVE nodes AS ({NODES}), up(code, ancestor, hops) AS (SELECT code, code, 0 FROM nodes UNION ALL SELECT up.code, n.parent, hops + 1 FROM up JOIN nodes n ON up.ancestor = n.code WHERE n.parent IS NOT NULL)"


def _nodes(t):
    named = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    r = t.region.select(named("r", "r_regionkey").alias("code"), F.col("r_name").alias("label"), F.lit(None).cast("string").alias("parent"))
    n = t.nation.select(named("n", "n_nationkey"), "n_name", named("r", "n_regionkey"))
    return r.union(n).union(t.supplier.select(named("s", "s_suppkey"), "s_name", named("n", "s_nationkey")))


query("D6_ancestors", f"{UP} SELECT code, ancestor, CAST(hops AS INTEGER) AS hops FROM up")(lambda t: tree.ancestors(_nodes(t)))
query("V14_ancestor_weights", f"{UP} SELECT code, ancestor AS other, power(0.5e0, hops) AS weight FROM up UNION ALL SELECT ancestor, code, power(0.5e0, hops) FROM up WHERE hops > 0")(lambda t: tree.ancestor_weights(tree.ancestors(_nodes(t))))
SCORES = "SELECT c_custkey AS q, 's' || s_suppkey AS code, round(s_acctbal / 1000 + c_custkey, 6) AS score FROM customer JOIN supplier ON c_custkey % 100 = 0 UNION ALL SELECT c_custkey, 'n' || n_nationkey, CAST(n_nationkey AS DOUBLE) FROM customer JOIN nation ON c_custkey % 100 = 0"


def _propagated(t):
    """Suppliers are leaves: what they get from above is a matter of their nation, so pairs are made last and none is shuffled."""
    few = t.customer.where("c_custkey % 100 = 0").select(F.col("c_custkey").alias("q"))
    named = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    nodes, above = _nodes(t), written(relational.all_pairs(few, t.nation, "n_nationkey").select("q", named("n", "n_nationkey").alias("code"), F.col("n_nationkey").cast("double").alias("score")), "above")
    up = tree.ancestors(nodes.where("code NOT LIKE 's%'"))
    leaves = t.supplier.select(named("s", "s_suppkey").alias("code"), F.coalesce(named("n", "s_nationkey"), F.lit("")).alias("parent"), "s_acctbal")
    asked = relational.all_pairs(few, leaves.select("parent").distinct(), "parent").join(tree.passed_down(above, up, "q", 0.3), ["q", "parent"], "left")
    lists = relational.in_lists(written(asked.select("parent", "q", F.coalesce("more", F.lit(0.0)).alias("more")), "passed"), ["parent"], "asked")
    pairs = relational.with_lists(leaves, lists, ["parent"], "asked", "code")
    of_leaves = pairs.select("q", "code", (rounded(F.col("s_acctbal") / 1000 + F.col("q")) + F.col("more")).alias("score"))
    return tree.propagate(above, up, "q", 0.3).unionByName(of_leaves).withColumn("score", rounded(F.col("score")))


query("V12_propagated_scores", f"{UP}, s AS ({SCORES}) SELECT s.q, s.code, round(any_value(s.score) + coalesce(sum(a.score * power(0.5e0, hops) * 0.3e0), 0), 6) AS score FROM s LEFT JOIN up ON up.code = s.code AND hops > 0 LEFT JOIN s a ON a.q = s.q AND a.code = up.ancestor GROUP BY s.q, s.code")(
    lambda t: _propagated(t)
)
GRAMS = "list_transform(generate_series(1, length({c}) - 2), lambda i: substring({c}, i, 3))"
query(
    "V13_ngram_overlap",
    f"WITH a AS (SELECT n_nationkey AS k, unnest({GRAMS.format(c='n_name')}) AS g FROM nation), ca AS (SELECT k, g, count(*) AS n FROM a GROUP BY 1, 2), sz AS (SELECT k, count(*) AS n FROM a GROUP BY 1), o AS (SELECT x.k AS k1, y.k AS k2, sum(least(x.n, y.n)) AS s FROM ca x JOIN ca y ON x.g = y.g GROUP BY 1, 2) SELECT p.n_nationkey AS a, q.n_nationkey AS b, round(coalesce(s, 0) / sz.n, 6) AS overlap FROM nation p JOIN nation q ON true JOIN sz ON sz.k = q.n_nationkey LEFT JOIN o ON k1 = p.n_nationkey AND k2 = q.n_nationkey",
)(lambda t: _overlaps(t))


def _overlaps(t):
    grams = t.nation.select("n_nationkey", T.ngrams(F.col("n_name"), 3).alias("g"))
    a, b = grams.toDF("a", "x"), grams.toDF("b", "y")
    return a.join(b).select("a", "b", F.round(V.overlap(F.col("x"), F.col("y")), 6).alias("overlap"))


NAMED = "list_transform(generate_series(1, length({c}) - 2), lambda i: substring({c}, i, 3))"
query(
    "V13_overlap_join",
    f"WITH c AS (SELECT c_custkey AS k, unnest({NAMED.format(c='c_name')}) AS g FROM customer), s AS (SELECT s_suppkey AS k, unnest({NAMED.format(c='s_name')}) AS g FROM supplier), x AS (SELECT k, g, count(*) AS n FROM c GROUP BY 1, 2), y AS (SELECT k, g, count(*) AS n FROM s GROUP BY 1, 2), z AS (SELECT k, count(*) AS n FROM s GROUP BY 1) SELECT x.k AS c_custkey, y.k AS s_suppkey, round(sum(least(x.n, y.n)) / any_value(z.n), 6) AS overlap FROM x JOIN y ON x.g = y.g JOIN z ON z.k = y.k GROUP BY 1, 2 HAVING sum(least(x.n, y.n)) >= 0.5e0 * any_value(z.n)",
)(lambda t: _overlapping_names(t))


def _overlapping_names(t):
    """Customers and suppliers whose names share at least half of the supplier's trigrams."""
    found = G.overlap_join(t.customer, "c_custkey", T.ngrams(F.col("c_name"), 3), t.supplier, "s_suppkey", T.ngrams(F.col("s_name"), 3), 0.5, 6)
    return found.select(F.col("a").alias("c_custkey"), F.col("b").alias("s_suppkey"), "overlap")


query("G12_tree", f"{UP} SELECT n.code, n.label, n.parent, CAST(max(hops) AS INTEGER) AS level FROM nodes n JOIN up ON n.code = up.code GROUP BY 1, 2, 3")(lambda t: tree.load_tree(_nodes(t), "code", "label", "parent"))
query("G13_display", f"{UP}, p AS (SELECT up.code, string_agg(ancestor, '/' ORDER BY hops DESC) AS path, max(hops) AS level FROM up GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY path) AS INTEGER) AS place, repeat('  ', CAST(level AS INTEGER)) || p.code || ' ' || label AS line FROM p JOIN nodes n ON n.code = p.code")(
    lambda t: tree.display(tree.load_tree(_nodes(t), "code", "label", "parent"), tree.ancestors(_nodes(t)))
)
query("D8_nested_candidates", "SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey)[1:3], ',') AS best FROM orders GROUP BY 1")(
    lambda t: ranking.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    .groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("rank", "o_orderkey"))).alias("p"))
    .select("o_custkey", F.array_join(F.transform("p", lambda x: x["o_orderkey"].cast("string")), ",").alias("best"))
)
