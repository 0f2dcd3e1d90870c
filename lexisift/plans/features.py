"""Vocabularies, encodings, phrases, TF-IDF, geocoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.functions import scalars
from lexisift.functions import text as T
from lexisift.operators import features as G
from lexisift.operators import geocoding, relational, subwords
from lexisift.plans.registry import query
from lexisift.sources import tables as IO
from lexisift.sources.shared import fresh_path, written

WORDS = "SELECT p_partkey AS k, unnest(string_split(lower(p_name), ' ')) AS token, generate_subscripts(string_split(lower(p_name), ' '), 1) - 1 AS pos FROM part"
FIRST = f"SELECT token, row_number() OVER (ORDER BY k, pos) AS id FROM (SELECT token, arg_min(k, (k, pos)) AS k, arg_min(pos, (k, pos)) AS pos FROM ({WORDS}) GROUP BY token)"
FREQUENT = f"SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS id FROM (SELECT token, count(*) AS n FROM ({WORDS}) GROUP BY token)"
items = lambda: F.split(F.lower("p_name"), " ")

query("G1_vocabulary", FIRST)(lambda t: G.first_seen_vocabulary(t.part, "p_partkey", items()))
query("D9_vocabulary_map", f"SELECT count(*) AS n, max(id) AS last FROM ({FIRST})")(lambda t: G.first_seen_vocabulary(t.part, "p_partkey", items()).agg(F.count("*").alias("n"), F.max("id").alias("last")))
query("G2_encoded", f"SELECT k AS p_partkey, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS ids FROM ({WORDS}) JOIN ({FIRST}) USING (token) GROUP BY k")(
    lambda t: G.encode(t.part, "p_partkey", items(), G.first_seen_vocabulary(t.part, "p_partkey", items())).select("p_partkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
)
query("G3_frequent_vocabulary", FREQUENT)(lambda t: G.frequent_vocabulary(t.part, "p_partkey", items()))


@query("G4_two_sided_corpus", f"SELECT k AS p_partkey, 'left' AS side, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS ids FROM ({WORDS}) JOIN ({FREQUENT}) USING (token) WHERE k % 2 = 0 GROUP BY k UNION ALL SELECT k, 'right', string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) FROM ({WORDS}) JOIN ({FREQUENT}) USING (token) WHERE k % 2 = 1 GROUP BY k")
def _(t):
    vocabulary = G.frequent_vocabulary(t.part, "p_partkey", items())
    left, right = relational.split(t.part, F.col("p_partkey") % 2 == 0)
    coded = lambda df, side: G.encode(df, "p_partkey", items(), vocabulary, 1).select("p_partkey", F.lit(side).alias("side"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return coded(left, "left").union(coded(right, "right"))


@query(
    "G5_phrases",
    """WITH w AS (SELECT doc_id AS k, list_filter(string_split(lower(text), ' '), lambda w: w <> '') AS w FROM documents), s AS (SELECT token, count(*) AS c FROM (SELECT unnest(w) AS token FROM w) GROUP BY 1),
b AS (SELECT f, g, count(*) AS n FROM (SELECT unnest(w[:-2]) AS f, unnest(w[2:]) AS g FROM w WHERE len(w) > 1) GROUP BY 1, 2), v AS (SELECT (SELECT count(*) FROM s) + (SELECT count(*) FROM b) AS v)
SELECT f AS first, g AS second, round((n - 5) * v / CAST(x.c * y.c AS DOUBLE), 6) AS score FROM b JOIN s x ON f = x.token JOIN s y ON g = y.token, v WHERE n >= 5 AND (n - 5) * v / CAST(x.c * y.c AS DOUBLE) > 10""",
)
def _(t):
    return G.phrases(t.documents, "doc_id", T.words(F.lower("text"))).withColumn("score", F.round("score", 6))


@query(
    "G5_phrases_applied",
    """WITH w AS (SELECT doc_id AS k, list_filter(string_split(lower(text), ' '), lambda w: w <> '') AS w FROM documents), s AS (SELECT token, count(*) AS c FROM (SELECT unnest(w) AS token FROM w) GROUP BY 1),
b AS (SELECT f, g, count(*) AS n FROM (SELECT unnest(w[:-2]) AS f, unnest(w[2:]) AS g FROM w WHERE len(w) > 1) GROUP BY 1, 2), v AS (SELECT (SELECT count(*) FROM s) + (SELECT count(*) FROM b) AS v),
p AS (SELECT f, g FROM b JOIN s x ON f = x.token JOIN s y ON g = y.token, v WHERE n >= 5 AND (n - 5) * v / CAST(x.c * y.c AS DOUBLE) > 10),
t AS (SELECT k, unnest(w) AS f, unnest(list_concat(w[2:], [NULL])) AS g, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
h AS (SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS run FROM t SEMI JOIN p ON t.f = p.f AND t.g = p.g),
taken AS (SELECT k, i FROM (SELECT k, i, min(i) OVER (PARTITION BY k, run) AS first FROM h) WHERE (i - first) % 2 = 0),
u AS (SELECT t.k, string_agg(CASE WHEN a.i IS NULL THEN f ELSE f || '_' || g END, ' ' ORDER BY t.i) AS text, count(a.i) AS n FROM t LEFT JOIN taken a ON a.k = t.k AND a.i = t.i LEFT JOIN taken z ON z.k = t.k AND z.i = t.i - 1 WHERE z.i IS NULL GROUP BY t.k)
SELECT w.k AS doc_id, coalesce(n, 0) AS n_phrases, md5(CASE WHEN w.w IS NULL THEN NULL ELSE coalesce(u.text, '') END) AS text_md5 FROM w LEFT JOIN u ON w.k = u.k""",
)
def _(t):
    """All documents with their phrases as single words; a digest of each whole text is compared."""
    words = T.words(F.lower("text"))
    pairs = written(G.phrases(t.documents, "doc_id", words), "phrases")
    made = G.with_phrases(t.documents.select("doc_id", "text"), "doc_id", words, pairs, "joined")
    n = F.size(words) - F.size(F.filter(F.split("joined", " "), lambda w: w != ""))
    return made.select("doc_id", F.greatest(n, F.lit(0)).cast("long").alias("n_phrases"), F.md5("joined").alias("text_md5"))


TFIDF = f"""WITH w AS ({WORDS}), tf AS (SELECT k, token, count(*) AS tf FROM w GROUP BY 1, 2), st AS (SELECT token, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 ORDER BY total DESC, token LIMIT 1000),
x AS (SELECT k, token, tf * (ln((1 + (SELECT count(*) FROM part)) / CAST(1 + df AS DOUBLE)) + 1) AS w FROM tf JOIN st USING (token)) SELECT k AS key, token AS term, round(w / sqrt(sum(w * w) OVER (PARTITION BY k)), 6) AS tfidf FROM x"""
query("G6_tf_idf", TFIDF)(lambda t: G.tf_idf(t.part, "p_partkey", items(), 1000).withColumn("tfidf", F.round("tfidf", 6)))
query("D10_sparse_rows", f"SELECT key, count(*) AS n, round(sum(tfidf), 4) AS total FROM ({TFIDF}) GROUP BY 1")(
    lambda t: G.tf_idf(t.part, "p_partkey", items(), 1000).withColumn("tfidf", F.round("tfidf", 6)).groupBy("key").agg(F.count("*").alias("n"), F.round(F.sum("tfidf"), 4).alias("total"))
)


@query("G7_word_vectors")
def _(t):
    """Word vectors by the library's Word2Vec over partitions, which are averaged; no SQL gives a trained model."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    rows = t.part.select("p_partkey", items().alias("words"))
    model = Word2Vec(vectorSize=8, minCount=2, seed=3, inputCol="words", outputCol="vector", maxIter=1, numPartitions=int(t.spark.conf.get("spark.sql.shuffle.partitions"))).fit(rows)
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("v"))
    return vectors.select("word", F.size("v").cast("long").alias("size"), F.transform("v", lambda x: F.round(x, 6)).alias("vector"))


@query("G8_padded_matrix", f"SELECT k AS p_partkey, array_to_string(list_concat(list_resize(list(id ORDER BY pos), 4, 0), list_resize([length(any_value(p_type))], 2, 0)), ',') AS ids FROM ({WORDS}) JOIN ({FREQUENT}) USING (token) JOIN part ON p_partkey = k GROUP BY k")
def _(t):
    names = G.encode(t.part, "p_partkey", items(), G.frequent_vocabulary(t.part, "p_partkey", items()))
    rows = names.join(t.part.select("p_partkey", F.array(F.char_length("p_type").cast("bigint")).alias("kind")), "p_partkey")
    return G.padded_matrix(rows, "p_partkey", [("ids", 4), ("kind", 2)]).select("p_partkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("G9_one_hot_target", "SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_returnflag = 'A' AS BIGINT) AS l_returnflag_A, CAST(l_returnflag = 'N' AS BIGINT) AS l_returnflag_N, CAST(l_returnflag = 'R' AS BIGINT) AS l_returnflag_R FROM lineitem")
def _(t):
    return G.one_hot(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"), "l_returnflag", ["A", "N", "R"]).drop("l_returnflag")


@query("G10_cleaned_returns", "SELECT p_partkey, lower(p_name) AS main FROM part JOIN (SELECT DISTINCT p_brand FROM part WHERE p_size > 45) USING (p_brand) WHERE p_name IS NOT NULL AND trim(p_name) <> ''")
def _(t):
    known = t.part.where("p_size > 45").select("p_brand").distinct()
    main, _ = scalars.first_non_blank([("name", F.col("p_name")), ("type", F.col("p_type"))])
    return t.part.join(known, "p_brand", "left_semi").select("p_partkey", F.lower(main).alias("main")).where("main IS NOT NULL")


@query("G11_artefact_check", "SELECT x.wanted, x.wanted IN ('SELECT n_name FROM nation|5', 'SELECT r_name FROM region|7') AS usable FROM (VALUES ('SELECT n_name FROM nation|5'), ('SELECT n_name FROM nation|6'), ('SELECT r_name FROM region|7'), ('SELECT p_name FROM part|7')) x(wanted)")
def _(t):
    """Artefacts stored with the statement and the parameters they were made by, looked up by wanted ones."""
    folder = fresh_path(t.spark, "artefacts")
    for statement, table, size in (("SELECT n_name FROM nation", t.nation, 5), ("SELECT r_name FROM region", t.region, 7)):
        IO.store_artefact(table.limit(size), folder, statement, {"size": size})
    wanted = [("SELECT n_name FROM nation", 5), ("SELECT n_name FROM nation", 6), ("SELECT r_name FROM region", 7), ("SELECT p_name FROM part", 7)]
    return IO.usable_artefacts(t.spark, folder, [(s, {"size": n}) for s, n in wanted]).select(F.concat_ws("|", "statement", F.get_json_object("parameters", "$.size")).alias("wanted"), "usable")


GEO = """WITH x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 'x' ELSE lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS commune, s_suppkey % 10 / 10.0 AS sa, s_suppkey % 7 / 7.0 AS sb, CASE WHEN s_suppkey % 3 = 0 THEN 'housenumber' WHEN s_suppkey % 3 = 1 THEN 'street' ELSE 'town' END AS ka, CASE WHEN s_suppkey % 2 = 0 THEN 'housenumber' ELSE 'street' END AS kb FROM supplier)
SELECT s_suppkey, CASE WHEN commune = 'x' THEN 'no commune'
WHEN ka = 'housenumber' AND kb = 'housenumber' AND sa > 0.3 AND sa >= sb / 1.2 THEN 'a housenumber' WHEN ka = 'housenumber' AND sa > 0.3 AND NOT kb = 'housenumber' THEN 'a housenumber' WHEN kb = 'housenumber' AND sb > 0.3 THEN 'b housenumber'
WHEN ka = 'street' AND kb = 'street' AND sa > 0.3 AND sa >= sb / 1.2 THEN 'a street' WHEN ka = 'street' AND sa > 0.3 AND NOT kb = 'street' THEN 'a street' WHEN kb = 'street' AND sb > 0.3 THEN 'b street'
WHEN sa > 0.3 THEN 'a any' WHEN sb > 0.3 THEN 'b any' ELSE 'centre' END AS rule FROM x"""


@query("G14_geocoding_rules", GEO)
def _(t):
    k = F.col("s_suppkey")
    rows = t.supplier.select(
        "s_suppkey", F.when(k % 11 == 0, "x").otherwise(F.lpad(k.cast("string"), 5, "0")).alias("commune"), F.lit(46.0).alias("c_lat"), F.lit(2.0).alias("c_lon"),
        (k % 10 / 10.0).alias("a_score"), (k % 7 / 7.0).alias("b_score"), F.when(k % 3 == 0, "housenumber").when(k % 3 == 1, "street").otherwise("town").alias("a_kind"),
        F.when(k % 2 == 0, "housenumber").otherwise("street").alias("b_kind"), *[F.lit(1.0).alias(c) for c in ("a_lat", "a_lon", "b_lat", "b_lon")],
    )
    return geocoding.decide(rows).select("s_suppkey", "rule")


POINTS = """WITH x AS (SELECT c_custkey, c_custkey % 11 = 0 AS ill, c_custkey % 10 / 10e0 AS sa, c_custkey % 7 / 7e0 AS sb, c_custkey % 4 / 4e0 AS s1, c_custkey % 9 / 9e0 AS s2, c_custkey % 6 / 5e0 AS sp,
CASE c_custkey % 3 WHEN 0 THEN 'housenumber' WHEN 1 THEN 'street' ELSE 'municipality' END AS ka, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'housenumber' ELSE 'street' END AS kb,
CASE WHEN c_custkey % 5 = 0 THEN 'street' ELSE 'housenumber' END AS kn, CAST(c_custkey % 100 AS DOUBLE) / 100 AS p FROM customer),
r AS (SELECT *, CASE WHEN ill THEN 'no commune' WHEN ka = 'housenumber' AND coalesce(kb, '') = 'housenumber' AND sa > 0.3e0 AND sa >= sb / 1.2e0 THEN 'a housenumber' WHEN ka = 'housenumber' AND sa > 0.3e0 AND coalesce(kb, '') <> 'housenumber' THEN 'a housenumber' WHEN kb = 'housenumber' AND sb > 0.3e0 THEN 'b housenumber'
WHEN kn = 'housenumber' AND s1 > 0.5e0 AND s2 > 0.3e0 THEN 'between'
WHEN ka = 'street' AND coalesce(kb, '') = 'street' AND sa > 0.3e0 AND sa >= sb / 1.2e0 THEN 'a street' WHEN ka = 'street' AND sa > 0.3e0 AND coalesce(kb, '') <> 'street' THEN 'a street' WHEN kb = 'street' AND sb > 0.3e0 THEN 'b street'
WHEN sa > 0.3e0 THEN 'a any' WHEN sb > 0.3e0 THEN 'b any' WHEN sp > 0.7e0 THEN 'point of interest' ELSE 'centre' END AS rule FROM x)
SELECT c_custkey, rule, CASE WHEN rule = 'no commune' THEN NULL WHEN rule = 'centre' THEN 46e0 WHEN rule = 'between' THEN round((47 + p + 49 - p) / 2, 6) WHEN rule LIKE 'a %' THEN round(45 + p, 6) WHEN rule LIKE 'b %' THEN round(46 + p, 6) ELSE round(50 + p, 6) END AS latitude,
CASE WHEN rule = 'no commune' THEN NULL WHEN rule = 'centre' THEN 2e0 WHEN rule = 'between' THEN round((3 + p + 5 + p) / 2, 6) WHEN rule LIKE 'a %' THEN round(1 + p, 6) WHEN rule LIKE 'b %' THEN round(2 + p, 6) ELSE round(6 + p, 6) END AS longitude,
CASE WHEN rule IN ('no commune', 'centre') THEN 0e0 WHEN rule = 'between' THEN round((s1 + s2) / 2, 2) WHEN rule LIKE 'a %' THEN round(sa, 2) WHEN rule LIKE 'b %' THEN round(sb, 2) ELSE round(sp, 2) END AS score,
CASE WHEN rule = 'no commune' THEN NULL WHEN rule = 'centre' THEN 'municipality' WHEN rule = 'between' THEN 'interpolation' WHEN rule LIKE 'a %' THEN ka WHEN rule LIKE 'b %' THEN kb ELSE 'venue' END AS kind FROM r"""


@query("G14_geocoded_points", POINTS)
def _(t):
    """Points, scores and kinds of all customers' addresses, with interpolation between numbers and points of interest."""
    k = F.col("c_custkey")
    p = (k % 100).cast("double") / 100
    level = F.when(k % 5 == 0, "street").otherwise("housenumber")
    rows = t.customer.select(
        "c_custkey", F.when(k % 11 == 0, "x").otherwise(F.lpad((k % 100000).cast("string"), 5, "0")).alias("commune"), F.lit(46.0).alias("c_lat"), F.lit(2.0).alias("c_lon"),
        (k % 10 / 10.0).alias("a_score"), F.when(k % 3 == 0, "housenumber").when(k % 3 == 1, "street").otherwise("town").alias("a_kind"), (45 + p).alias("a_lat"), (1 + p).alias("a_lon"),
        (k % 7 / 7.0).alias("b_score"), F.when(k % 13 == 0, None).when(k % 2 == 0, "housenumber").otherwise("street").alias("b_kind"), (46 + p).alias("b_lat"), (2 + p).alias("b_lon"),
        (k % 4 / 4.0).alias("before_score"), level.alias("before_kind"), (47 + p).alias("before_lat"), (3 + p).alias("before_lon"),
        (k % 9 / 9.0).alias("after_score"), level.alias("after_kind"), (49 - p).alias("after_lat"), (5 + p).alias("after_lon"),
        (k % 6 / 5.0).alias("poi_score"), F.lit("venue").alias("poi_kind"), (50 + p).alias("poi_lat"), (6 + p).alias("poi_lon"),
    )
    found = geocoding.decide(rows)
    return found.select("c_custkey", "rule", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "score", "kind")


@query("G7_subword_classes")
def _(t):
    """The language of every document by words and n-grams, learned from three quarters of the labelled ones; no SQL gives a trained model."""
    rows = t.documents.select("doc_id", "text", "lang")
    model = subwords.train(rows.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), "doc_id", "text", "lang")
    return subwords.classify(rows, "doc_id", "text", model).select("doc_id", F.col("label").alias("lang"), F.round("score", 6).alias("score"))
