"""Sources and sinks: every one is written and read back where it writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.operators import relational
from lexisift.sources import tables as IO
from lexisift.sources.shared import fresh_path
from lexisift.plans.registry import query

NATION = "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation"


def _csv(df, path):
    df.write.option("sep", ";").option("header", True).csv(path)


query("S1_table_scan", "SELECT * FROM region")(lambda t: IO.read_table(t.spark, f"{t.folder}/region.parquet"))
query("S2_sql_scan", "SELECT n_name FROM nation WHERE n_regionkey = 2")(lambda t: IO.read_sql(t.spark, "SELECT n_name FROM {nation} WHERE n_regionkey = 2", nation=t.nation))


@query("S3_chunked_scan", "SELECT chunk, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM (SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS BIGINT) AS chunk, c_custkey FROM customer) GROUP BY chunk")
def _(t):
    return relational.batches(t.customer.select("c_custkey"), ["c_custkey"], 100, "chunk").groupBy("chunk").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("total"))


query("S4_csv_scan", NATION)(lambda t: IO.round_trip(t.nation, _csv, IO.read_text_table, "csv").select("n_nationkey", "n_name", "n_regionkey"))
query("S5_pruned_csv_scan", "SELECT n_name FROM nation")(lambda t: IO.round_trip(t.nation, _csv, lambda s, p: IO.read_text_table(s, p, ["n_name"]), "csv"))


@query("S6_matching_files", f"{NATION} UNION ALL {NATION}")
def _(t):
    path = fresh_path(t.spark, "many")
    for part in ("a", "b"):
        _csv(t.nation, f"{path}/{part}")
    return IO.read_matching(t.spark, path, "*.csv").select("n_nationkey", "n_name", "n_regionkey")


DESCRIPTION = [{"FIELD_NAME": "N_NATIONKEY", "PANDAS_TYPE": "Int64", "SQL_TYPE": "BIGINT", "SQL_CONSTRAINT": "PRIMARY KEY"}, {"FIELD_NAME": "N_NAME", "PANDAS_TYPE": "object", "SQL_TYPE": "VARCHAR(30)", "SQL_CONSTRAINT": ""}, {"FIELD_NAME": "N_COMMENT", "PANDAS_TYPE": "object", "SQL_TYPE": "VARCHAR(10)", "SQL_CONSTRAINT": ""}]


def _imported(t, **options):
    path = fresh_path(t.spark, "source")
    keyed = t.nation.withColumn("n_nationkey", F.when(F.col("n_nationkey") != 3, F.col("n_nationkey").cast("double")))
    _csv(keyed, path)
    return IO.import_table(t.spark, path, fresh_path(t.spark, "imported"), IO.schema_of(DESCRIPTION), "n_nationkey", **options)


IMPORTED = "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(NULL AS VARCHAR) AS n_comment{more} FROM nation WHERE n_nationkey <> 3"
query("S7_csv_import", IMPORTED.format(more=""))(lambda t: _imported(t))
query("S8_import_variants", IMPORTED.format(more=", true AS geo_flag"))(lambda t: _imported(t, append=True, constants={"geo_flag": True}))
query("S9_ddl_builder", "SELECT 'CREATE TABLE nations (n_nationkey BIGINT PRIMARY KEY, n_name VARCHAR(30), n_comment VARCHAR(10))' AS statement")(
    lambda t: t.spark.createDataFrame([(IO.create_statement("nations", DESCRIPTION),)], "statement string")
)
query("S10_schema_application", IMPORTED.format(more="").replace(" WHERE n_nationkey <> 3", ""))(lambda t: IO.apply_schema(t.nation, IO.schema_of(DESCRIPTION)))


@query("S11_if_exists_guard", "SELECT true AS refused")
def _(t):
    path = fresh_path(t.spark, "guarded")
    t.region.write.parquet(path)
    try:
        t.region.write.mode("errorifexists").parquet(path)
        refused = False
    except Exception as e:  # Spark's AnalysisException for a path that is there
        refused = "PATH_ALREADY_EXISTS" in str(e)
    return t.spark.createDataFrame([(refused,)], "refused boolean")


@query("S12_array_sink", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first, len(embedding) AS n FROM embeddings UNION ALL SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6), len(embedding) FROM embeddings")
def _(t):
    path = fresh_path(t.spark, "arrays")
    for _ in range(2):
        IO.append_table(t.embeddings, path)
    return t.spark.read.parquet(path).select("vec_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"), F.size("embedding").cast("long").alias("n"))


@query("S13_append_with_key", "SELECT count(*) AS n, true AS refused FROM supplier")
def _(t):
    path = fresh_path(t.spark, "keyed")
    IO.append_unique(t.supplier.where("s_suppkey % 2 = 0"), path, "s_suppkey")
    IO.append_unique(t.supplier.where("s_suppkey % 2 = 1"), path, "s_suppkey")
    try:
        IO.append_unique(t.supplier.where("s_suppkey = 1"), path, "s_suppkey")
        refused = False
    except ValueError:
        refused = True
    return t.spark.read.parquet(path).agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query("S14_csv_append", f"{NATION} UNION ALL {NATION}")
def _(t):
    path = fresh_path(t.spark, "appended")
    for _ in range(2):
        IO.append_csv(t.nation, path)
    return IO.read_text_table(t.spark, path).select("n_nationkey", "n_name", "n_regionkey")


query("S15_index_sink", "SELECT CAST(s_suppkey AS VARCHAR) || CAST(s_nationkey AS VARCHAR) AS _id, s_name FROM supplier")(
    lambda t: IO.round_trip(IO.with_document_id(t.supplier, "s_suppkey", "s_nationkey").select("_id", "s_name"), IO.append_table, IO.read_table, "index")
)
query("S16_index_export", "SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN CAST(45 + s_nationkey AS VARCHAR) || ', ' || CAST(s_nationkey AS VARCHAR) END AS location, s_nationkey < 20 AS geo_flag FROM supplier")(
    lambda t: IO.with_location(t.supplier, t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"), (F.col("n_nationkey") + 45).alias("latitude"), F.col("n_nationkey").alias("longitude")), "s_nationkey").select("s_suppkey", "location", "geo_flag")
)
query("S17_point_lookup", "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")(lambda t: IO.point_lookup(t.customer, "c_custkey", 7).select("c_custkey", "c_name"))
query("S18_artefact_round_trip", "SELECT p_partkey, p_brand FROM part")(
    lambda t: IO.round_trip(t.part.select("p_partkey", "p_brand"), lambda df, p: df.write.json(p), lambda s, p: s.read.schema("p_partkey long, p_brand string").json(p), "json")
)
query("S24_many_sources", "SELECT n_name, r_name, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")(
    lambda t: t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"))
)


@query("S26_metrics_crawl", "SELECT n_name AS run, CAST(n_nationkey AS VARCHAR) AS score FROM nation")
def _(t):
    path = fresh_path(t.spark, "runs")
    rows = t.nation.select(F.col("n_name").alias("run"), F.col("n_nationkey").alias("score"))
    for part in range(2):
        _csv(rows.where(F.col("score") % 2 == part), f"{path}/2020-0{part + 1}-01/metric")
    # data files are named by Spark, so the folder's name is matched
    return IO.read_text_table(t.spark, f"{path}/*/metric*").orderBy(F.desc(F.col("score").try_cast("double"))).select("run", "score")
