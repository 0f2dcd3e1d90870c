"""Reading, importing and writing tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.sources.shared import fresh_path

#: Names of types in table descriptions.
TYPES = {"object": "string", "str": "string", "string": "string", "Int32": "int", "Int64": "bigint", "int64": "bigint", "float64": "double", "bool": "boolean", "[float64]": "array<double>", "datetime64[ns]": "timestamp"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than cores, such as one file, dealt out over all cores before costly work; others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A SQL query over DataFrames named in it as {name}."""
    return spark.sql(sql, **tables)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table in parallel ranges of an integer column."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, **options).load()


def read_text_table(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, separator: str = ";", header: bool = True) -> DataFrame:
    """CSV with every column a string; columns keeps some, and the scan reads no others."""
    df = spark.read.option("sep", separator).option("header", header).option("escape", '"').option("multiLine", False).csv(paths if isinstance(paths, str) else list(paths))
    return df.select(*columns) if columns else df


def read_matching(spark: SparkSession, folder: str, pattern: str, separator: str = ";") -> DataFrame:
    """All CSV files of a folder whose names match, with the file each row is from."""
    df = spark.read.option("sep", separator).option("header", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).csv(folder)
    return df.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def schema_of(description: Iterable[tuple[str, str] | Mapping]) -> T.StructType:
    """A schema from rows of field name and type name; names in lower case."""
    fields = []
    for row in description:
        name, kind = (row["FIELD_NAME"], row["PANDAS_TYPE"]) if isinstance(row, Mapping) else row[:2]
        fields.append(f"`{name.lower()}` {TYPES[kind]}")
    return T.StructType.fromDDL(", ".join(fields))


def create_statement(table: str, description: Iterable[Mapping]) -> str:
    """CREATE TABLE of a description's names, SQL types and constraints."""
    rows = [f"{r['FIELD_NAME'].lower()} {r['SQL_TYPE']}{' ' + r['SQL_CONSTRAINT'] if r.get('SQL_CONSTRAINT') else ''}" for r in description]
    return f"CREATE TABLE {table} ({', '.join(rows)})"


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order: names in lower case, values cast (null where they can't be), absent ones null.

    Integers may be written as decimals; arrays may be written as text.
    """
    have = {c.lower(): c for c in df.columns}

    def made(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{have[f.name]}`")
        text = dict(df.dtypes)[have[f.name]] == "string"
        if text and isinstance(f.dataType, T.ArrayType):
            c = F.from_json(c, f.dataType)
        elif text and isinstance(f.dataType, T.IntegralType):
            c = c.try_cast("double").try_cast(f.dataType)
        elif text:
            c = F.nullif(c, F.lit("")).try_cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        return c.alias(f.name)

    return df.select(*[made(f) for f in schema.fields])


def import_table(spark: SparkSession, paths: str | Sequence[str], target: str, schema: T.StructType, key: str, force: bool = False, append: bool = False, constants: Mapping[str, object] | None = None, separator: str = ";") -> DataFrame:
    """CSV files to a table of a declared schema, rows without a key left out; fails where the table is and force is not."""
    rows = apply_schema(read_text_table(spark, paths, separator=separator), schema).dropna(subset=[key])
    for name, value in (constants or {}).items():
        rows = rows.withColumn(name, F.lit(value))
    rows.write.mode("append" if append else "overwrite" if force else "errorifexists").parquet(target)
    return spark.read.parquet(target)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_unique(df: DataFrame, path: str, key: str) -> None:
    """Append, once it is sure that neither df nor the table with it repeats a key."""
    spark = df.sparkSession
    before = spark.read.parquet(path).select(key) if _exists(spark, path) else None
    keys = df.select(key) if before is None else df.select(key).union(before)
    repeated = keys.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{key} would repeat: {[r[0] for r in repeated]}")
    append_table(df, path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def append_csv(df: DataFrame, path: str, separator: str = ";") -> None:
    """Append to a folder of CSV files, each with its header."""
    df.write.mode("append").option("sep", separator).option("header", True).csv(path)


def with_document_id(df: DataFrame, *parts: str) -> DataFrame:
    """The id under which a record is indexed: its key columns one after another."""
    return df.withColumn("_id", F.concat(*[F.col(p).cast("string") for p in parts]))


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value)


def with_location(df: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """A record's point as "lat, lon" and whether it has one."""
    joined = df.join(places.select(key, "latitude", "longitude"), key, "left")
    return joined.withColumn("location", F.concat(F.col("latitude").cast("string"), F.lit(", "), F.col("longitude").cast("string"))).withColumn("geo_flag", F.col("location").isNotNull()).drop("latitude", "longitude")


def newest_metrics(spark: SparkSession, folder: str, order: str, separator: str = ";") -> DataFrame:
    """All metric files below a folder as one table, best first."""
    return read_matching(spark, folder, "*metric*", separator).orderBy(F.desc(F.col(order).try_cast("double")))


def round_trip(df: DataFrame, write: Callable[[DataFrame, str], None], read: Callable[[SparkSession, str], DataFrame], name: str) -> DataFrame:
    """A table written to and read from the shared folder."""
    path = fresh_path(df.sparkSession, name)
    write(df, path)
    return read(df.sparkSession, path)


def store_artefact(df: DataFrame, folder: str, statement: str, parameters: Mapping) -> str:
    """Write a table under a folder of its own, with the statement and parameters that it was made by beside it."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/data")
    made = [(statement, json.dumps(parameters, sort_keys=True), f"{path}/data")]
    df.sparkSession.createDataFrame(made, "statement string, parameters string, path string").write.json(f"{path}/made_by")
    return path


def usable_artefacts(spark: SparkSession, folder: str, wanted: Sequence[tuple[str, Mapping]]) -> DataFrame:
    """statement, parameters, usable, path: whether an artefact of just that statement and those parameters is stored, and where."""
    asked = spark.createDataFrame([(s, json.dumps(p, sort_keys=True)) for s, p in wanted], "statement string, parameters string")
    stored = spark.read.schema("statement string, parameters string, path string").json(f"{folder}/*/made_by")
    newest = stored.groupBy("statement", "parameters").agg(F.max("path").alias("path"))
    return asked.join(newest, ["statement", "parameters"], "left").withColumn("usable", F.col("path").isNotNull())
