"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a local master gets a temporary folder, any other an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lexisift-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own: rows keep their partitions' order and are not computed twice."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
