"""A corpus pipeline over ``documents``: language ID, near duplicates, secrets, packing.

Each stage is one operator of lexisift.llm applied to all that the stage before it kept. Stages but the last
return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisift.llm.common import fresh_path, remove, small_batches, table, unused
from lexisift.llm.jaccard_join import near_duplicates
from lexisift.llm.langid_crf import UNKNOWN, held_out, identify, train
from lexisift.llm.packing import pack
from lexisift.llm.secret_scan import redact

#: A text whose words are on average less likely than this to be in any one language, each in its own, has none that can be told.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words' languages are told: texts that are null, without letters, or of no clear language go.

    Texts of several languages stay. Where no language is learned, for want of labels, all texts with letters stay.
    """
    small_batches(spark)
    model = train(docs.where(~held_out()))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    labelled = identify(docs, model, confidence=True)
    return labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("confidence") >= LEAST_SCORE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are joined by near-duplicate links the one with the smallest doc_id stays.

    Rows with the same doc_id count as one document, of which one row stays; rows without a doc_id stay.
    """
    small_batches(spark)
    found = near_duplicates(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    row = unused(docs, "row")
    kept = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").withColumn(row, rank).where(F.col(row) == 1)
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what looks like a live secret or a copied example of one masked in the text."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the windows that the documents are packed into."""
    small_batches(spark)
    return pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", one_of_each_group), ("secrets", secrets), ("packing", packing)]

#: No stage but secrets can be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written in the shared folder, read by the next, and deleted after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
