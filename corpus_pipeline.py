"""The corpus pipeline: five operators over the whole of documents, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontaminate, lines, mixing, neardup, quality
from pairloom.session import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("score") >= quality.REJECT_BELOW).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines; a document that loses every line of its text goes."""
    done = lines.drop_recurring_lines(docs).where((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    return done.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.drop_near_duplicates(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order of training: which document comes where, in which epoch of its source."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
]

#: The classifier is fitted and near duplicates are found by sketches: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
