"""Manifests: JSON lines in, records partitioned by type and shard out, in snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.sources import snapshots

_BAD = "_corrupt"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines). Blank lines are neither; a line that is no object is malformed. A path where there is
    nothing has no records."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    lines = (spark.read.text(path) if found else spark.range(0).select(F.lit("").alias("value"))).where(F.trim("value") != "")
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = lines.select("value", F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}).alias("r"))
    bad = F.col(f"r.{_BAD}").isNotNull() | F.col("r").isNull() | ~F.ltrim("value").startswith("{")
    return parsed.where(~bad).select("r.*").drop(_BAD), parsed.where(bad).select(F.col("value").alias("line"))


_PARTITIONS = ("edit_type", "shard")


def append(records: DataFrame, path: str) -> int:
    """Add records and tell how many: all of them are there for readers, or none. Writers can append at once."""
    return snapshots.commit(records, path, _PARTITIONS)


def rewrite(records: DataFrame, path: str, whole: bool = False) -> int:
    """Replace the partitions that records are in, or the whole manifest, and tell how many records there are. A reader
    has the old manifest or the new one, never a part of either. An object's rows of a partition go to one file, sorted."""
    ordered = records.repartition(*_PARTITIONS, "obj_id").sortWithinPartitions(*_PARTITIONS, "obj_id")
    return snapshots.commit(ordered, path, _PARTITIONS, "all" if whole else "touched")


def read(spark: SparkSession, path: str, **only: str) -> DataFrame | None:
    """The manifest as its last commit left it; None if there is none. only: see snapshots.read."""
    return snapshots.read(spark, path, **only)
