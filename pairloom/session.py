"""Session helpers: table access and shared storage for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import pairloom

# Functions of this package travel to the executors as they are: they needn't have it installed.
cloudpickle.register_pickle_by_value(pairloom)

_STORED: list[str] = []
_TABLES: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; Spark does the reading, so any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's spark.checkpoint.dir. Where that is unset a local session gets one
    of its own; on a cluster it would be a folder that executors can't see, so it is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="pairloom-"))
    return named or sc.getCheckpointDir()


def clear_stored(spark: SparkSession) -> None:
    """Delete what stored(), bucketed() and scratch() paths hold so far. Results that still read it must have been written by then."""
    jvm = spark.sparkContext._jvm
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in shared storage, for whatever writes there itself; clear_stored() deletes it, too."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def spread(df: DataFrame, *by: str, times: int = 1) -> DataFrame:
    """Deal rows out (those of equal `by` together) over times as many tasks as shuffles have, two for each core at least:
    for work that costs more than its bytes tell. Spark makes one task of a small file and of small shuffles."""
    spark = df.sparkSession
    return df.repartition(times * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *by)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows go to shared storage and survive any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to shared storage and read them back. Columnar and compressed, so it suits wide
    intermediates that are read more than once, with fewer columns each time."""
    path = scratch(df.sparkSession, "pairloom")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str) -> DataFrame:
    """Store the rows as stored() does, in as many buckets of a column as shuffles have tasks: steps that group or join by it
    again and again, such as those of a stream's batches, needn't deal them out each time."""
    spark, name = df.sparkSession, f"pairloom_{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _TABLES.append(name)
    df.repartition(tasks, by).write.bucketBy(tasks, by).option("path", scratch(spark, "buckets")).saveAsTable(name, format="parquet")
    return spark.table(name)
