"""Global order without a one-task window: row numbers, shards, slices and caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import stored


def numbered(rows: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """rows with rn (0, 1, ...), their place in the order of keys.

    Range-partitioned and stored, so that every task numbers its own range; offsets come from a table of one row a
    partition. Equal keys get places in no set order.
    As many ranges as the session has shuffle partitions, if not said otherwise.
    """
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = stored(rows.repartitionByRange(partitions, *keys).withColumn("_part", F.spark_partition_id()))
    own = part.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*keys)))
    sizes = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return own.join(F.broadcast(offsets), "_part").withColumn("rn", F.col("_before") + F.col("_n") - 1).drop("_part", "_n", "_before")


def shards(rows: DataFrame, key: str, n: int) -> DataFrame:
    """rows with shard (contiguous chunks of ceil(rows / n) in the order of key) and slice (every n-th row)."""
    at = numbered(rows, key)
    chunk = F.greatest(F.ceil(F.lit(at.count()) / n), F.lit(1))
    return at.withColumn("shard", F.floor(F.col("rn") / chunk).cast("int")).withColumn("slice", F.pmod("rn", F.lit(n)).cast("int"))
