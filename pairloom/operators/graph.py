"""Connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import cut


def _rank(col: str) -> Column:
    return F.struct(F.xxhash64(col).alias("h"), F.col(col).alias("v"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) for every vertex that an edge names; component is the least id in it.

    Each round maps a vertex to the lowest-ranked vertex of its closed neighbourhood and contracts the edges. The rank
    is a hash of the id, so that long sorted chains also shrink by a constant factor a round: rounds grow with the
    logarithm of the longest chain, and each works on a smaller edge table. All aggregates combine before they shuffle,
    so a vertex with very many edges costs its task one row from each map task. Null ends and self loops make no edge
    (a self loop still names its vertex). An empty edge table gives an empty result.
    """
    both = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    edges = current = cut(both.union(both.select("b", "a")).distinct())
    current, steps = current.where("a <> b"), []
    while not current.isEmpty():
        to = current.groupBy("a").agg(F.least(F.min(_rank("b")), _rank("a"))["v"].alias("to"))
        steps.append(to)
        ends = current.join(to, "a").select(F.col("to").alias("a"), "b")
        ends = ends.join(to.withColumnRenamed("a", "b"), "b").select("a", F.col("to").alias("b"))
        current = cut(ends.where("a <> b").distinct())
    labels = edges.select(F.col("a").alias("id")).distinct().withColumn("label", F.col("id"))
    for to in steps:
        labels = labels.join(to.withColumnRenamed("a", "label"), "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    labels = cut(labels)
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(least, "label").select("id", "component")
