"""Near duplicates among embeddings, through an index of each vector's nearest reference points."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.whitening import usable, vectors_of
from pairloom.operators.graph import connected_components
from pairloom.session import stored

SIMILAR = 0.9
#: Reference points, vectors that they are chosen from, and their greatest cosine with each other.
PIVOTS, SAMPLE, APART = 1024, 4096, 0.7
#: Nearest reference points that describe a vector, and how many of them two vectors must share.
NEAREST, SHARED = 8, 2
#: Vectors of a list in a block, and of a block that are compared with another block at a time.
BLOCK, STRIP = 2048, 128


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def reference_points(sample: list[list[float]]) -> Callable[[int], np.ndarray]:
    """Reference points for vectors of a length: vectors of the sample that lie apart from each other, then directions
    from a fixed seed that do. Copies in the sample would share their surroundings among themselves; in few dimensions
    few directions lie apart, and more of them would separate vectors that are to be linked."""
    by_length: dict[int, list[list[float]]] = defaultdict(list)
    for v in sample:
        by_length[len(v)].append(v)
    made: dict[int, np.ndarray] = {}

    def points(d: int) -> np.ndarray:
        if d not in made:
            drawn = np.random.default_rng(d).normal(size=(PIVOTS, d))
            out, k = np.empty((PIVOTS, d)), 0
            for v in unit(np.concatenate([np.array(by_length[d], np.float64).reshape(-1, d), drawn])):
                if k < PIVOTS and (k == 0 or (out[:k] @ v).max() < APART):
                    out[k] = v
                    k += 1
            for v in unit(drawn[: max(0, NEAREST - k)]):
                out[k] = v
                k += 1
            made[d] = out[:k]
        return made[d]

    for d in list(by_length):
        if d:
            points(d)
    by_length.clear()
    return points


def nearest(points: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The nearest reference points of each vector, nearest first."""
    s = -(unit(x) @ points.T)
    first = np.argpartition(s, NEAREST - 1, axis=1)[:, :NEAREST]
    return np.take_along_axis(first, np.argsort(np.take_along_axis(s, first, 1), axis=1, kind="stable"), 1).astype(np.int32)


def _described(points: Callable[[int], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list = [None] * b.num_rows
            for at, x in vectors_of(b.column("v")):
                for i, p in zip(at.tolist(), nearest(points(x.shape[1]), x).tolist(), strict=True):
                    made[i] = p
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.list_(pa.int32()))], [*b.schema.names, "pivots"])

    return run


def _compared(threshold: float) -> Callable[[tuple, pa.Table], pa.Table]:
    """Two blocks of a list, or one with itself -> for each vector in a link of this list its number of links, and one
    vector that it is joined with here."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        own, i, j = (key[n].as_py() for n in (1, 2, 3))
        block, ids, copies = (t.column(n).to_numpy() for n in ("block", "id", "copies"))
        ranks = t.column("ranks").chunk(0).values.to_numpy().reshape(len(ids), NEAREST)
        x = unit(t.column("v").chunk(0).values.to_numpy().reshape(len(ids), -1))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        # the right side's reference points, sorted, each with the vectors that have it
        point, who = ranks[right].ravel(), np.repeat(np.arange(len(right)), NEAREST)
        order = np.argsort(point, kind="stable")
        point, who = point[order], who[order]
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(0, len(left), STRIP):
            strip = left[a : a + STRIP]
            q, row = ranks[strip].ravel(), np.repeat(np.arange(len(strip)), NEAREST)
            from_, to = np.searchsorted(point, q), np.searchsorted(point, q, side="right")
            many = to - from_
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(from_, many)
            cell, q = np.repeat(row, many) * len(right) + who[at], np.repeat(q, many)
            shared = np.bincount(cell, minlength=len(strip) * len(right))
            earlier = np.bincount(cell[q < own], minlength=len(shared))
            # a pair belongs to the list of the first point that both have
            u, v = np.divmod(np.flatnonzero((shared >= SHARED) & (earlier == 0)), len(right))
            u, v = strip[u], right[v]
            if i == j:
                u, v = u[u < v], v[u < v]
            for k in range(0, len(u), 1 << 16):
                p, r = u[k : k + (1 << 16)], v[k : k + (1 << 16)]
                near = np.einsum("ij,ij->i", x[p], x[r]) >= threshold
                p, r = p[near], r[near]
                np.add.at(links, p, copies[r])
                np.add.at(links, r, copies[p])
                while (label[p] != label[r]).any():
                    least = np.minimum(label[p], label[r])
                    np.minimum.at(label, label[p], least)
                    np.minimum.at(label, label[r], least)
                    np.minimum.at(label, p, least)
                    np.minimum.at(label, r, least)
                    label = label[label]
        while (label != label[label]).any():
            label = label[label]
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some], "to": ids[label[some]]})

    return run


def linked_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = SIMILAR) -> DataFrame:
    """rows -> key, n_links long, component_id (of key's type), kept boolean: one row for each row. Two rows are linked
    if the cosine of their vectors, in double precision, is at least the threshold; component_id is the least key that
    links lead to, kept says that it is the row's own.

    1. Equal vectors are one, with a count. 2. Reference points: at most 1024 vectors that lie apart, of a sample of at
    most 4096 distinct ones (the least by a hash), filled up with random directions. The sample is all the driver sees. 3.
    A vector is described by its 8 nearest points, in order. 4. Inverted lists: points are ranked, rare ones first; a
    vector goes into the lists of its points but the last, for whoever shares two points with it shares one of these. 5.
    Long lists are cut into blocks, a task compares two: pairs that share two points or more are verified by their
    cosines; a pair is looked at in one list only. A task returns at most a row for each vector it was given, not
    pairs. 6. Components of these rows.

    Nothing is dropped from long lists, every link found is a true one, and counts are of rows. A pair is missed if it
    shares fewer than two of 8 points: of random pairs in 64 dimensions that have a cosine of just 0.9 about 2 %, of 0.95
    0.1 %. Lists grow with the rows, so comparisons grow with rows^2 / 700 for vectors spread evenly.

    Vectors that are null, zero or hold null or non-finite components have no links, not even with equal ones, and are
    their own component. Vectors of different lengths have no links. Rows with equal keys are vectors of their own; a
    component's least key leaves nulls out and is null if there is no other. Other columns are ignored, an empty table
    gives an empty one.
    """
    good = usable(vector) & F.exists(vector, lambda c: c != 0)
    given = rows.select(F.col(key).alias("key"), F.when(good, F.transform(vector, lambda c: c.cast("double") + F.lit(0.0))).alias("v"))
    texts = given.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    heads = stored(texts.withColumn("id", F.monotonically_increasing_id()))
    sample = heads.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    points = reference_points([r["v"] for r in sample])
    described = stored(heads.select("id", "copies", "v").mapInArrow(_described(points), "id bigint, copies bigint, v array<double>, pivots array<int>"))

    spread = described.select(F.size("v").alias("d"), F.explode("pivots").alias("p")).groupBy("d", "p").agg(F.count(F.lit(1)).alias("n")).collect()
    ranked = sorted(spread, key=lambda r: (r["d"], r["n"], r["p"]))  # at most PIVOTS rows for each length
    table = [(r["d"], r["p"], i, -(-r["n"] // BLOCK)) for i, r in enumerate(ranked)]
    spark = rows.sparkSession
    order = F.broadcast(spark.createDataFrame(table, "d int, p int, rank int, blocks int"))
    listed = described.select("id", F.size("v").alias("d"), F.explode("pivots").alias("p")).join(order, ["d", "p"])
    listed = listed.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "blocks"))).alias("r"))  # 8 entries a vector
    entries = listed.select("id", F.col("r.rank").alias("ranks"), F.explode(F.slice("r", 1, NEAREST - SHARED + 1)).alias("e"))
    block = F.pmod(F.xxhash64("id"), F.col("e.blocks")).cast("int")
    placed = entries.select("id", "ranks", F.col("e.rank").alias("own"), block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("e.blocks") - 1)).alias("other"))
    placed = placed.select("id", "ranks", "own", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    dealt = placed.join(described.select("id", "copies", "v"), "id").select(F.size("v").alias("d"), "own", "i", "j", "block", "id", "copies", "ranks", "v")
    found = stored(dealt.groupBy("d", "own", "i", "j").applyInArrow(_compared(threshold), "id bigint, links bigint, to bigint"))

    component = connected_components(found.where("id <> to"), "id", "to")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = heads.select("id", "v", "copies", "least").join(links, "id", "left").join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = stored(known)
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = given.where("v is not null").join(known, "v").select("key", "n_links", "component_id")
    alone = given.where("v is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
