"""Distances on grids, by a transform of each grid along one axis after another."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
#: Cells of a grid's box: what a task holds at once, eight bytes each.
MOST = 1 << 27


def along_axis(f: np.ndarray, axis: int) -> np.ndarray:
    """At each place of a line the least of f there and of all other places' f plus the square of the way from them: the
    lower envelope of parabolas. A way whose square is no less than the worst result so far can't better any."""
    f = np.moveaxis(f, axis, 0)
    out = f.copy()
    for way in range(1, len(f)):
        if way * way >= out.max():
            break
        np.minimum(out[way:], f[:-way] + way * way, out=out[way:])
        np.minimum(out[:-way], f[way:] + way * way, out=out[:-way])
    return np.moveaxis(out, 0, axis)


def transform(cells: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The squared distance of each cell (n x 3 integers) to the nearest cell of reference (not empty)."""
    both = np.concatenate([cells, reference])
    low = both.min(axis=0)
    shape = both.max(axis=0) - low + 1
    if float(np.prod(shape.astype(np.float64))) > MOST:
        raise ValueError(f"a grid of {' x '.join(map(str, shape))} cells is too large to be held")
    f = np.full(shape, np.int64(4) * int((shape.astype(np.int64) ** 2).sum()))
    f[tuple((reference - low).T)] = 0
    for axis in range(len(shape)):
        f = along_axis(f, axis)
    return f[tuple((cells - low).T)]


def _places(t: pa.Table) -> np.ndarray:
    return np.stack([t.column(a).to_numpy() for a in AXES], axis=1).astype(np.int64)


def _measured(t: pa.Table) -> pa.Table:
    ref = t.filter(t.column("_ref"))
    cells = t.filter(pc.invert(t.column("_ref"))).drop_columns("_ref")
    if not ref.num_rows or not cells.num_rows:
        return cells.append_column("d2", pa.nulls(cells.num_rows, pa.int64()))
    return cells.append_column("d2", pa.array(transform(_places(cells), _places(ref)), pa.int64()))


def squared_distances(cells: DataFrame, reference: DataFrame, keys: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """cells (keys, x, y, z, ...), reference (keys, x, y, z) -> cells with d2 long: the squared distance to the nearest
    cell of reference with the same keys, exactly; null where there is none.

    One shuffle on the keys. A task holds one grid, the box around its cells and reference, and takes it through three
    passes of a line's length at most, however many cells there are. x, y, z are integers and not null; rows may repeat.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema) + ", d2 bigint"
    ref = reference.select(*keys, *AXES).distinct()
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in cells.schema if f.name not in (*keys, *AXES)]
    same = [F.col(f.name).cast(f.dataType).alias(f.name) for f in cells.schema if f.name in (*keys, *AXES)]
    both = cells.withColumn("_ref", F.lit(False)).unionByName(ref.select(*same, *rest, F.lit(True).alias("_ref")))
    return both.groupBy(*keys).applyInArrow(_measured, schema)


def decay(cells: DataFrame, reference: DataFrame, sigma: Column | float, keys: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """cells, reference (keys, x, y, z) -> cells with d (to the nearest of reference) and weight = exp(-d / sigma), 0 where
    there is no reference. sigma can be a column of cells."""
    width = F.greatest(sigma if isinstance(sigma, Column) else F.lit(float(sigma)), F.lit(1e-6))
    n = squared_distances(cells, reference, keys).withColumn("d", F.sqrt("d2")).drop("d2")
    return n.withColumn("weight", F.coalesce(F.exp(-F.col("d") / width), F.lit(0.0)))


def block_keep(dense: DataFrame, contact: DataFrame, edited: DataFrame, sigma: Column | float) -> DataFrame:
    """dense (pair_id, x, y, z: all blocks), contact, edited (blocks) -> dense with keep: 0 in edited blocks, else
    1 - exp(-d / sigma) with the distance to the nearest contact block, or where a pair has none to the nearest edited
    one. A pair without either keeps everything: 1."""
    without = edited.join(contact.select("pair_id").distinct(), "pair_id", "left_anti")
    cell = ["pair_id", *AXES]
    near = decay(dense, contact.select(*cell).union(without.select(*cell)), sigma)
    own = edited.select(*cell).distinct().withColumn("_own", F.lit(True))
    return near.join(own, cell, "left").select(*dense.columns, F.when(F.col("_own"), 0.0).otherwise(1 - F.col("weight")).alias("keep"))
