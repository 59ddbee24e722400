"""Sparse grids: set algebra, dilation and masks over voxel tables, all keyed by pair."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["pair_id", "x", "y", "z"]


def cell_key(grid: int) -> Column:
    return F.col("x").cast("long") * grid * grid + F.col("y") * grid + F.col("z")


def cell_of(key: Column, grid: int) -> list[Column]:
    """x, y, z of a key."""
    return [F.floor(key / (grid * grid)).cast("int").alias("x"), F.pmod(F.floor(key / grid), F.lit(grid)).cast("int").alias("y"), F.pmod(key, F.lit(grid)).cast("int").alias("z")]


def downsample(cells: DataFrame, factor: int) -> DataFrame:
    return cells.select("pair_id", *[F.floor(F.col(a) / factor).cast("int").alias(a) for a in "xyz"]).distinct()


def dilate(cells: DataFrame, pad: int, grid: int) -> DataFrame:
    """All cells within pad along every axis, clipped to the grid: three passes along one axis each, so a cell makes
    3 * (2 pad + 1) rows at most instead of the cube of it."""
    out = cells.select(*CELL)
    for axis in "xyz":
        around = F.sequence(F.greatest(F.col(axis) - pad, F.lit(0)), F.least(F.col(axis) + pad, F.lit(grid - 1)))
        out = out.select(*[F.explode(around).alias(a) if a == axis else F.col(a) for a in CELL]).distinct()
    return out


def part_region(cells: DataFrame, part: int, pad: int, grid: int) -> DataFrame:
    """Cells around a part, without those of other parts."""
    return dilate(cells.where(F.col("part_id") == part), pad, grid).join(cells.where(F.col("part_id") != part), CELL, "left_anti")


def set_counts(cells: DataFrame) -> DataFrame:
    """pair_id, only_before, only_after, common, iou, diff_ratio from the flags of one pass over the cells."""
    b, a = F.col("in_before") == 1, F.col("in_after") == 1
    c = cells.groupBy("pair_id").agg(F.count_if(b & ~a).alias("only_before"), F.count_if(a & ~b).alias("only_after"), F.count_if(a & b).alias("common"))
    union = F.col("only_before") + F.col("only_after") + F.col("common")
    return c.select("*", F.round(F.col("common") / F.greatest(union, F.lit(1)), 6).alias("iou"), F.round((F.col("only_before") + F.col("only_after")) / F.greatest(union, F.lit(1)), 6).alias("diff_ratio"))


def bridged(before: DataFrame, after: DataFrame, region: DataFrame) -> DataFrame:
    """After cells that are preserved, with before_row: the place of the same cell among the before cells (0, 1, ... in
    order of x, y, z)."""
    rows = before.select(*CELL, (F.row_number().over(Window.partitionBy("pair_id").orderBy("x", "y", "z")) - 1).alias("before_row"))
    return after.select(*CELL).distinct().join(rows, CELL).join(region, CELL, "left_anti")


def restored(cells: DataFrame, region: DataFrame) -> DataFrame:
    """pair_id, n_restored: before cells that restore() adds."""
    return cells.where("in_before = 1 AND in_after = 0").join(region, CELL, "left_anti").groupBy("pair_id").agg(F.count(F.lit(1)).alias("n_restored"))


def preserved(cells: DataFrame, region: DataFrame) -> DataFrame:
    """Cells of both sides outside the region."""
    return cells.where("in_before = 1 AND in_after = 1").join(region, CELL, "left_anti")


def warm_start(cells: DataFrame, region: DataFrame) -> DataFrame:
    return cells.where("in_before = 1 AND in_after = 1").join(region, CELL, "left_semi")


def restore(cells: DataFrame, region: DataFrame) -> DataFrame:
    """After cells and the before cells outside the region that are missing there."""
    after = cells.where("in_after = 1").select(*CELL)
    return after.union(cells.where("in_before = 1 AND in_after = 0").select(*CELL).join(region, CELL, "left_anti"))


def repasted(before: DataFrame, after: DataFrame, region: DataFrame, features: list[str]) -> DataFrame:
    """After cells with the features of before where the cell is preserved: on both sides and outside the region."""
    b = before.select(*CELL, F.struct(*features).alias("_b"))
    r = region.select(*CELL).distinct().withColumn("_r", F.lit(True))
    j = after.select(*CELL, *features).join(b, CELL, "left").join(r, CELL, "left")
    kept = F.col("_b").isNotNull() & F.col("_r").isNull()
    return j.select(*CELL, *[F.when(kept, F.col(f"_b.{f}")).otherwise(F.col(f)).alias(f) for f in features], kept.alias("preserved"))


def keep_blocks(region: DataFrame, factor: int = 4, tenth: int = 1) -> DataFrame:
    """Blocks that count as edited: at least a tenth of their cells are in the region."""
    blocks = region.groupBy("pair_id", *[F.floor(F.col(a) / factor).cast("int").alias(a) for a in "xyz"]).agg(F.count(F.lit(1)).alias("n"))
    return blocks.where(F.col("n") * 10 >= tenth * factor**3)


def _labelled(grid: int, axes: str, moves: list[tuple[int, ...]]) -> Callable[[pa.Table], pa.Table]:
    """The cells of one pair, each with the least cell that it is connected with."""
    step = [grid ** (len(axes) - 1 - i) for i in range(len(axes))]

    def run(t: pa.Table) -> pa.Table:
        places = [t.column(a).to_numpy().astype(np.int64) for a in axes]
        key = sum(p * d for p, d in zip(places, step, strict=True))
        order = np.argsort(key, kind="stable")
        sorted_key, label = key[order], np.arange(len(key))
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for m in moves:
            inside = np.ones(len(key), bool)
            for p, d in zip(places, m, strict=True):
                inside &= (p + d >= 0) & (p + d < grid)
            a = np.flatnonzero(inside[order])
            to = sorted_key[a] + sum(x * d for x, d in zip(m, step, strict=True))
            b = np.minimum(np.searchsorted(sorted_key, to), len(key) - 1)
            there = sorted_key[b] == to
            ends.append((a[there], b[there]))
        a, b = (np.concatenate(e) for e in zip(*ends, strict=True))
        while (label[a] != label[b]).any():  # roots meet, then everything points at its root
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], least)
            np.minimum.at(label, label[b], least)
            while (label != label[label]).any():
                label = label[label]
        component = np.empty(len(key), np.int64)
        component[order] = sorted_key[label]
        number = t.column("pair_id").to_numpy().astype(np.int64) * grid ** len(axes) + component
        return t.append_column("component", pa.array(number, pa.int64()))

    return run


def component_labels(cells: DataFrame, grid: int, corners: bool = False, axes: str = "xyz") -> DataFrame:
    """cells (pair_id and axes, distinct) with component, the number of the connected component that each is in: cells
    that share a face (an edge of pixels), or a corner too. One shuffle by pair; a task labels one grid at a time, which
    is bounded by its side."""
    moves = [m for m in product((-1, 0, 1), repeat=len(axes)) if m > (0,) * len(axes) and (corners or sum(map(abs, m)) == 1)]
    given = cells.select("pair_id", *axes)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema) + ", component bigint"
    return given.groupBy("pair_id").applyInArrow(_labelled(grid, axes, moves), schema)


def component_counts(cells: DataFrame, grid: int) -> DataFrame:
    """pair_id, n_components, largest of 6-connected cells."""
    sizes = component_labels(cells, grid).groupBy("pair_id", "component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n_components"), F.max("n").alias("largest"))


def large_components(cells: DataFrame, grid: int, least: int) -> DataFrame:
    """The cells of components of at least so many cells."""
    labels = component_labels(cells, grid)
    return labels.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("pair_id", "component"))).where(F.col("n") >= least).select(*CELL)


def _enclosed(empty: DataFrame, grid: int, axes: str) -> DataFrame:
    """The empty cells that can't be reached from the border through empty cells."""
    labels = component_labels(empty, grid, axes=axes)
    border = F.lit(False)
    for a in axes:
        border = border | F.col(a).isin(0, grid - 1)
    outside = labels.groupBy("component").agg(F.max(border).alias("out")).where("out")
    return labels.join(outside, "component", "left_anti").select("pair_id", *axes)


def holes(white: DataFrame, grid: int, least: int, large: int) -> DataFrame:
    """white (pair_id, x, y: background pixels of an image) -> pair_id, n_holes, largest, total, hole: background within
    the object, as 8-connected areas of at least `least` pixels; a hole is one of `large` at least. Images without any
    give no row."""
    areas = component_labels(_enclosed(white, grid, "xy"), grid, corners=True, axes="xy").groupBy("pair_id", "component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return areas.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n_holes"), F.max("n").alias("largest"), F.sum("n").alias("total"), (F.max("n") >= large).alias("hole"))


def every_cell(pairs: DataFrame, grid: int, axes: str = "xyz") -> DataFrame:
    """All cells of a dense grid for each pair."""
    out = pairs.select("pair_id").distinct()
    for a in axes:
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    return out


def solid_fill(shell: DataFrame, grid: int, growth: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """(shell and what it encloses, pair_id and watertight: whether it grew by more than 15 %)."""
    cells = shell.select(*CELL).distinct()
    inside = _enclosed(every_cell(cells, grid).join(cells, CELL, "left_anti"), grid, "xyz").select(*CELL)
    filled = cells.withColumn("own", F.lit(1)).union(inside.withColumn("own", F.lit(0)))
    n = filled.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("n_shell"))
    return filled.select(*CELL), n.select("pair_id", "n", "n_shell", (F.col("n") > F.col("n_shell") * (1 + growth)).alias("watertight"))


def _faces(cells: DataFrame, grid: int) -> DataFrame:
    """The cells next to each cell, itself aside, within the grid."""
    around = F.array(*[F.struct(*[(F.col(a) + (d if a == axis else 0)).alias(a) for a in "xyz"]) for axis in "xyz" for d in (-1, 1)])
    out = cells.select("pair_id", F.explode(around).alias("c")).select("pair_id", "c.*")
    return out.where((F.least("x", "y", "z") >= 0) & (F.greatest("x", "y", "z") < grid)).distinct()


def contact(region: DataFrame, before: DataFrame, grid: int) -> tuple[DataFrame, DataFrame]:
    """(contact cells: those of the region that touch a preserved cell; pair_id, n_contact, n_surface, ratio, sigma1,
    sigma2). Preserved are before cells outside the region, the surface are the cells around the region."""
    preserved = before.select(*CELL).distinct().join(region, CELL, "left_anti")
    touched = region.select(*CELL).join(_faces(preserved, grid), CELL, "left_semi")
    surface = _faces(region.select(*CELL), grid).join(region, CELL, "left_anti")
    n = lambda df, name: df.groupBy("pair_id").agg(F.count(F.lit(1)).alias(name))
    counts = n(region, "_n").join(n(touched, "n_contact"), "pair_id", "left").join(n(surface, "n_surface"), "pair_id", "left").na.fill(0, ["n_contact", "n_surface"])
    ratio = F.least(F.col("n_contact") / F.greatest("n_surface", F.lit(1)), F.lit(1.0))
    # fixed values: how wide a transition is at both resolutions, without contact and by share of contact
    return touched, counts.select("pair_id", "n_contact", "n_surface", ratio.alias("ratio"), (1.5 + 4.0 * ratio).alias("sigma1"), (2.0 + 10.0 * ratio).alias("sigma2"))


def densified(after: DataFrame, region: DataFrame, by: int, grid: int) -> DataFrame:
    """After cells, and the cells within `by` of them that are within `by` of the region."""
    grown = dilate(after, by, grid).join(dilate(region, by, grid), CELL, "left_semi")
    return after.select(*CELL).union(grown).distinct()


def _line_mean(dense: DataFrame, axis: str, radius: int, value: str) -> DataFrame:
    """value averaged along one axis of dense grids over the cells up to radius away, the ends repeated."""
    rest = [c for c in CELL if c != axis]
    lines = dense.groupBy(*rest).agg(F.array_sort(F.collect_list(F.struct(axis, value)))[value].alias("v"))  # a grid's side each
    at = lambda i: F.col("v")[F.least(F.greatest(i, F.lit(0)), F.size("v") - 1)]
    mean = F.transform("v", lambda _, i: sum((at(i + d) for d in range(-radius, radius + 1)), F.lit(0.0)) / (2 * radius + 1))
    return lines.select(*rest, F.posexplode(mean).alias(axis, value)).select(*CELL, value)


def soft_keep(region: DataFrame, blocks: int, feather: float, factor: int = 4, pairs: DataFrame | None = None) -> DataFrame:
    """pair_id, x, y, z, keep for every block of a dense grid: 1 where the block isn't edited, else the mean of that over
    the blocks around it (edges repeat). The grids are those of pairs (pair_id), by default of the pairs that region
    names; a pair that region doesn't name keeps everything.

    The mean over a cube is that of means along each axis: three shuffles of the grid, whatever the radius."""
    edited = keep_blocks(region, factor).select(*CELL).withColumn("_e", F.lit(1))
    every = every_cell(region if pairs is None else pairs, blocks)
    dense = every.join(edited, CELL, "left").select(*CELL, F.when(F.col("_e").isNull(), 1.0).otherwise(0.0).alias("keep"))
    r = max(1, round(feather))
    if feather <= 0:
        return dense
    near = dense
    for a in "xyz":
        near = _line_mean(near, a, r, "keep")
    own = edited.withColumnRenamed("_e", "_own")
    return near.join(own, CELL, "left").select(*CELL, F.when(F.col("_own").isNull(), 1.0).otherwise(F.col("keep")).alias("keep"))


def dense_keep(region: DataFrame, blocks: int, factor: int = 4, pairs: DataFrame | None = None) -> DataFrame:
    """pair_id, x, y, z, keep (1 or 0) for every block."""
    return soft_keep(region, blocks, 0, factor, pairs).withColumn("keep", F.col("keep").cast("int"))


def part_keep(tokens: DataFrame, target: DataFrame, factor: int) -> DataFrame:
    """tokens (cells), target (cells of the parts that are edited) -> pair_id, n_tokens, n_edit_tokens, n_kept: a token is
    kept unless its block holds a target cell."""
    block = [F.floor(F.col(a) / factor).cast("int").alias(f"b{a}") for a in "xyz"]
    hit = downsample(target, factor).select("pair_id", *[F.col(a).alias(f"b{a}") for a in "xyz"]).withColumn("_hit", F.lit(1))
    j = tokens.select("pair_id", *block).join(hit, ["pair_id", "bx", "by", "bz"], "left")
    return j.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count("_hit").alias("n_edit_tokens"), F.count_if(F.col("_hit").isNull()).alias("n_kept"))


def transition(region: DataFrame, preserved: DataFrame, occupied: DataFrame, radius: int, grid: int, exclude: DataFrame | None = None) -> DataFrame:
    """The region and the preserved or occupied cells within so many steps (over faces) of it. Cells of exclude don't count
    as occupied; preserved ones and those of the region stay whatever it names."""
    near = region.select(*CELL).distinct()
    for _ in range(radius):
        near = near.union(_faces(near, grid)).distinct()
    free = occupied.select(*CELL) if exclude is None else occupied.select(*CELL).join(exclude.select(*CELL), CELL, "left_anti")
    solid = preserved.select(*CELL).union(free)
    return near.join(solid, CELL, "left_semi").union(region.select(*CELL)).distinct()


def split_counts(after: DataFrame, region: DataFrame) -> DataFrame:
    """pair_id, n_edit, n_keep, grid: after cells within and outside the region; the grid has 32 cells to a side unless
    some cell lies beyond."""
    j = after.select(*CELL).join(region.select(*CELL).distinct().withColumn("_in", F.lit(1)), CELL, "left")
    return j.groupBy("pair_id").agg(F.count("_in").alias("n_edit"), F.count_if(F.col("_in").isNull()).alias("n_keep"), F.when(F.max(F.greatest("x", "y", "z")) < 32, 32).otherwise(64).alias("grid"))


def added_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells of b that a lacks."""
    return b.select(*CELL).distinct().join(a.select(*CELL), CELL, "left_anti")


def mask_warnings(counts: DataFrame) -> DataFrame:
    """counts (pair_id, n_edit, n_keep, whole: whether the edit is of the whole object) with warning."""
    share = F.col("n_edit") / (F.col("n_edit") + F.col("n_keep"))
    # fixed values: fewest cells, and the share of the object from which a part's edit is suspicious
    return counts.withColumn("warning", F.when(F.col("n_edit") == 0, "no overlap").when(F.col("n_edit") < 10, "few cells").when((share > 0.95) & ~F.col("whole"), "nearly everything"))


#: Cell tables of a sample, by name: coordinates of shape and texture on either side, and those that its region holds.
SAMPLE = ("before_shape", "before_texture", "after_shape", "after_texture", "coords0", "coords_new")


def sample_invariants(cells: DataFrame, masks: DataFrame, mirrors: DataFrame, side: int = 32) -> DataFrame:
    """cells (pair_id, kind: one of SAMPLE, x, y, z), masks (pair_id, side 0/1, n: entries of the keep mask), mirrors
    (pair_id, mirror: the pair that undoes it) -> one row for each pair: same_coords (shape and texture, on both sides),
    before_stored, after_stored (cells equal to the region's), before_mask, after_mask (as many entries as cells), in_grid,
    mirrored (its sides are the other's, swapped; true where it has no mirror).

    Tables are compared as multisets by their number of rows and two order-free sums of hashes: one pass, one row for each
    pair and kind, no join of cells."""
    sums = [F.sum(F.pmod(F.xxhash64("x", "y", "z", F.lit(i)), F.lit(1 << 31))).alias(f"h{i}") for i in range(2)]
    each = cells.groupBy("pair_id", "kind").agg(F.count(F.lit(1)).alias("n"), *sums, F.max(F.greatest("x", "y", "z")).alias("hi"), F.min(F.least("x", "y", "z")).alias("lo"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("h0"), F.lit(0).cast("long").alias("h1"))
    of = [F.coalesce(F.max(F.when(F.col("kind") == k, F.struct("n", "h0", "h1"))), none).alias(k) for k in SAMPLE]
    m = each.groupBy("pair_id").agg(*of, ((F.max("hi") < side) & (F.min("lo") >= 0)).alias("in_grid"))
    n = masks.groupBy("pair_id").agg(*[F.max(F.when(F.col("side") == i, F.col("n"))).alias(f"mask{i}") for i in range(2)])
    other = m.select(F.col("pair_id").alias("mirror"), F.col("before_shape").alias("_before"), F.col("after_shape").alias("_after"), F.lit(True).alias("_there"))
    j = m.join(n, "pair_id", "left").join(mirrors, "pair_id", "left").join(other, "mirror", "left")
    c = F.col
    swapped = c("_there").isNotNull() & (c("before_shape") == c("_after")) & (c("after_shape") == c("_before"))
    return j.select(
        "pair_id", ((c("before_shape") == c("before_texture")) & (c("after_shape") == c("after_texture"))).alias("same_coords"), (c("before_shape") == c("coords0")).alias("before_stored"), (c("after_shape") == c("coords_new")).alias("after_stored"),
        F.coalesce(c("mask0") == c("before_shape.n"), F.lit(False)).alias("before_mask"), F.coalesce(c("mask1") == c("after_shape.n"), F.lit(False)).alias("after_mask"), "in_grid", F.when(c("mirror").isNull(), True).otherwise(F.coalesce(swapped, F.lit(False))).alias("mirrored"))


def rerun_iou(fine: DataFrame, coarse: DataFrame, factor: int = 2) -> DataFrame:
    """pair_id, coords_iou: how a run's cells, made coarser, agree with those that are stored."""
    j = downsample(fine, factor).withColumn("a", F.lit(1)).join(coarse.select(*CELL).distinct().withColumn("b", F.lit(1)), CELL, "full_outer")
    return j.groupBy("pair_id").agg((F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("coords_iou"))


def part_masks(specs: DataFrame, cells: DataFrame, pad: int, grid: int) -> DataFrame:
    """specs (spec_id, pair_id, pids), cells (pair_id, x, y, z, part_id) -> spec_id, cells array<long>: the keys, in order, of
    the cells of a spec's parts, grown by pad along every axis, into those of other parts, too. A spec without parts, or
    whose parts have no cells, has no row.

    A part is grown once, however many specs name it: what grows from a union is the union of what grows. A mask is one
    row, as the grid bounds it."""
    wanted = specs.select("spec_id", "pair_id", F.explode(F.array_distinct("pids")).alias("part_id"))
    own = cells.join(wanted.select("pair_id", "part_id").distinct(), ["pair_id", "part_id"]).select(F.struct("pair_id", "part_id").alias("pair_id"), "x", "y", "z")
    grown = dilate(own, pad, grid).groupBy("pair_id").agg(F.collect_list(cell_key(grid)).alias("keys")).select("pair_id.*", "keys")
    return wanted.join(grown, ["pair_id", "part_id"]).groupBy("spec_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("cells"))


def box_mask(edits: DataFrame) -> DataFrame:
    """edits (edit_id, pids) -> edit_id, x, y, z: a region of two cells that follows from the parts alone, for dry runs."""
    base = F.aggregate("pids", F.lit(0), lambda acc, p: acc + p) % 16
    return edits.select("edit_id", F.explode(F.array(base, base + 1)).alias("x")).select("edit_id", "x", F.col("x").alias("y"), F.col("x").alias("z"))


def normalised(cells: DataFrame, features: list[str]) -> DataFrame:
    """Features less their mean, over their standard deviation, by channel over all cells (0 where that is 0)."""
    stats = cells.agg(*[f(c).alias(f"_{n}_{c}") for c in features for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    out = cells.crossJoin(F.broadcast(stats))  # one row
    scaled = [F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0).alias(c) for c in features]
    return out.select(*[c for c in cells.columns if c not in features], *scaled)
