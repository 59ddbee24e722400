"""Nearest neighbours by blocks of points, and what is measured with them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import spread, stored

AXES = ("x", "y", "z")


# Points of a block, and nodes of one level of its tree that make one of the next, as powers of two; bits of an
# axis in the order of points; the number of bits that number a partition's rows; blocks that are compared at once.
LEAF, FAN, BITS, ROWS, AT_ONCE = 4, 4, 20, 33, 512


def _between(c: Column) -> Column:
    """The bits of a number, two zeros between each: three of these make a place on a curve that fills space."""
    for by, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        c = c.bitwiseOR(F.shiftleft(c, by)).bitwiseAND(F.lit(mask))
    return c


def _numbered(points: DataFrame, keys: tuple[str, ...], lo: float, extent: float) -> DataFrame:
    """points with _id, stored: numbers near each other are places near each other, and 2 ** ROWS numbers a partition's own."""
    step = lambda a: ((F.col(a) - F.lit(lo)) / F.lit(extent or 1.0) * F.lit(2.0**BITS - 1)).cast("long")
    curve = reduce(Column.bitwiseOR, [F.shiftleft(_between(step(a)), i) for i, a in enumerate(AXES)])
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * points.sparkSession.sparkContext.defaultParallelism)
    ordered = points.withColumn("_at", curve).repartitionByRange(tasks, *keys, "_at").sortWithinPartitions(*keys, "_at", *AXES)
    return stored(ordered.drop("_at").withColumn("_id", F.monotonically_increasing_id()))


def _boxes(points: DataFrame, keys: tuple[str, ...], name: str, bits: int, **more: Column) -> DataFrame:
    """keys, name (a block of 2 ** bits numbers), its box and what else is asked of it."""
    ends = [f(a).alias(f"{name}{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in AXES]
    return points.groupBy(*keys, F.shiftright("_id", bits).alias(name)).agg(*ends, *[c.alias(n) for n, c in more.items()])


def _bounds() -> tuple[Column, Column]:
    """Squares of the least and of the greatest distance between the points of two boxes."""
    least = {a: F.greatest(F.lit(0.0), F.col(f"slo{a}") - F.col(f"qhi{a}"), F.col(f"qlo{a}") - F.col(f"shi{a}")) for a in AXES}
    most = {a: F.greatest(F.col(f"shi{a}") - F.col(f"qlo{a}"), F.col(f"qhi{a}") - F.col(f"slo{a}")) for a in AXES}
    return sum((v * v for v in least.values()), F.lit(0.0)), sum((v * v for v in most.values()), F.lit(0.0))


_PLACE = {"x": "double", "y": "double", "z": "double", "nth": "int", "_id": "long"}


def _folded(k: int):
    """For mapInArrow over rows of equal head, first a block of queries (kind 0), then blocks of sources: the numbers of the
    k nearest for each query. The best so far are kept, so that any number of blocks can follow."""

    def nearer(points: list, best: list | None, given: list) -> list:
        order = np.lexsort(given[3::-1])
        x, y, z, nth, number = (v[order] for v in given)
        dx, dy, dz = (a[:, None] - b[None, :] for a, b in zip(points, (x, y, z), strict=False))
        d2 = dx * dx + dy * dy + dz * dz
        first = d2.argmin(1)[:, None] if k == 1 else np.argsort(d2, axis=1, kind="stable")[:, :k]
        new = [np.take_along_axis(d2, first, 1), x[first], y[first], z[first], nth[first], number[first]]
        if best is None:
            return new
        both = [np.concatenate(v, axis=1) for v in zip(best, new, strict=True)]
        order = np.lexsort(both[4::-1], axis=1)[:, :k]
        return [np.take_along_axis(v, order, 1) for v in both]

    def batch(points: list, best: list) -> pa.RecordBatch:
        n, m = best[0].shape
        values = [np.repeat(points[4], m), best[5].ravel(), best[0].ravel(), np.tile(np.arange(1, m + 1, dtype=np.int32), n)]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["_id", "_s", "d2", "rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = points = best = None
        for b in batches:
            heads, kinds = (b.column(c).to_numpy(zero_copy_only=False) for c in ("head", "kind"))
            i = 0
            while i < len(heads):
                if kinds[i] == 0:
                    if best is not None:
                        yield batch(points, best)
                    head, best, j = heads[i], None, i + 1
                    points = [b.column(c).slice(i, 1).flatten().to_numpy(zero_copy_only=False) for c in _PLACE]
                else:
                    j = min(i + int(np.searchsorted(heads[i:], head, "right")), i + AT_ONCE)
                    best = nearer(points, best, [b.column(c).slice(i, j - i).flatten().to_numpy(zero_copy_only=False) for c in _PLACE])
                i = j
        if best is not None:
            yield batch(points, best)

    return run


def nearest(queries: DataFrame, sources: DataFrame, k: int = 1, side: float = 4.0, keys: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """queries (keys, x, y, z), sources (keys, x, y, z, ...) -> keys, x, y, z, s (struct: the source's columns, its place
    first), d2, rank: the k nearest sources of the same keys for each query, exactly; ties go to the lowest place.

    Points are sorted along a curve that fills space, and each 16 of them are a block with a box, however dense they are;
    each 16 blocks make a node above. A block of queries goes down the tree of sources and leaves out the nodes that are
    farther from its box than k sources are for certain, so that in the end it meets the few blocks around it. Of sources at
    one place the k first are kept. Fewer than k sources: all of them. Queries whose keys have no sources, and places that
    aren't finite, give no rows. side: not needed (the blocks find their own), kept for those who give it.
    """
    rest = [c for c in sources.columns if c not in (*keys, *AXES)]
    finite = reduce(Column.__and__, [F.abs(F.col(a).cast("double")) < float("inf") for a in AXES])
    todo = queries.select(*keys, *AXES).where(finite).distinct()
    s = sources.where(finite).select(*keys, *AXES, F.struct(*AXES, *rest).alias("s"))
    if k == 1:
        s = s.groupBy(*keys, *AXES).agg(F.min("s").alias("s")).withColumn("_nth", F.lit(1))
    else:
        s = s.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, *AXES).orderBy("s"))).where(F.col("_nth") <= k)
    ends = s.select(*AXES).union(todo.select(*AXES)).agg(F.max(F.greatest(*AXES)).cast("double").alias("hi"), F.min(F.least(*AXES)).cast("double").alias("lo")).first()
    lo, hi = (ends["lo"] or 0.0), (ends["hi"] or 0.0)
    q, s = (_numbered(df, keys, lo, hi - lo) for df in (todo, s))
    most = s.groupBy(F.shiftright("_id", ROWS).alias("p")).count().agg(F.max("count")).first()[0] or 0
    levels = [LEAF]
    while 2 ** (levels[-1] + FAN) < most:
        levels.append(levels[-1] + FAN)
    least, greatest = _bounds()
    at = _boxes(q, keys, "q", LEAF, head=F.min("_id")).drop("q")
    for bits, above in zip([ROWS, *reversed(levels)], [None, ROWS, *reversed(levels[1:])], strict=True):
        boxes = _boxes(s, keys, "s", bits, n=F.count(F.lit(1)))
        if above is None:
            met = at.join(boxes, list(keys))
        else:
            under = boxes.withColumn("_above", F.shiftright("s", above - bits))
            met = at.withColumn("_above", F.explode("every")).drop("every").join(under, [*keys, "_above"]).drop("_above")
        own = [*keys, "head", *[f"q{n}{a}" for n in ("lo", "hi") for a in AXES]]
        found = met.select(*own, F.struct("s", least.alias("least")).alias("m"), F.when(F.col("n") >= k, greatest).otherwise(float("inf")).alias("sure"))
        found = found.groupBy(*own).agg(F.collect_list("m").alias("m"), F.min("sure").alias("sure"))
        near = F.filter("m", lambda m: m["least"] * F.lit(1 - 1e-12) <= F.col("sure"))
        at = found.select(*own, F.transform(near, lambda m: m["s"]).alias("every"))
        at = stored(at) if above is not None else at
    places = [F.col(f"of.{f}").cast(f"array<{kind}>").alias(f) for f, kind in _PLACE.items()]
    place = lambda df, *by: df.groupBy(*by).agg(F.collect_list(F.struct(*_PLACE)).alias("of"))
    blocks = place(s.withColumn("nth", F.col("_nth")), *keys, F.shiftright("_id", LEAF).alias("_block")).select(*keys, "_block", *places)
    met = at.select(*keys, "head", F.explode("every").alias("_block")).join(blocks, [*keys, "_block"]).select("head", F.lit(1).alias("kind"), *_PLACE)
    points = place(q.withColumn("nth", F.lit(1)), *keys, F.shiftright("_id", LEAF).alias("q")).select(F.array_min("of._id").alias("head"), F.lit(0).alias("kind"), *places)
    dealt = spread(points.join(met.select("head").distinct(), "head", "left_semi").unionByName(met), "head").sortWithinPartitions("head", "kind")
    found = dealt.mapInArrow(_folded(k), "_id long, _s long, d2 double, rank int")
    of = s.select(F.col("_id").alias("_s"), "s")
    return found.join(q, "_id").join(of, "_s").select(*keys, *AXES, "s", "d2", "rank")


def surface_distances(pred: DataFrame, truth: DataFrame, key: str, tau: float, side: float) -> DataFrame:
    """Points with normals (key, x, y, z, nx, ny, nz) of two surfaces -> key, chamfer (mean of both mean distances, times
    1000), normals (mean of |cosine|), precision and recall (per cent within tau), fscore."""

    def one_way(a: DataFrame, b: DataFrame) -> DataFrame:
        n = nearest(a, b, 1, side, (key,)).join(a, [key, *AXES])
        dot = F.abs(sum((F.col(c) * F.col(f"s.{c}") for c in ("nx", "ny", "nz")), F.lit(0.0)))
        return n.groupBy(key).agg(F.avg(F.sqrt("d2")).alias("d"), F.avg(dot).alias("n"), (F.avg((F.sqrt("d2") <= tau).cast("int")) * 100).alias("within"))

    there = one_way(pred, truth).select(key, F.col("d").alias("d1"), F.col("n").alias("n1"), F.col("within").alias("precision"))
    back = one_way(truth, pred).select(key, F.col("d").alias("d2"), F.col("n").alias("n2"), F.col("within").alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return there.join(back, key).select(key, ((F.col("d1") + F.col("d2")) / 2 * 1000).alias("chamfer"), ((F.col("n1") + F.col("n2")) / 2).alias("normals"), p, r, (2 * p * r / F.greatest(p + r, F.lit(1e-8))).alias("fscore"))


def gap_distance(part: DataFrame, body: DataFrame, key: str, side: float) -> DataFrame:
    """key, gap: the distance within which a tenth of the part's points have the body."""
    of = part.groupBy(key, *AXES).agg(F.count(F.lit(1)).alias("_n"))
    n = nearest(part, body, 1, side, (key,)).join(of, [key, *AXES])
    return n.groupBy(key).agg(F.percentile(F.sqrt("d2"), F.lit(0.1), F.col("_n")).alias("gap"))


def contact_centroid(part: DataFrame, body: DataFrame, key: str, side: float, least: float = 0.02, share: float = 0.05, few: int = 10) -> DataFrame:
    """key, x, y, z: the mean of the part's points that are near the body: within `share` of the part's extent (`least` at
    least), or, where fewer than `few` are, the nearest tenth (`few` at least)."""
    n = nearest(part, body, 1, side, (key,)).join(part.select(key, *AXES), [key, *AXES])
    by = Window.partitionBy(key)
    extent = F.greatest(*[F.max(a).over(by) - F.min(a).over(by) for a in AXES])
    near = F.sqrt("d2") < F.greatest(F.lit(least), extent * share)
    n = n.select(key, *AXES, "d2", near.alias("near"), F.count(F.lit(1)).over(by).alias("n"), F.row_number().over(by.orderBy("d2", *AXES)).alias("place"))
    n = n.withColumn("n_near", F.count_if("near").over(by))
    used = F.when(F.col("n_near") >= few, F.col("near")).otherwise(F.col("place") <= F.greatest(F.lit(few), F.floor(F.col("n") / 10)))
    return n.where(used).groupBy(key).agg(*[F.avg(a).alias(a) for a in AXES])


def transferred_labels(targets: DataFrame, sources: DataFrame, key: str, side: float) -> DataFrame:
    """targets (key, x, y, z), sources (key, x, y, z, label) -> key, x, y, z, label of the nearest source, once the sources'
    box is stretched onto the targets' box."""
    ends = lambda df, p: df.groupBy(key).agg(*[f(a).alias(f"{p}{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in AXES])
    s = sources.join(ends(sources, "s"), key).join(ends(targets, "t"), key)
    scale = lambda a: F.when(F.col(f"shi{a}") > F.col(f"slo{a}"), (F.col(f"thi{a}") - F.col(f"tlo{a}")) / (F.col(f"shi{a}") - F.col(f"slo{a}"))).otherwise(1.0)
    moved = s.select(key, *[((F.col(a) - F.col(f"slo{a}")) * scale(a) + F.col(f"tlo{a}")).alias(a) for a in AXES], "label")
    return nearest(targets, moved, 1, side, (key,)).join(targets.select(key, *AXES), [key, *AXES]).select(key, *AXES, F.col("s.label").alias("label"))


def without_labels(labelled: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """labelled (key, label), chosen (key, pids) -> key, n_kept, n_dropped, verdict: 'reject' where nothing is left, 'warn'
    where nothing goes."""
    gone = F.array_contains("pids", F.col("label"))
    n = labelled.join(chosen, key).groupBy(key).agg(F.count_if(~gone).alias("n_kept"), F.count_if(gone).alias("n_dropped"))
    return n.withColumn("verdict", F.when(F.col("n_kept") == 0, "reject").when(F.col("n_dropped") == 0, "warn").otherwise("ok"))


def aligned_labels(cells: DataFrame) -> DataFrame:
    """cells (pair_id, x, y, z, edit: boolean or null) -> with edit filled in: a cell without a label takes that of the
    nearest cell with one."""
    known = cells.where("edit is not null")
    rest = nearest(cells.where("edit is null"), known, 1).select("pair_id", *AXES, F.col("s.edit").alias("edit"))
    return known.select("pair_id", *AXES, "edit").union(rest)


def voted_region(occupied: DataFrame, edit: DataFrame, preserved: DataFrame, pad: int, k: int, grid: int) -> DataFrame:
    """Cells of the region that is edited: the edit cells, and empty cells around the object (its box and pad) of whose k
    nearest occupied cells more than half are edit cells; without preserved cells."""
    cell = ["pair_id", *AXES]
    ends = occupied.groupBy("pair_id").agg(*[f(a).alias(f"{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in AXES])
    box = ends
    for a in AXES:
        box = box.withColumn(a, F.explode(F.sequence(F.greatest(F.col(f"lo{a}") - pad, F.lit(0)), F.least(F.col(f"hi{a}") + pad, F.lit(grid - 1)))))
    empty = box.select(*cell).join(edit.select(*cell).union(preserved.select(*cell)).distinct(), cell, "left_anti")
    marked = occupied.select(*cell).distinct().join(edit.select(*cell).distinct().withColumn("is_edit", F.lit(1)), cell, "left").na.fill(0, ["is_edit"])
    votes = nearest(empty, marked, k, 2.0).groupBy(*cell).agg(F.avg("s.is_edit").alias("share")).where("share > 0.5")
    return votes.select(*cell).union(edit.select(*cell)).distinct().join(preserved.select(*cell), cell, "left_anti")
