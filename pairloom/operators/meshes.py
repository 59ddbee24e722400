"""Meshes as tables of face corners: what is compared of a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.graph import connected_components

_INF = float("inf")
_V = ("vx", "vy", "vz")


def _by_side(name: str, value) -> list:
    """value over each side's rows."""
    return [value(F.col("side") == i).alias(f"{name}{s}") for i, s in ((0, "b"), (1, "a"))]


def pair_metrics(corners: DataFrame, digits: int = 4) -> DataFrame:
    """corners (pair_id, side 0/1, face, k 0..2, vx, vy, vz) -> pair_id, n_before, n_after (different vertices), edit_ratio
    (vertices of one side only, over those of the larger side), area_ratio, volume_ratio (of boxes), box_iou, center_drift
    (over the first side's diagonal), min_extent, and what these are made of: area_b, area_a, extent_b, extent_a.

    Vertices are equal if their coordinates are, rounded."""
    c = F.col
    v = corners.select("pair_id", "side", *[F.round(a, digits).alias(a) for a in _V]).distinct()
    cell = v.groupBy("pair_id", *_V).agg(F.count_if(c("side") == 0).alias("b"), F.count_if(c("side") == 1).alias("a"))
    sets = cell.groupBy("pair_id").agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after"), F.count_if(c("a") != c("b")).alias("apart"))
    tri = corners.groupBy("pair_id", "side", "face").agg(*[F.max(F.when(c("k") == k, c(a))).alias(f"{a}{k}") for k in range(3) for a in _V])
    e1, e2 = ([c(f"{a}{k}") - c(f"{a}0") for a in _V] for k in (1, 2))
    cross = [e1[i] * e2[j] - e1[j] * e2[i] for i, j in ((1, 2), (2, 0), (0, 1))]
    area = F.sqrt(sum((F.pow(x, F.lit(2)) for x in cross), F.lit(0.0))) / 2
    areas = tri.withColumn("area", area).groupBy("pair_id").agg(*_by_side("area_", lambda on: F.sum(F.when(on, c("area")))))
    ends = [x for a in _V for x in (*_by_side(f"lo{a}", lambda on, a=a: F.min(F.when(on, c(a)))), *_by_side(f"hi{a}", lambda on, a=a: F.max(F.when(on, c(a)))))]
    box = corners.groupBy("pair_id").agg(*ends)
    times = lambda f: f(_V[0]) * f(_V[1]) * f(_V[2])
    common = times(lambda a: F.greatest(F.least(c(f"hi{a}b"), c(f"hi{a}a")) - F.greatest(c(f"lo{a}b"), c(f"lo{a}a")), F.lit(0.0)))
    volume = lambda s: times(lambda a: c(f"hi{a}{s}") - c(f"lo{a}{s}"))
    union = volume("b") + volume("a") - common
    drift = F.sqrt(sum((F.pow((c(f"lo{a}a") + c(f"hi{a}a") - c(f"lo{a}b") - c(f"hi{a}b")) / 2, F.lit(2)) for a in _V), F.lit(0.0)))
    diagonal = F.sqrt(sum((F.pow(c(f"hi{a}b") - c(f"lo{a}b"), F.lit(2)) for a in _V), F.lit(0.0)))
    thin = {side: F.least(*[c(f"hi{a}{side}") - c(f"lo{a}{side}") for a in _V]) for side in "ba"}
    j = sets.join(areas, "pair_id").join(box, "pair_id")
    return j.select(
        "pair_id", "n_before", "n_after", (c("apart") / F.greatest("n_before", "n_after")).alias("edit_ratio"), F.when(c("area_b") > 0, c("area_a") / c("area_b")).alias("area_ratio"), F.when(volume("b") > 0, volume("a") / volume("b")).otherwise(0.0).alias("volume_ratio"),
        F.when(union > 1e-12, common / union).otherwise(0.0).alias("box_iou"), (drift / F.greatest(diagonal, F.lit(1e-8))).alias("center_drift"), thin["a"].alias("min_extent"), "area_b", "area_a", thin["b"].alias("extent_b"), thin["a"].alias("extent_a"))


# What a pair of meshes is checked for, in order: name, weight, least and greatest value that passes. The
# ranges of the volume and of the changed share are the user's to set; these are wide.
LIMITS = {
    "volume_ratio": (1.5, 0.05, 20.0), "surface_area_ratio": (1.0, 0.1, 8.0), "edit_ratio": (2.0, 0.001, 1.0), "part_proportion": (1.5, 0.005, 0.80), "connected_components": (1.0, 0.0, 5.0),
    "has_geometry": (2.0, 50.0, _INF), "not_degenerate": (1.0, 1e-4, _INF), "center_drift": (1.0, 0.0, 0.3), "vertex_color": (0.5, 1.0, 1.0), "bbox_overlap": (1.0, 0.1, _INF),
}
# The same for the part that a swap puts in.
SWAP_LIMITS = {"gap_distance": (1.5, 0.0, 0.15), "scale_match": (1.5, 0.0, 3.0)}
# What drift has to stay below, and how much colours have to vary to be more than a filling.
_OPEN, VIVID = ("center_drift",), 1.0


def mesh_components(corners: DataFrame, digits: int = 4) -> DataFrame:
    """corners (pair_id, face, k, vx, vy, vz) of one side -> pair_id, n_components: faces are connected if they share a
    vertex, vertices are equal if their coordinates are, rounded. Vertices go by hashes, so that meshes of any size are
    labelled by the same shuffles as many small ones."""
    vertex = F.xxhash64("pair_id", *[F.round(a, digits) + F.lit(0.0) for a in _V])  # 0.0: of both signs
    v = corners.select("pair_id", "face", "k", vertex.alias("v"))
    edges = v.groupBy("pair_id", "face").agg(F.min_by("v", "k").alias("src"), F.collect_set("v").alias("to")).select("src", F.explode("to").alias("dst"))
    of = connected_components(edges)
    return v.select("pair_id", F.col("v").alias("id")).distinct().join(of, "id").groupBy("pair_id").agg(F.countDistinct("component").alias("n_components"))


def coloured(corners: DataFrame) -> DataFrame:
    """corners (pair_id, side, vx, vy, vz, r, g, b) -> pair_id, colours: whether the vertices of both sides have colours
    that vary; without r, g, b no side has any."""
    if not {"r", "g", "b"} <= set(corners.columns):
        return corners.select("pair_id").distinct().withColumn("colours", F.lit(False))
    v = corners.select("pair_id", "side", *_V, "r", "g", "b").distinct().select("pair_id", "side", F.explode(F.array("r", "g", "b")).alias("c"))
    varies = v.groupBy("pair_id", "side").agg((F.stddev_pop("c") > VIVID).alias("varies"))
    return varies.groupBy("pair_id").agg((F.count_if("varies") == 2).alias("colours"))


def _rows(m: DataFrame, values: dict[str, Column], limits: dict[str, tuple[float, float, float]], first: int = 0) -> DataFrame:
    rows = []
    for i, (name, v) in enumerate(values.items()):
        weight, low, high = limits[name]
        ok = (v >= low) & ((v < high) if name in _OPEN else (v <= high))
        rows.append(F.struct(F.lit(first + i).alias("place"), F.lit(name).alias("name"), F.coalesce(v.cast("double"), F.lit(0.0)).alias("value"), F.coalesce(ok, F.lit(False)).alias("passed"), F.lit(weight).alias("weight")))
    return m.select("pair_id", F.inline(F.array(*rows)))


def mesh_checks(corners: DataFrame, limits: dict[str, tuple[float, float, float]] | None = None, digits: int = 4) -> DataFrame:
    """corners (pair_id, side 0/1, face, k 0..2, vx, vy, vz and, if there are any, r, g, b) -> pair_id, place, name, value,
    passed, weight: the ten metrics of a pair of meshes, for checks.score_of. A metric that has no value (a side is
    missing) fails with 0. limits replace those of LIMITS."""
    c = F.col
    m = pair_metrics(corners, digits).join(mesh_components(corners.where("side = 1"), digits), "pair_id", "left").join(coloured(corners), "pair_id", "left")
    faces = corners.groupBy("pair_id").agg(*_by_side("f", lambda on: F.countDistinct(F.when(on, c("face")))))
    exact = corners.groupBy("pair_id").agg(*_by_side("v", lambda on: F.countDistinct(F.when(on, F.struct(*_V)))))
    m = m.join(faces, "pair_id").join(exact, "pair_id")
    most, thin = F.greatest("fb", "fa"), (limits or {}).get("not_degenerate", LIMITS["not_degenerate"])[1]
    values = {
        "volume_ratio": c("volume_ratio"), "surface_area_ratio": c("area_a") / F.when(c("area_b") > 0, c("area_b")).otherwise(1e-8), "edit_ratio": c("edit_ratio"),
        "part_proportion": F.when(most > 0, F.abs(c("fb") - c("fa")) / most), "connected_components": c("n_components"), "has_geometry": F.least("vb", "va"),
        "not_degenerate": F.when(c("extent_b") < thin, c("extent_b")).when(c("extent_a") < thin, c("extent_a")).otherwise(1.0), "center_drift": c("center_drift"),
        "vertex_color": F.coalesce(c("colours"), F.lit(False)).cast("int"), "bbox_overlap": c("box_iou"),
    }
    return _rows(m, values, LIMITS | (limits or {}))


def swap_checks(vertices: DataFrame, gaps: DataFrame) -> DataFrame:
    """As swap_metrics, as rows that join those of mesh_checks: a swap is scored by all of them at once."""
    m = swap_metrics(vertices, gaps)
    return _rows(m, {"gap_distance": F.col("gap_share"), "scale_match": F.col("scale_match")}, SWAP_LIMITS, len(LIMITS))


def swap_metrics(vertices: DataFrame, gaps: DataFrame, most_scale: float = 3.0, most_gap: float = 0.15) -> DataFrame:
    """vertices (pair_id, side, vx, vy, vz) of the part that was swapped, gaps (pair_id, gap, extent: see
    neighbours.gap_distance) -> pair_id, scale_match (how many times one side's longest extent is the other's; 999 if one has none), scale_ok, gap_share, gap_ok."""
    c = F.col
    ends = [x for a in _V for x in _by_side(a, lambda on, a=a: F.max(F.when(on, c(a))) - F.min(F.when(on, c(a))))]
    size = lambda s: F.greatest(*[c(f"{a}{s}") for a in _V])
    m = vertices.groupBy("pair_id").agg(*ends).select("pair_id", size("b").alias("b"), size("a").alias("a")).join(gaps, "pair_id")
    match = F.when((c("a") > 0) & (c("b") > 0), F.greatest(c("a") / c("b"), c("b") / c("a"))).otherwise(999.0)
    share = c("gap") / F.greatest("extent", F.lit(1e-8))
    return m.select("pair_id", match.alias("scale_match"), (match <= most_scale).alias("scale_ok"), share.alias("gap_share"), (share <= most_gap).alias("gap_ok"))
