"""The cleaning run: checks of one side and of pairs as rows of one long metric table, scores and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.operators.grid import component_counts
from pairloom.operators.judging import tier

_INF = float("inf")
# What a pair of each type is checked for, in order: name, weight, least and greatest value that passes, which
# of the two ends don't pass themselves, and the metric if its name is another one.
CHECKS = {
    "deletion": (("voxel_ratio", 2.0, 0.05, 0.95, ""), ("delete_ratio", 2.0, 0.02, 0.80, ""), ("bbox_iou", 1.5, 0.15, _INF, ""), ("ss_change", 1.0, 0.01, 0.90, ""), ("connected_components", 1.5, -_INF, 3.0, ""), ("not_degenerate", 2.0, 1.0, _INF, "low")),
    "addition": (("voxel_ratio", 2.0, 1.05, 20.0, "", "voxel_increase"), ("add_ratio", 2.0, 0.02, 0.80, ""), ("bbox_iou", 1.5, 0.15, _INF, "")),
    "modification": (("voxel_ratio", 1.5, 0.3, 3.0, ""), ("ss_cosine_sim", 2.0, 0.3, _INF, ""), ("edit_locality", 2.5, 0.02, 0.70, ""), ("connected_components", 1.0, -_INF, 5.0, ""), ("center_drift", 1.5, -_INF, 0.3, "high"), ("feat_change", 1.0, -_INF, 5.0, "high")),
    "scale": (("voxel_ratio", 2.0, 0.5, 2.0, ""), ("ss_cosine_sim", 2.5, 0.5, _INF, ""), ("edit_locality", 2.0, 0.01, 0.50, ""), ("center_drift", 1.5, -_INF, 0.2, "high"), ("bbox_axis_ratio", 1.5, 0.7, 1.8, "")),
    "material": (("voxel_count_close", 2.0, -_INF, 0.01, ""), ("ss_match", 3.0, -_INF, 1e-3, "high"), ("feat_change", 1.5, 0.01, 2.0, "")),
    "global": (("voxel_count_close", 2.0, -_INF, 0.01, ""), ("ss_match", 3.0, -_INF, 1e-3, "high"), ("feat_change", 1.5, 0.01, 2.0, ""), ("change_coverage", 1.5, 0.3, _INF, "")),
    "identity": (("identity_valid", 1.0, 1.0, 1.0, ""),),
}
# Bounds of the checks of one side: cells, features, dense latents, cells to a side of the grid; and the
# change of a row of features from which it counts as changed.
CELLS, FEATURES, DENSE, GRID, CHANGED = (100, 40000), (50.0, 0.01), (100.0, 0.001), 64, 0.01
_CHANNELS = ("f0", "f1", "f2", "f3")


def threshold_table(spark: SparkSession, overrides: dict[str, dict[str, tuple[float, float]]] | None = None) -> DataFrame:
    """edit_type, place, name, metric, weight, low, high, open: CHECKS with other bounds where overrides (type -> metric -> (low,
    high)) name them."""
    rows = []
    for kind, checks in CHECKS.items():
        for place, (name, weight, low, high, end, *metric) in enumerate(checks):
            low, high = (overrides or {}).get(kind, {}).get(name, (low, high))
            row = {"edit_type": kind, "place": place, "name": name, "metric": (metric or [name])[0], "weight": weight, "low": low, "high": high, "open": end}
            rows.append(F.struct(*[F.lit(v).alias(n) for n, v in row.items()]))
    return spark.range(1).select(F.inline(F.array(*rows)))


def feature_change(sides: DataFrame) -> DataFrame:
    """sides (pair_id, side 0/1, x, y, z, f0...) -> pair_id, feat_change, change_coverage.

    Rows of the two sides are compared in their order (here that of x, y, z), not by their cells: the change is the
    length of all differences over that of the first side, infinite where that is about zero, and the coverage the share
    of rows that changed. Sides of unequal numbers of rows are compared by length only, and count as changed throughout.
    """
    length = sum((F.pow(c, F.lit(2)) for c in _CHANNELS), F.lit(0.0))
    at = Window.partitionBy("pair_id", "side").orderBy("x", "y", "z")
    rows = sides.select("pair_id", "side", F.row_number().over(at).alias("n"), length.alias("sq"), *_CHANNELS)
    both = rows.groupBy("pair_id", "n").agg(*[F.max(F.when(F.col("side") == s, F.struct("sq", *_CHANNELS))).alias(n) for s, n in ((0, "b"), (1, "a"))])
    apart = sum((F.pow(F.col(f"b.{c}") - F.col(f"a.{c}"), F.lit(2)) for c in _CHANNELS), F.lit(0.0))
    both = both.select("pair_id", F.col("b.sq").alias("b"), F.col("a.sq").alias("a"), apart.alias("d"))
    m = both.groupBy("pair_id").agg(F.count("b").alias("nb"), F.count("a").alias("na"), F.sqrt(F.coalesce(F.sum("b"), F.lit(0.0))).alias("lb"), F.sqrt(F.coalesce(F.sum("a"), F.lit(0.0))).alias("la"), F.sqrt(F.sum("d")).alias("ld"), F.avg((F.sqrt("d") > CHANGED).cast("int")).alias("moved"))
    same, longest = F.col("nb") == F.col("na"), F.greatest("lb", "la")
    by_length = F.when(longest < 1e-12, 0.0).otherwise(F.abs(F.col("lb") - F.col("la")) / longest)
    change = F.when(same, F.when(F.col("lb") < 1e-12, F.lit(_INF)).otherwise(F.col("ld") / F.col("lb"))).otherwise(by_length)
    return m.select("pair_id", change.alias("feat_change"), F.when(same, F.col("moved")).otherwise(1.0).alias("change_coverage"), same.alias("same_rows"))


def dense_change(latents: DataFrame) -> DataFrame:
    """latents (pair_id, before, after: arrays) -> pair_id, ss_change, ss_cosine_sim, ss_match."""
    from pairloom.operators.metrics import cosine, relative_l2

    most = F.array_max(F.zip_with("before", "after", lambda x, y: F.abs(x.cast("double") - y.cast("double"))))
    return latents.select("pair_id", relative_l2(F.col("before"), F.col("after")).alias("ss_change"), cosine(F.col("before"), F.col("after")).alias("ss_cosine_sim"), most.alias("ss_match"))


def pair_metrics(sides: DataFrame, latents: DataFrame) -> DataFrame:
    """pair_id, metric, value, lowest, highest: every metric that some type is checked for, as rows. lowest and highest are
    held against the bounds: the least of the axis ratios, how far a ratio is from one; else the value itself. Pairs that
    lack a side have no metrics, those without dense latents none of them."""
    on = {"b": F.col("side") == 0, "a": F.col("side") == 1}
    sides = sides.join(sides.groupBy("pair_id").agg(F.countDistinct("side").alias("n")).where("n = 2").select("pair_id"), "pair_id", "left_semi")
    ends = [f(F.when(w, F.col(x))).alias(f"{s}_{n}_{x}") for s, w in on.items() for n, f in (("lo", F.min), ("hi", F.max)) for x in "xyz"]
    at = F.struct("x", "y", "z")
    cell = sides.groupBy("pair_id", "x", "y", "z").agg(F.max(on["b"]).alias("b"), F.max(on["a"]).alias("a")).groupBy("pair_id").agg(F.count_if(F.col("a") != F.col("b")).alias("apart"), F.count(F.lit(1)).alias("all"))
    m = sides.groupBy("pair_id").agg(F.count_if(on["b"]).alias("nb"), F.count_if(on["a"]).alias("na"), *ends).join(cell, "pair_id")
    m = m.join(component_counts(sides.where(on["a"]).select("pair_id", "x", "y", "z").distinct(), GRID).select("pair_id", "n_components"), "pair_id", "left")
    m = m.join(feature_change(sides), "pair_id").join(dense_change(latents), "pair_id", "left")
    c, one = F.col, F.lit(1)
    extent = lambda s, x: c(f"{s}_hi_{x}") - c(f"{s}_lo_{x}")
    times = lambda f: f("x") * f("y") * f("z")
    common = times(lambda x: F.greatest(F.least(c(f"b_hi_{x}"), c(f"a_hi_{x}")) - F.greatest(c(f"b_lo_{x}"), c(f"a_lo_{x}")), F.lit(0)))
    iou = common / (times(lambda x: F.greatest(extent("b", x), one)) + times(lambda x: F.greatest(extent("a", x), one)) - common)
    length = lambda f: F.sqrt(sum((F.pow(f(x), F.lit(2)) for x in "xyz"), F.lit(0.0)))
    drift = length(lambda x: (c(f"a_lo_{x}") + c(f"a_hi_{x}") - c(f"b_lo_{x}") - c(f"b_hi_{x}")) / 2) / F.greatest(length(lambda x: extent("b", x)), F.lit(1e-8))
    axes = [F.greatest(extent("a", x), one) / F.greatest(extent("b", x), one) for x in "xyz"]
    ratio = c("na") / F.greatest("nb", one)
    values = {
        "voxel_ratio": ratio,
        "delete_ratio": 1 - ratio,
        "voxel_increase": c("nb") / F.greatest("na", one),
        "add_ratio": 1 - c("na") / F.greatest("nb", one),
        "bbox_iou": iou,
        "ss_change": c("ss_change"),
        "ss_cosine_sim": c("ss_cosine_sim"),
        "ss_match": c("ss_match"),
        "connected_components": c("n_components"),
        "not_degenerate": F.least(*[extent("a", x) for x in "xyz"]),
        "edit_locality": c("apart") / c("all"),
        "center_drift": drift,
        "feat_change": c("feat_change"),
        "change_coverage": F.when(c("same_rows"), c("change_coverage")),
        "identity_valid": F.lit(1.0),
    }
    def row(metric: str, v: Column, low: Column | None = None, high: Column | None = None) -> Column:
        own = {"value": v, "lowest": v if low is None else low, "highest": v if high is None else high}
        return F.struct(F.lit(metric).alias("metric"), *[x.cast("double").alias(n) for n, x in own.items()])

    off = F.abs(ratio - 1)
    rows = F.array(*[row(k, v) for k, v in values.items()], row("bbox_axis_ratio", F.greatest(*axes), F.least(*axes)), row("voxel_count_close", ratio, off, off))
    return m.select("pair_id", F.explode(rows).alias("r")).select("pair_id", "r.*").where("value is not null")


def check_pairs(edits: DataFrame, metrics: DataFrame, thresholds: DataFrame, color_as: str | None = None) -> DataFrame:
    """edits (pair_id, edit_type) -> pair_id, edit_type, place, name, value, passed, weight. A type without checks fails as
    unknown_type; colour edits are of such a type, unless color_as names the type whose checks they get."""
    kind = F.col("edit_type") if color_as is None else F.when(F.col("edit_type") == "color", F.lit(color_as)).otherwise(F.col("edit_type"))
    e = edits.select("pair_id", "edit_type", kind.alias("kind"))
    few = F.broadcast(thresholds.withColumnRenamed("edit_type", "kind"))  # a row for each type and metric
    of_type = e.join(few, "kind").join(metrics, ["pair_id", "metric"])
    above = F.when(F.col("open") == "low", F.col("lowest") > F.col("low")).otherwise(F.col("lowest") >= F.col("low"))
    below = F.when(F.col("open") == "high", F.col("highest") < F.col("high")).otherwise(F.col("highest") <= F.col("high"))
    known = of_type.select("pair_id", "edit_type", "place", "name", "value", (above & below).alias("passed"), "weight")
    strange = e.where(~F.col("kind").isin(*CHECKS)).select("pair_id", "edit_type", F.lit(0).alias("place"), F.lit("unknown_type").alias("name"), F.lit(0.0).alias("value"), F.lit(False).alias("passed"), F.lit(1.0).alias("weight"))
    return known.union(strange)


def value_range(prefix: str, bounds: tuple[float, float], values: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """(value, passed, weight) of a check that values are finite, not too large and not all alike, in that order, from
    (whether all are finite, the greatest absolute value, the standard deviation)."""
    finite, most, spread = values
    large, small = most > bounds[0], spread < bounds[1]
    return F.when(~finite, 0.0).when(large, most).when(small, spread).otherwise(most), finite & ~large & ~small, F.when(~finite | large, 3.0).otherwise(2.0)


def side_checks(cells: DataFrame, latents: DataFrame) -> DataFrame:
    """cells (pair_id, x, y, z, f0...) of one side, latents (pair_id, dense: array) -> pair_id, place, name, value, passed,
    weight: the checks that each side has to pass by itself. Pairs without a dense latent aren't checked for it."""
    every = F.array(*[F.col(c).cast("double") for c in _CHANNELS])
    sq, total = sum((F.col(c) * F.col(c) for c in _CHANNELS), F.lit(0.0)), sum((F.col(c) for c in _CHANNELS), F.lit(0.0))
    bad = F.exists(every, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(_INF)))
    m = cells.groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct("x", "y", "z")).alias("u"), F.min((F.least("x", "y", "z") >= 0) & (F.greatest("x", "y", "z") < GRID)).alias("valid"),
        (~F.max(bad)).alias("finite"), F.max(F.array_max(F.transform(every, lambda v: F.abs(v)))).alias("most"), F.sum(sq).alias("sq"), F.sum(total).alias("total"))
    k = F.col("n") * len(_CHANNELS)
    spread = F.sqrt(F.greatest(F.col("sq") / k - F.pow(F.col("total") / k, F.lit(2)), F.lit(0.0)))
    dense = F.transform("dense", lambda v: v.cast("double"))
    whole = lambda a, f: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + f(v)) / F.size(a)
    mean = whole(dense, lambda v: v)
    lat = latents.select("pair_id", (~F.exists(dense, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(_INF)))).alias("d_finite"), F.array_max(F.transform(dense, lambda v: F.abs(v))).alias("d_most"), F.sqrt(F.greatest(whole(dense, lambda v: v * v) - mean * mean, F.lit(0.0))).alias("d_spread"))
    m = m.withColumn("spread", spread).join(lat, "pair_id", "left")
    fv, fp, fw = value_range("feat", FEATURES, (F.col("finite"), F.col("most"), F.col("spread")))
    dv, dp, dw = value_range("ss", DENSE, (F.col("d_finite"), F.col("d_most"), F.col("d_spread")))
    row = lambda place, name, v, p, w: F.struct(F.lit(place).alias("place"), F.lit(name).alias("name"), v.cast("double").alias("value"), p.alias("passed"), w.alias("weight"))
    checks = F.array(
        row(0, "voxel_count", F.col("n"), F.col("n").between(*CELLS), F.lit(2.0)), row(1, "feat_range", fv, fp, fw), F.when(F.col("d_finite").isNotNull(), row(2, "ss_range", dv, dp, dw)),
        row(3, "coords_valid", F.col("valid").cast("int"), F.col("valid"), F.lit(3.0)), row(4, "coords_unique", F.col("u") / F.col("n"), F.col("u") == F.col("n"), F.lit(2.0)))
    return m.select("pair_id", F.explode(F.array_compact(checks)).alias("c")).select("pair_id", "c.*")


def score_of(checks: DataFrame, *keys: str) -> DataFrame:
    """keys, score (the share of the weight that passed, half to even), passed, first_failed (by place); see SCO-1: no
    checks have a score of 0 and pass, which is what a left join followed by no_checks() gives."""
    failed = F.min(F.when(~F.col("passed"), F.struct("place", "name")))["name"]
    return checks.groupBy(*keys).agg(F.bround(F.sum(F.col("weight") * F.col("passed").cast("int")) / F.sum("weight"), 4).alias("score"), F.bool_and("passed").alias("passed"), failed.alias("first_failed"))


def clean_edits(edits: DataFrame, first: DataFrame, second: DataFrame, originals: DataFrame) -> DataFrame:
    """edits (pair_id, edit_type) with the checks of their edited sides (first), of the sides they started from
    (originals) and of the pairs (second) -> pair_id, edit_type, score, tier, reason. A side without rows isn't there.

    An identity has no edited side: it scores 1, or 0.5 if its original fails, and passes where there is no original. For
    the others: without an edited side the score is 0; where that side fails it is half the side's score, whether or not
    there is an original; without an original it is 0; these are rejected. Else the score is the mean of both layers, and
    the tier goes by it if both pass. The reason names what is missing or the first check that failed."""
    layer = lambda df, n, *keys: score_of(df, *keys).select(*keys, F.col("score").alias(f"s{n}"), F.col("passed").alias(f"p{n}"), F.col("first_failed").alias(f"f{n}"))
    e = edits.join(layer(first, 1, "pair_id"), "pair_id", "left").join(layer(originals, 0, "pair_id"), "pair_id", "left").join(layer(second, 2, "pair_id", "edit_type"), ["pair_id", "edit_type"], "left")
    s2, p2 = F.coalesce("s2", F.lit(0.0)), F.coalesce("p2", F.lit(True))
    same, mean = F.col("edit_type") == "identity", (F.col("s1") + s2) / 2
    sane = F.coalesce("p0", F.lit(True))
    own = F.when(sane, 1.0).otherwise(0.5)
    gone, unsound, alone = F.col("s1").isNull(), ~F.col("p1"), F.col("s0").isNull()
    score = F.when(same, own).when(gone, 0.0).when(unsound, F.col("s1") * 0.5).when(alone, 0.0).otherwise(F.bround(mean, 4))
    label = F.when(same, tier(own, sane)).when(gone | unsound | alone, "rejected").otherwise(tier(mean, p2))
    reason = F.when(same, F.lit(None)).when(gone, "no edited side").when(unsound, F.concat(F.lit("Layer1 failed: "), "f1")).when(alone, "no original").when(~p2, F.concat(F.lit("Layer2 failed: "), "f2"))
    return e.select("pair_id", "edit_type", score.alias("score"), label.alias("tier"), reason.alias("reason"))


def object_quality(cleaned: DataFrame, *keys: str) -> DataFrame:
    """keys, num_edits, num_passed (high or medium), edits (of an object: a small array), by edit type."""
    good = F.col("tier").isin("high", "medium")
    return cleaned.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_edits"), F.count_if(good).alias("num_passed"), F.sort_array(F.collect_list(F.struct("edit_type", "tier", "score", "reason"))).alias("edits"))
