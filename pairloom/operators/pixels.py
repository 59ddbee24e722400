"""Pixels and dense latents: counts, losses, similarity by channel, benchmark runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.grid import CELL
from pairloom.operators.metrics import SSIM_C1, SSIM_C2


def cluster_sizes(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Rows (faces, pixels) of each key by label."""
    return rows.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))


def palette_pixels(pixels: DataFrame, chosen: DataFrame, key: str, palette: tuple[tuple[int, int, int], ...], near: int = 60, views: int = 5) -> DataFrame:
    """pixels (key, r, g, b), chosen (key, pids, view) -> key, n: pixels within `near` of the palette colour of each chosen
    part (a pixel counts for every part it is near to); -1 where the view is out of range."""
    colours = F.array(*[F.array(*map(F.lit, c)) for c in palette])
    parts = chosen.select(key, "view", F.explode("pids").alias("pid")).withColumn("c", F.element_at(colours, (F.col("pid") % len(palette) + 1).cast("int")))
    apart = F.sqrt(sum((F.pow(F.col(x) - F.col("c")[i], F.lit(2)) for i, x in enumerate("rgb")), F.lit(0.0)))
    n = pixels.join(parts, key).groupBy(key).agg(F.count_if(apart < near).alias("n"), F.first("view").alias("view"))
    return n.select(key, F.when(F.col("view").between(0, views - 1), F.col("n")).otherwise(-1).alias("n"))


def sparse_loss(before: DataFrame, after: DataFrame, region: DataFrame, features: list[str]) -> DataFrame:
    """pair_id, loss: mean absolute difference of features over the cells of both sides outside the region; 0 without any."""
    b = before.select(*CELL, *[F.col(f).alias(f"_{f}") for f in features])
    both = after.select(*CELL, *features).join(b, CELL).join(region.select(*CELL), CELL, "left_anti")
    apart = sum((F.abs(F.col(f) - F.col(f"_{f}")) for f in features), F.lit(0.0)) / len(features)
    loss = both.groupBy("pair_id").agg(F.avg(apart).alias("loss"))
    return before.select("pair_id").distinct().join(loss, "pair_id", "left").na.fill(0.0, ["loss"])


def dense_loss(rows: DataFrame, keep: DataFrame) -> DataFrame:
    """rows (pair_id, cell, b, a: a value for each channel of a cell), keep (cell) -> pair_id, loss: squared differences,
    their mean over a cell's channels, and of that the mean over the cells that are kept."""
    cells = rows.groupBy("pair_id", "cell").agg(F.avg(F.pow(F.col("a") - F.col("b"), F.lit(2))).alias("d"))
    loss = cells.join(keep, "cell", "left_semi").groupBy("pair_id").agg(F.avg("d").alias("loss"))
    return rows.select("pair_id").distinct().join(loss, "pair_id", "left").na.fill(0.0, ["loss"])


def ssim_by_channel(pixels: DataFrame) -> DataFrame:
    """pixels (pair_id, channel, b, a) -> pair_id, ssim: structural similarity of each channel as a whole, their mean,
    between -1 and 1."""
    a, b = F.avg("a"), F.avg("b")
    s = (2 * a * b + SSIM_C1) * (2 * F.covar_pop("a", "b") + SSIM_C2) / ((a * a + b * b + SSIM_C1) * (F.var_pop("a") + F.var_pop("b") + SSIM_C2))
    by = pixels.groupBy("pair_id", "channel").agg(s.alias("s"))
    return by.groupBy("pair_id").agg(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.avg("s"))).alias("ssim"))


def benchmark_run(split: DataFrame, values: DataFrame, version: str, digits: int = 6) -> DataFrame:
    """split (case_id, view, protocol_version), values (case_id, view, value) -> case_id, n, mean, std for each case and for
    all (case_id null). A row of another protocol version is an error."""
    right = F.when(F.col("protocol_version") == version, F.col("case_id")).otherwise(F.raise_error(F.concat(F.lit("protocol version is "), "protocol_version")).cast("long"))
    used = split.select(right.cast("long").alias("case_id"), "view").join(values, ["case_id", "view"])
    return used.rollup("case_id").agg(F.count("value").alias("n"), F.round(F.avg("value"), digits).alias("mean"), F.round(F.stddev_pop("value"), digits).alias("std"))
