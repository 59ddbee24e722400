"""Pair metrics over vectors, boxes and sparse grids; checks and their weighted score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stabilising constants of the structural similarity index for values between 0 and 1.
SSIM_C1, SSIM_C2 = 0.01**2, 0.03**2


def sums(a: Column, b: Column) -> Column:
    """n, a, b, aa, bb, ab, dd: the sums over two vectors that similarities are made of, in one pass."""
    d = lambda v: v.cast("double")
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("a", "b", "aa", "bb", "ab", "dd")])

    def add(acc: Column, p: Column) -> Column:
        x, y = d(p["x"]), d(p["y"])
        more = {"a": x, "b": y, "aa": x * x, "bb": y * y, "ab": x * y, "dd": (x - y) * (x - y)}
        return F.struct(*[(acc[n] + v).alias(n) for n, v in more.items()])

    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    return F.aggregate(pairs, zero, add, lambda acc: F.struct(F.size(a).alias("n"), *[acc[n].alias(n) for n in ("a", "b", "aa", "bb", "ab", "dd")]))


def _with(a: Column, b: Column, f: Callable[[Column], Column]) -> Column:
    """f of the sums, which are made once however often f names them."""
    return F.transform(F.array(sums(a, b)), f)[0]


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is about zero."""
    return _with(a, b, lambda s: F.when((F.sqrt(s["aa"]) < 1e-12) | (F.sqrt(s["bb"]) < 1e-12), 0.0).otherwise(s["ab"] / (F.sqrt(s["aa"]) * F.sqrt(s["bb"]))))


def relative_l2(a: Column, b: Column) -> Column:
    """Distance over the length of a; infinite where a is about zero."""
    return _with(a, b, lambda s: F.when(F.sqrt(s["aa"]) < 1e-12, F.lit(float("inf"))).otherwise(F.sqrt(s["dd"]) / F.sqrt(s["aa"])))


def psnr(a: Column, b: Column) -> Column:
    """Peak signal to noise ratio in dB for values between 0 and 1; 100 where they are equal."""
    return _with(a, b, lambda s: F.when(s["dd"] / s["n"] <= 1e-12, 100.0).otherwise(20 * F.log10(1 / F.sqrt(s["dd"] / s["n"]))))


def ssim(a: Column, b: Column) -> Column:
    """Structural similarity of one channel as a whole, between -1 and 1."""

    def of(s: Column) -> Column:
        ma, mb = s["a"] / s["n"], s["b"] / s["n"]
        va, vb, cov = s["aa"] / s["n"] - ma * ma, s["bb"] / s["n"] - mb * mb, s["ab"] / s["n"] - ma * mb
        value = (2 * ma * mb + SSIM_C1) * (2 * cov + SSIM_C2) / ((ma * ma + mb * mb + SSIM_C1) * (va + vb + SSIM_C2))
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))

    return _with(a, b, of)


def vector_pairs(vectors: DataFrame) -> DataFrame:
    """pair_id, before, after: vectors of even id with the one that follows."""
    before = vectors.where("vec_id % 2 = 0").select(F.col("vec_id").alias("pair_id"), F.col("embedding").alias("before"))
    after = vectors.where("vec_id % 2 = 1").select((F.col("vec_id") - 1).alias("pair_id"), F.col("embedding").alias("after"))
    return before.join(after, "pair_id")


def box_iou(cells: DataFrame) -> DataFrame:
    """pair_id, iou of the bounding boxes of the two sides. Extents count as 1 at least in the volumes, not in the
    intersection; a pair without cells on a side has none."""
    sides = {"b": F.col("in_before") == 1, "a": F.col("in_after") == 1}
    ends = [f(F.when(on, F.col(x))).alias(f"{s}_{n}_{x}") for s, on in sides.items() for n, f in (("lo", F.min), ("hi", F.max)) for x in "xyz"]
    c, one, zero = F.col, F.lit(1), F.lit(0)

    def product(of) -> Column:
        return of("x") * of("y") * of("z")

    volume = {s: product(lambda x, s=s: F.greatest(c(f"{s}_hi_{x}") - c(f"{s}_lo_{x}"), one)) for s in sides}
    common = product(lambda x: F.greatest(F.least(c(f"b_hi_{x}"), c(f"a_hi_{x}")) - F.greatest(c(f"b_lo_{x}"), c(f"a_lo_{x}")), zero))
    boxes = cells.groupBy("pair_id").agg(*ends).where("b_lo_x IS NOT NULL AND a_lo_x IS NOT NULL")
    return boxes.select("pair_id", F.round(common / (volume["b"] + volume["a"] - common), 6).alias("iou"))


def layer_one(cells: DataFrame, grid: int = 64) -> DataFrame:
    """Checks of each pair's cells as rows pair_id, name, value, passed, weight."""
    at = F.struct("x", "y", "z")
    valid = F.min((F.least("x", "y", "z") >= 0) & (F.greatest("x", "y", "z") < grid))
    m = cells.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(at).alias("u"), valid.alias("valid"))
    row = lambda name, value, passed, weight: F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), passed.alias("passed"), F.lit(weight).alias("weight"))
    checks = F.array(row("voxel_count", F.col("n"), F.col("n").between(100, 40000), 2.0), row("coords_valid", F.col("valid").cast("int"), F.col("valid"), 3.0), row("coords_unique", F.col("u") / F.col("n"), F.col("u") == F.col("n"), 2.0))
    return m.select("pair_id", F.explode(checks).alias("c")).select("pair_id", "c.*")


def weighted_score(checks: DataFrame) -> DataFrame:
    """pair_id, score (share of the weight that passed, rounded half to even), passed (all of them)."""
    return checks.groupBy("pair_id").agg(F.bround(F.sum(F.col("weight") * F.col("passed").cast("int")) / F.sum("weight"), 4).alias("score"), F.bool_and("passed").alias("passed"))
