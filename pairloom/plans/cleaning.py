"""Queries over the cleaning run: changes, checks, scores and tiers of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import checks, metrics
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored, table

_TYPES = ("deletion", "addition", "modification", "scale", "material", "color", "global", "identity")


def _sides(sql: str) -> str:
    return with_fixtures(sql, "fx_sides")


def _latents(s, d) -> DataFrame:
    return metrics.vector_pairs(table(s, d, "embeddings")).withColumn("pair_id", F.floor(F.col("pair_id") / 2).cast("long"))


def _edits(sides: DataFrame) -> DataFrame:
    """Every pair as an edit of every type."""
    return sides.select("pair_id").distinct().select("pair_id", F.explode(F.array(*map(F.lit, _TYPES))).alias("edit_type"))


_ROWS = "r AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY x, y, z) AS n FROM fx_sides)"
_CHANGE = """m AS (SELECT coalesce(b.pair_id, a.pair_id) AS pair_id, count(b.n) AS nb, count(a.n) AS na, sqrt(coalesce(sum(b.f0 * b.f0 + b.f1 * b.f1 + b.f2 * b.f2 + b.f3 * b.f3), 0)) AS lb, sqrt(coalesce(sum(a.f0 * a.f0 + a.f1 * a.f1 + a.f2 * a.f2 + a.f3 * a.f3), 0)) AS la,
 sum(pow(a.f0 - b.f0, 2) + pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2) + pow(a.f3 - b.f3, 2)) AS d, avg((sqrt(pow(a.f0 - b.f0, 2) + pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2) + pow(a.f3 - b.f3, 2)) > 0.01)::INT) AS moved
 FROM (SELECT * FROM r WHERE side = 0) b FULL JOIN (SELECT * FROM r WHERE side = 1) a ON a.pair_id = b.pair_id AND a.n = b.n GROUP BY ALL),
 change AS (SELECT pair_id, CASE WHEN nb = na THEN sqrt(d) / lb ELSE abs(lb - la) / greatest(lb, la) END AS feat_change, CASE WHEN nb = na THEN moved ELSE 1 END AS change_coverage, nb = na AS same_rows FROM m)"""


@query("met6_7_feature_change", _sides(f"WITH {_ROWS}, {_CHANGE} SELECT pair_id, round(feat_change, 6) AS feat_change, round(change_coverage, 6) AS change_coverage FROM change"))
def met6(s, d):
    return checks.feature_change(fixture(s, d, "fx_sides")).select("pair_id", F.round("feat_change", 6).alias("feat_change"), F.round("change_coverage", 6).alias("change_coverage"))


_LAT = """lat AS (SELECT b.vec_id // 2 AS pair_id, list_transform(b.embedding, lambda v: v::DOUBLE) AS b, list_transform(a.embedding, lambda v: v::DOUBLE) AS a FROM embeddings b JOIN embeddings a ON a.vec_id = b.vec_id + 1 WHERE b.vec_id % 2 = 0),
 lv AS (SELECT pair_id, unnest(b) AS b, unnest(a) AS a FROM lat), dense AS (SELECT pair_id, sqrt(sum((a - b) * (a - b))) / sqrt(sum(b * b)) AS ss_change, sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) AS ss_cosine_sim, max(abs(a - b)) AS ss_match, max(abs(a)) AS a_most, stddev_pop(a) AS a_spread, max(abs(b)) AS b_most, stddev_pop(b) AS b_spread FROM lv GROUP BY pair_id)"""


def _side_sql(side: int, to: str, lat: str) -> str:
    """The checks of one side as table `to`; lat: what its dense latents' columns start with."""
    v, vs, cs = (f"{n}{side}" for n in ("v", "vs", "cs"))
    return f"""{v} AS (SELECT pair_id, x, y, z, unnest([f0, f1, f2, f3]) AS f FROM fx_sides WHERE side = {side}), {vs} AS (SELECT pair_id, max(abs(f)) AS most, stddev_pop(f) AS spread FROM {v} GROUP BY pair_id),
 {cs} AS (SELECT pair_id, count(*) AS n, count(DISTINCT (x, y, z)) AS u, bool_and(least(x, y, z) >= 0 AND greatest(x, y, z) < 64) AS valid FROM fx_sides WHERE side = {side} GROUP BY pair_id),
 {to} AS (SELECT pair_id, 0 AS place, 'voxel_count' AS name, n::DOUBLE AS value, n BETWEEN 100 AND 40000 AS passed, 2.0::DOUBLE AS weight FROM {cs}
 UNION ALL SELECT pair_id, 1, 'feat_range', CASE WHEN most > 50 THEN most WHEN spread < 0.01 THEN spread ELSE most END, most <= 50 AND spread >= 0.01, CASE WHEN most > 50 THEN 3 ELSE 2 END FROM {vs}
 UNION ALL SELECT pair_id, 2, 'ss_range', CASE WHEN {lat}_most > 100 THEN {lat}_most WHEN {lat}_spread < 0.001 THEN {lat}_spread ELSE {lat}_most END, {lat}_most <= 100 AND {lat}_spread >= 0.001, CASE WHEN {lat}_most > 100 THEN 3 ELSE 2 END FROM dense WHERE pair_id IN (SELECT pair_id FROM {cs})
 UNION ALL SELECT pair_id, 3, 'coords_valid', valid::INT, valid, 3 FROM {cs} UNION ALL SELECT pair_id, 4, 'coords_unique', u / n, u = n, 2 FROM {cs})"""


_SIDE, _ORIGINAL = _side_sql(1, "first", "a"), ", " + _side_sql(0, "original", "b")


def _stored(s, d) -> DataFrame:
    """Both layers of checks start from the sides: they are made once."""
    return stored(fixture(s, d, "fx_sides"))


def _side(s, d, sides: DataFrame, side: int) -> DataFrame:
    return checks.side_checks(sides.where(F.col("side") == side), _latents(s, d).select("pair_id", F.col("before" if side == 0 else "after").alias("dense")))


@query("chk1_5_side_checks", _sides(f"WITH {_LAT}, {_SIDE} SELECT pair_id, place, name, round(value, 6) AS value, passed, weight FROM first"))
def chk1(s, d):
    return _side(s, d, fixture(s, d, "fx_sides"), 1).withColumn("value", F.round("value", 6))


_ENDS = ", ".join(f"{f}({x}) FILTER (side = {w}) AS {n}_{e}_{x}" for w, n in ((0, "b"), (1, "a")) for e, f in (("lo", "min"), ("hi", "max")) for x in "xyz")
_PRODUCT = lambda f: " * ".join(f(x) for x in "xyz")
_INTER = _PRODUCT(lambda x: f"greatest(least(b_hi_{x}, a_hi_{x}) - greatest(b_lo_{x}, a_lo_{x}), 0)")
_VOLUMES = " + ".join(_PRODUCT(lambda x, s=s: f"greatest({s}_hi_{x} - {s}_lo_{x}, 1)") for s in "ba")
_AXES = [f"greatest(a_hi_{x} - a_lo_{x}, 1) / greatest(b_hi_{x} - b_lo_{x}, 1)" for x in "xyz"]
_DRIFT = "sqrt(" + " + ".join(f"pow((a_lo_{x} + a_hi_{x} - b_lo_{x} - b_hi_{x}) / 2, 2)" for x in "xyz") + ") / greatest(sqrt(" + " + ".join(f"pow(b_hi_{x} - b_lo_{x}, 2)" for x in "xyz") + "), 1e-8)"
#: Each check of each type, as its type, place, name, value, condition and weight.
_SQL_CHECKS = (
    ("deletion", "voxel_ratio", "ratio", "ratio BETWEEN 0.05 AND 0.95", 2), ("deletion", "delete_ratio", "1 - ratio", "1 - ratio BETWEEN 0.02 AND 0.8", 2), ("deletion", "bbox_iou", "iou", "iou >= 0.15", 1.5), ("deletion", "ss_change", "ss_change", "ss_change BETWEEN 0.01 AND 0.9", 1),
    ("deletion", "connected_components", "comp", "comp <= 3", 1.5), ("deletion", "not_degenerate", "ext", "ext > 1", 2),
    ("addition", "voxel_ratio", "nb / na", "nb / na BETWEEN 1.05 AND 20", 2), ("addition", "add_ratio", "1 - na / nb", "1 - na / nb BETWEEN 0.02 AND 0.8", 2), ("addition", "bbox_iou", "iou", "iou >= 0.15", 1.5),
    ("modification", "voxel_ratio", "ratio", "ratio BETWEEN 0.3 AND 3", 1.5), ("modification", "ss_cosine_sim", "ss_cosine_sim", "ss_cosine_sim >= 0.3", 2), ("modification", "edit_locality", "loc", "loc BETWEEN 0.02 AND 0.7", 2.5), ("modification", "connected_components", "comp", "comp <= 5", 1),
    ("modification", "center_drift", "drift", "drift < 0.3", 1.5), ("modification", "feat_change", "feat_change", "feat_change < 5", 1),
    ("scale", "voxel_ratio", "ratio", "ratio BETWEEN 0.5 AND 2", 2), ("scale", "ss_cosine_sim", "ss_cosine_sim", "ss_cosine_sim >= 0.5", 2.5), ("scale", "edit_locality", "loc", "loc BETWEEN 0.01 AND 0.5", 2), ("scale", "center_drift", "drift", "drift < 0.2", 1.5), ("scale", "bbox_axis_ratio", "axis_most", "axis_least >= 0.7 AND axis_most <= 1.8", 1.5),
    *((t, *c) for t in ("material", "global") for c in (("voxel_count_close", "ratio", "abs(ratio - 1) <= 0.01", 2), ("ss_match", "ss_match", "ss_match < 0.001", 3), ("feat_change", "feat_change", "feat_change BETWEEN 0.01 AND 2", 1.5))),
    ("global", "change_coverage", "CASE WHEN same_rows THEN change_coverage END", "change_coverage >= 0.3", 1.5), ("identity", "identity_valid", "1", "true", 1), ("color", "unknown_type", "0", "false", 1),
)
_PLACES = [sum(x[0] == c[0] for x in _SQL_CHECKS[:i]) for i, c in enumerate(_SQL_CHECKS)]
_SECOND = f"""ends AS (SELECT pair_id, count_if(side = 0) AS nb, count_if(side = 1) AS na, {_ENDS} FROM fx_sides GROUP BY pair_id),
 cells AS (SELECT pair_id, x, y, z, count_if(side = 0) AS b, count_if(side = 1) AS a FROM fx_sides GROUP BY ALL), locs AS (SELECT pair_id, count_if(a <> b) / count(*) AS loc FROM cells GROUP BY pair_id),
 k AS (SELECT DISTINCT pair_id, x * 4096 + y * 64 + z AS id, x, y, z FROM fx_sides WHERE side = 1),
 e AS (SELECT a.pair_id, a.id AS i, b.id AS j FROM k a JOIN (VALUES (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) o(p, q, r) ON true JOIN k b ON a.pair_id = b.pair_id AND b.x = a.x + p AND b.y = a.y + q AND b.z = a.z + r),
 reach AS (SELECT pair_id, i, j FROM e UNION SELECT t.pair_id, t.i, e.j FROM reach t JOIN e ON t.pair_id = e.pair_id AND t.j = e.i),
 comps AS (SELECT pair_id, count(DISTINCT c) AS comp FROM (SELECT pair_id, i, min(j) AS c FROM reach GROUP BY ALL) GROUP BY pair_id),
 w AS (SELECT *, na / nb AS ratio, ({_INTER}) / ({_VOLUMES} - {_INTER}) AS iou, least(a_hi_x - a_lo_x, a_hi_y - a_lo_y, a_hi_z - a_lo_z) AS ext, {_DRIFT} AS drift, greatest({", ".join(_AXES)}) AS axis_most, least({", ".join(_AXES)}) AS axis_least
  FROM ends JOIN locs USING (pair_id) LEFT JOIN comps USING (pair_id) LEFT JOIN dense USING (pair_id) JOIN change USING (pair_id) WHERE nb > 0 AND na > 0),
 second AS ({" UNION ALL ".join(f"SELECT pair_id, '{t}' AS edit_type, {p} AS place, '{n}' AS name, ({v})::DOUBLE AS value, ({c}) AS passed, {g}::DOUBLE AS weight FROM w WHERE ({v}) IS NOT NULL" for p, (t, n, v, c, g) in zip(_PLACES, _SQL_CHECKS, strict=True))})"""
_ALL = f"WITH RECURSIVE {_LAT}, {_SIDE}, {_ROWS}, {_CHANGE}, {_SECOND} "


def _second(s, d, sides: DataFrame) -> DataFrame:
    latents = _latents(s, d).join(sides.select("pair_id").distinct(), "pair_id", "left_semi")
    return checks.check_pairs(_edits(sides), stored(checks.pair_metrics(sides, latents)), checks.threshold_table(s))


@query("chk6_12_pair_checks", _sides(_ALL + "SELECT pair_id, edit_type, place, name, round(value, 6) AS value, passed, weight FROM second"))
def chk6(s, d):
    return _second(s, d, _stored(s, d)).withColumn("value", F.round("value", 6))


_TIER = "CASE WHEN NOT {p} THEN 'negative' WHEN {s} >= 0.8 THEN 'high' WHEN {s} >= 0.6 THEN 'medium' WHEN {s} >= 0.4 THEN 'low' ELSE 'negative' END"


_CLEAN = (
    _ALL
    + _ORIGINAL
    + """, s0 AS (SELECT pair_id, round_even(sum(weight) FILTER (passed) / sum(weight), 4) AS s0, bool_and(passed) AS p0 FROM original GROUP BY pair_id), s1 AS (SELECT pair_id, round_even(sum(weight) FILTER (passed) / sum(weight), 4) AS s1, bool_and(passed) AS p1, arg_min(name, place) FILTER (NOT passed) AS f1 FROM first GROUP BY pair_id),
 s2 AS (SELECT pair_id, edit_type, round_even(coalesce(sum(weight) FILTER (passed), 0) / sum(weight), 4) AS s2, bool_and(passed) AS p2, arg_min(name, place) FILTER (NOT passed) AS f2 FROM second GROUP BY pair_id, edit_type),
 ed AS (SELECT DISTINCT pair_id, t.edit_type FROM fx_sides, (VALUES """
    + ", ".join(f"('{t}')" for t in _TYPES)
    + f""") t(edit_type)),
 clean AS (SELECT pair_id, edit_type, CASE WHEN edit_type = 'identity' THEN CASE WHEN coalesce(p0, true) THEN 1 ELSE 0.5 END WHEN s1 IS NULL THEN 0 WHEN NOT p1 THEN s1 * 0.5 WHEN s0 IS NULL THEN 0 ELSE round_even((s1 + s2) / 2, 4) END::DOUBLE AS score,
 CASE WHEN edit_type = 'identity' THEN CASE WHEN coalesce(p0, true) THEN 'high' ELSE 'negative' END WHEN s1 IS NULL OR NOT p1 OR s0 IS NULL THEN 'rejected' ELSE {_TIER.format(p="p2", s="((s1 + s2) / 2)")} END AS tier,
 CASE WHEN edit_type = 'identity' THEN NULL WHEN s1 IS NULL THEN 'no edited side' WHEN NOT p1 THEN 'Layer1 failed: ' || f1 WHEN s0 IS NULL THEN 'no original' WHEN NOT p2 THEN 'Layer2 failed: ' || f2 END AS reason
 FROM ed LEFT JOIN s1 USING (pair_id) LEFT JOIN s0 USING (pair_id) LEFT JOIN s2 USING (pair_id, edit_type)) """
)


def _cleaned(s, d) -> DataFrame:
    sides = stored(fixture(s, d, "fx_uneven"))
    return checks.clean_edits(_edits(sides), _side(s, d, sides, 1), _second(s, d, sides), _side(s, d, sides, 0))


def _uneven(sql: str) -> str:
    return with_fixtures(sql.replace("fx_sides", "fx_uneven"), "fx_uneven")


@query("sco3_clean_edits", _uneven(_CLEAN + "SELECT * FROM clean"))
def sco3(s, d):
    return _cleaned(s, d)


@query("sco4_object_quality", _uneven(_CLEAN + "SELECT pair_id % 10 AS shard, pair_id, count(*) AS num_edits, count_if(tier IN ('high', 'medium')) AS num_passed, string_agg(edit_type || '=' || tier, ',' ORDER BY edit_type) AS tiers FROM clean GROUP BY pair_id"))
def sco4(s, d):
    done = checks.object_quality(_cleaned(s, d).withColumn("shard", F.col("pair_id") % 10), "shard", "pair_id")
    tiers = F.array_join(F.transform("edits", lambda e: F.concat(e["edit_type"], F.lit("="), e["tier"])), ",")
    return done.select("shard", "pair_id", "num_edits", "num_passed", tiers.alias("tiers"))


@query("agg5_fail_reasons", _uneven(_CLEAN + "SELECT reason[1:80] AS reason, count(*) AS n FROM clean WHERE reason IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20"))
def agg5(s, d):
    from pairloom.operators.choice import top_reasons

    return top_reasons(_cleaned(s, d).select(F.substring("reason", 1, 80).alias("reason")), 20)
