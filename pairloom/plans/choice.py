"""Queries over views, majorities, caps, reasons, acceptance and budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.operators import choice, judging, state
from pairloom.plans.core import _LATEST, _SCORE, _WIDE, _state, _vox
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored


def _ev(sql: str) -> str:
    return with_fixtures(sql, "fx_stage_events")


@query("win2_best_view", _ev("""SELECT obj_id, view, px FROM (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY px DESC, view) AS rn
 FROM (SELECT obj_id, best_view AS view, count(*) AS px FROM fx_stage_events WHERE best_view IS NOT NULL GROUP BY ALL)) WHERE rn = 1"""))
def win2(s, d):
    px = fixture(s, d, "fx_stage_events").where("best_view is not null").groupBy("obj_id", F.col("best_view").alias("view")).agg(F.count(F.lit(1)).alias("px"))
    return choice.best_view(px, ["obj_id"])


@query("agg20_majority_part", _vox("""SELECT pair_id, part_id, n FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY n DESC, part_id) AS rn
 FROM (SELECT pair_id, part_id, count(*) AS n FROM fx_voxels GROUP BY ALL)) WHERE rn = 1"""))
def agg20(s, d):
    return choice.majority(fixture(s, d, "fx_voxels"), ["pair_id"], "part_id")


@query("lim2_caps", with_fixtures("""SELECT obj_id, edit_idx, shard, edit_type FROM (SELECT *, row_number() OVER (PARTITION BY shard, edit_type ORDER BY obj_id, edit_idx) AS rn FROM fx_edits)
 WHERE rn <= 50 ORDER BY obj_id, edit_idx LIMIT 2000""", "fx_edits"))
def lim2(s, d):
    return choice.capped(fixture(s, d, "fx_edits").select("obj_id", "edit_idx", "shard", "edit_type"), ["shard", "edit_type"], ["obj_id", "edit_idx"], 50, 2000)


_REASON = "SELECT stage, obj_id || ':' || status AS reason FROM fx_stage_events WHERE status IN ('fail', 'error', 'deferred')"


def _failures(s, d):
    return fixture(s, d, "fx_stage_events").where(F.col("status").isin("fail", "error", "deferred")).select("stage", F.concat("obj_id", F.lit(":"), "status").alias("reason"))


@query("lim4_top_reasons", _ev(f"SELECT reason, count(*) AS n FROM ({_REASON}) GROUP BY reason ORDER BY n DESC, reason LIMIT 20"))
def lim4(s, d):
    return choice.top_reasons(_failures(s, d), 20)


@query("agg4_top_reasons_by_stage", _ev(f"SELECT stage, reason, n, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY n DESC, reason) AS place FROM (SELECT stage, reason, count(*) AS n FROM ({_REASON}) GROUP BY ALL)) WHERE place <= 3"))
def agg4(s, d):
    return choice.top_reasons(_failures(s, d), 3, ["stage"])


@query("flt8_accept_deletions", _ev(_WIDE + "SELECT obj_id, edit_id, CASE WHEN gate_a IS DISTINCT FROM 'pass' THEN 'gate_A=' || coalesce('''' || gate_a || '''', 'None') END AS reason, gate_a IS NOT DISTINCT FROM 'pass' AS accepted FROM wide WHERE starts_with(edit_id, 'del_')"))
def flt8(s, d):
    return choice.accept_deletions(state.gates(_state(s, d))).select("obj_id", "edit_id", "reason", "accepted")


@query("flt13_voxel_budget", _vox("SELECT pair_id, CAST(sum(in_before) AS BIGINT) AS n_before, CAST(sum(in_after) AS BIGINT) AS n_after, greatest(sum(in_before), sum(in_after)) <= 900 AS kept FROM fx_voxels GROUP BY pair_id"))
def flt13(s, d):
    return choice.voxel_counts(fixture(s, d, "fx_voxels"), 900)


@query("flt18_latent_report", _vox("SELECT pair_id, count(*) AS n, CASE WHEN min(least(x, y, z)) < 0 OR max(greatest(x, y, z)) >= 31 THEN 'coords out of range' WHEN count_if(f0 IS NULL OR f1 IS NULL OR f2 IS NULL OR f3 IS NULL) > 0 THEN 'features missing' END AS error, CASE WHEN count_if(pair_id % 5 = 0 AND x = 0) > 0 THEN 'batch isn''t 0' END AS warning FROM fx_voxels GROUP BY pair_id"))
def flt18(s, d):
    return choice.latent_report(fixture(s, d, "fx_voxels").withColumn("b", ((F.col("pair_id") % 5 == 0) & (F.col("x") == 0)).cast("int")), "pair_id", 31)


@query("flt20_tier_cut", with_fixtures(f"SELECT edit_no, s AS score FROM (SELECT *, {_SCORE} AS s FROM fx_judge) WHERE coalesce(edit_executed, false) AND s >= 0.6", "fx_judge"))
def flt20(s, d):
    j = fixture(s, d, "fx_judge").withColumn("score", judging.composite())
    tier = judging.tier(F.col("score"), F.coalesce("edit_executed", F.lit(False)))
    return j.where(choice.within_tier(tier, "medium")).select("edit_no", "score")


@query("mat5_executed_as", with_fixtures("""SELECT edit_type, CASE WHEN edit_type IN ('material', 'color', 'global') THEN 'TextureOnly' WHEN edit_type = 'deletion' THEN 'Deletion' WHEN edit_type = 'addition' THEN 'Addition' ELSE 'Modification' END AS executed_as,
 count(*) AS n FROM fx_edits GROUP BY ALL""", "fx_edits"))
def mat5(s, d):
    return fixture(s, d, "fx_edits").groupBy("edit_type", choice.executed_as(F.col("edit_type")).alias("executed_as")).agg(F.count(F.lit(1)).alias("n"))


#: In some minutes a judge names a view that there isn't.
_SEEN = ", seen AS (SELECT * REPLACE (CASE WHEN extract(minute FROM ts) % 7 >= 5 THEN CAST(extract(minute FROM ts) % 7 AS INT) ELSE best_view END AS best_view) FROM latest), valid AS (SELECT * REPLACE (CASE WHEN best_view BETWEEN 0 AND 4 THEN best_view END AS best_view) FROM seen)"


def _seen(state: DataFrame) -> DataFrame:
    minute = F.minute("ts")
    return state.withColumn("best_view", F.when(minute % 7 >= 5, minute % 7).otherwise(F.col("best_view")))


_PAIR = "LEFT JOIN latest p ON p.stage = 'gate_a' AND starts_with(e.edit_id, 'add_') AND p.edit_id = 'del_' || substr(e.edit_id, 5)"
_OF = "FROM (SELECT DISTINCT obj_id, edit_id FROM latest) e LEFT JOIN latest a ON a.stage = 'gate_a' AND a.edit_id = e.edit_id "


@query("joi13_best_view", _ev(_LATEST + _SEEN + f"SELECT e.obj_id, e.edit_id, coalesce(a.best_view, p.best_view, CASE WHEN e.edit_id[1:4] IN ('add_', 'del_') THEN 4 END) AS view {_OF} {_PAIR}".replace("latest a", "valid a").replace("latest p", "valid p")))
def joi13(s, d):
    return choice.resolved_views(_seen(_state(s, d)))


@query("joi15_quality_block", _ev(_LATEST + f"""SELECT e.obj_id, e.edit_id, coalesce(a.score, CASE WHEN starts_with(e.edit_id, 'add_') THEN p.score END) AS alignment, g.score AS quality,
 NOT EXISTS (SELECT 1 FROM latest f WHERE f.edit_id = e.edit_id AND starts_with(f.stage, 'gate') AND f.status = 'fail') AS final_pass {_OF} {_PAIR} LEFT JOIN latest g ON g.stage = 'gate_e' AND g.edit_id = e.edit_id"""))
def joi15(s, d):
    return choice.quality_block(_state(s, d))


@query("agg18_colourful_fraction", _vox("""SELECT pair_id, coalesce(sum(vivid) FILTER (n >= 20) / sum(n) FILTER (n >= 20), 0) AS fraction, coalesce(sum(vivid) FILTER (n >= 20) / sum(n) FILTER (n >= 20), 0) < 0.05 AS white
 FROM (SELECT pair_id, part_id, count(*) AS n, count_if(f0 > 40) AS vivid FROM fx_voxels GROUP BY ALL) GROUP BY pair_id"""))
def agg18(s, d):
    return choice.colourful_fraction(fixture(s, d, "fx_voxels").withColumn("s", F.col("f0")), "pair_id", "part_id", 20)


@query("joi1_plan_with_gate", _ev(_LATEST + "SELECT e.obj_id, e.edit_id, a.best_view, a.status " + _OF))
def joi1(s, d):
    return choice.gate_record(_state(s, d), "gate_a")


@query("joi6_unscored", _ev("""SELECT obj_id, edit_id FROM (SELECT DISTINCT obj_id, edit_id FROM fx_stage_events) e
 WHERE NOT EXISTS (SELECT 1 FROM (SELECT *, row_number() OVER (PARTITION BY edit_id ORDER BY seq DESC) AS rn FROM fx_stage_events WHERE stage = 'gate_e') l WHERE l.rn = 1 AND l.score IS NOT NULL AND l.edit_id = e.edit_id)"""))
def joi6(s, d):
    events = fixture(s, d, "fx_stage_events")
    scores = events.where("stage = 'gate_e'").select("edit_id", "score", F.col("seq").alias("line_no"))
    return choice.unscored(events.select("obj_id", "edit_id").distinct(), scores).select("obj_id", "edit_id")


@query("set3_merged_manifests", _ev(_LATEST + """SELECT edit_id, obj_id, arg_min(tag, tag) AS tag FROM (SELECT edit_id, obj_id, stage AS tag FROM latest WHERE stage IN ('gate_c', 'gate_e') AND status = 'pass') GROUP BY ALL"""))
def set3(s, d):
    passed = stored(_state(s, d).where(F.col("stage").isin("gate_c", "gate_e") & (F.col("status") == "pass")).select("edit_id", "obj_id", F.col("stage").alias("tag")))
    return choice.merged_manifests([passed.where(F.col("tag") == g) for g in ("gate_c", "gate_e")], ["obj_id", "edit_id"])
