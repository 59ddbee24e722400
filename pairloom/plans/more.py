"""Queries over metrics, checks, order, progress, runs and coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom.operators import grid, judging, metrics, order, state
from pairloom.plans.core import _DUE, _LATEST, _cells, _REGION, _SCORE, _WIDE, _region, _state, _vox
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import table
from pairloom.streaming import progress

_PAIRS = """WITH c AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)),
 p AS (SELECT b.vec_id AS pair_id, b.v AS x, a.v AS y FROM c b JOIN c a ON a.vec_id = b.vec_id + 1 AND a.i = b.i WHERE b.vec_id % 2 = 0) """


@query("met3_4_vector_distance", _PAIRS + "SELECT pair_id, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS cosine, round(sqrt(sum((x - y) * (x - y))) / sqrt(sum(x * x)), 6) AS relative_l2 FROM p GROUP BY pair_id")
def met3(s, d):
    b, a = F.col("before"), F.col("after")
    return metrics.vector_pairs(table(s, d, "embeddings")).select("pair_id", F.round(metrics.cosine(b, a), 6).alias("cosine"), F.round(metrics.relative_l2(b, a), 6).alias("relative_l2"))


@query("img1_2_psnr_ssim", _PAIRS + """SELECT pair_id, round(CASE WHEN avg((x - y) * (x - y)) <= 1e-12 THEN 100 ELSE 20 * log10(1 / sqrt(avg((x - y) * (x - y)))) END, 6) AS psnr,
 round(greatest(-1, least(1, (2 * avg(x) * avg(y) + 1e-4::DOUBLE) * (2 * covar_pop(x, y) + 9e-4::DOUBLE) / ((avg(x) * avg(x) + avg(y) * avg(y) + 1e-4::DOUBLE) * (var_pop(x) + var_pop(y) + 9e-4::DOUBLE)))), 6) AS ssim FROM p GROUP BY pair_id""")
def img1(s, d):
    b, a = F.col("before"), F.col("after")
    return metrics.vector_pairs(table(s, d, "embeddings")).select("pair_id", F.round(metrics.psnr(b, a), 6).alias("psnr"), F.round(metrics.ssim(b, a), 6).alias("ssim"))


_ENDS = ", ".join(f"{f}({x}) FILTER (in_{w} = 1) AS {w[0]}_{n}_{x}" for w in ("before", "after") for n, f in (("lo", "min"), ("hi", "max")) for x in "xyz")
_VOL = {s: " * ".join(f"greatest({s}_hi_{x} - {s}_lo_{x}, 1)" for x in "xyz") for s in "ba"}
_COMMON = " * ".join(f"greatest(least(b_hi_{x}, a_hi_{x}) - greatest(b_lo_{x}, a_lo_{x}), 0)" for x in "xyz")


@query("met2_box_iou", _vox(f"SELECT pair_id, round(({_COMMON}) / ({_VOL['b']} + {_VOL['a']} - {_COMMON}), 6) AS iou FROM (SELECT pair_id, {_ENDS} FROM fx_voxels GROUP BY pair_id) WHERE b_lo_x IS NOT NULL AND a_lo_x IS NOT NULL"))
def met2(s, d):
    return metrics.box_iou(fixture(s, d, "fx_voxels"))


@query("chk1_4_5_sco1_layer_one", _vox("""SELECT pair_id, round_even((2 * (n BETWEEN 100 AND 40000)::INT + 3 * valid::INT + 2 * (u = n)::INT) / 7, 4) AS score, (n BETWEEN 100 AND 40000) AND valid AND u = n AS passed
 FROM (SELECT pair_id, count(*) AS n, count(DISTINCT (x, y, z)) AS u, bool_and(least(x, y, z) >= 0 AND greatest(x, y, z) < 64) AS valid FROM fx_voxels GROUP BY pair_id)"""))
def chk1(s, d):
    return metrics.weighted_score(metrics.layer_one(fixture(s, d, "fx_voxels")))


@query("vox7_keep_flag", _vox(_REGION + "SELECT pair_id, x, y, z, CASE WHEN EXISTS (SELECT 1 FROM region r WHERE r.pair_id = v.pair_id AND r.x = v.x AND r.y = v.y AND r.z = v.z) THEN 0 ELSE 1 END AS keep FROM fx_voxels v"))
def vox7(s, d):
    v = _cells(s, d)
    return v.join(_region(v).withColumn("_in", F.lit(1)), grid.CELL, "left").select(*grid.CELL, F.when(F.col("_in").isNull(), 1).otherwise(0).alias("keep"))


@query("vox16_frame_overlap", _vox("SELECT pair_id, round(coalesce(avg(in_before) FILTER (in_after = 1), 0), 6) AS overlap FROM fx_voxels GROUP BY pair_id"))
def vox16(s, d):
    return fixture(s, d, "fx_voxels").groupBy("pair_id").agg(F.round(F.coalesce(F.avg(F.when(F.col("in_after") == 1, F.col("in_before"))), F.lit(0.0)), 6).alias("overlap"))


@query("key7_8_shards", "WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders), n AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS rn, count(*) OVER () AS t FROM o) SELECT k, rn, CAST(floor(rn / ceil(t / 10)) AS INT) AS shard, CAST(rn % 10 AS INT) AS slice FROM n")
def key7(s, d):
    return order.shards(table(s, d, "orders").select(F.col("o_orderkey").alias("k")).distinct(), "k", 10)


@query("str4_hourly_progress", with_fixtures("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, stage, status, count(*) AS n FROM fx_stage_events GROUP BY ALL", "fx_stage_events"))
def str4(s, d):
    counts = progress.hourly(fixture(s, d, "fx_stage_events"))
    return counts.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("joi17_run_comparison", with_fixtures(_WIDE + """SELECT obj_id, count_if(a AND NOT b) AS pass_to_fail, count_if(b AND NOT a) AS fail_to_pass, count(*) AS n FROM
 (SELECT obj_id, coalesce(gate_c = 'pass', false) AS a, coalesce(gate_e = 'pass', false) AS b FROM wide WHERE gate_c IS NOT NULL OR gate_e IS NOT NULL) GROUP BY obj_id""", "fx_stage_events"))
def joi17(s, d):
    run = lambda g, c: F.coalesce(F.max(F.when(F.col("stage") == g, F.col("status") == "pass")), F.lit(False)).alias(c)
    both = _state(s, d).where(F.col("stage").isin("gate_c", "gate_e")).groupBy("obj_id", "edit_id").agg(run("gate_c", "a"), run("gate_e", "b"))
    return both.groupBy("obj_id").agg(F.count_if(F.col("a") & ~F.col("b")).alias("pass_to_fail"), F.count_if(F.col("b") & ~F.col("a")).alias("fail_to_pass"), F.count(F.lit(1)).alias("n"))


@query("joi4_agg10_pending_weight", with_fixtures(_LATEST + f"SELECT obj_id, count(*) AS pending FROM ({_DUE.format(g='gate_c')}) GROUP BY obj_id", "fx_stage_events"))
def joi4(s, d):
    return state.needs_stage(_state(s, d), "s5", "gate_c").groupBy("obj_id").agg(F.count(F.lit(1)).alias("pending"))


@query("agg12_sta5_gate_coverage", with_fixtures(_WIDE + "SELECT *, expected = found AS ok, expected_c = found_c AS ok_c FROM (SELECT obj_id, count(*) AS expected, count(*) FILTER (gate_a IN ('pass', 'fail')) AS found, count(*) FILTER (starts_with(edit_id, 'mod_')) AS expected_c, count(*) FILTER (starts_with(edit_id, 'mod_') AND gate_c IN ('pass', 'fail')) AS found_c FROM wide GROUP BY obj_id)", "fx_stage_events"))
def agg12(s, d):
    """Gate A is expected of all edits, gate C of generated ones."""
    n = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    made = F.col("edit_id").startswith("mod_")
    w = state.gates(_state(s, d)).groupBy("obj_id").agg(F.count(F.lit(1)).alias("expected"), n(F.col("gate_a").isin("pass", "fail")).alias("found"), n(made).alias("expected_c"), n(made & F.col("gate_c").isin("pass", "fail")).alias("found_c"))
    return w.select("*", (F.col("expected") == F.col("found")).alias("ok"), (F.col("expected_c") == F.col("found_c")).alias("ok_c"))


_RATES = {"edit_executed": "executed", "correct_region": "region", "preserve_other": "preserve", "artifact_free": "artifact"}


@query("agg7_score_summary", with_fixtures("SELECT edit_type, count(*) AS n, count_if(s >= 0.6) AS passed, round(count_if(s >= 0.6) / count(*), 6) AS pass_rate, round(avg(s), 6) AS mean, round(median(s), 6) AS median, "
 + ", ".join(f"round(count_if({c}) / count(*), 6) AS rate_{n}" for c, n in _RATES.items()) + f" FROM (SELECT *, {_SCORE} AS s FROM fx_judge) GROUP BY GROUPING SETS ((), (edit_type))", "fx_judge"))
def agg7(s, d):
    j, n = fixture(s, d, "fx_judge").withColumn("s", judging.composite()), F.count(F.lit(1))
    rates = [F.round(F.count_if(c) / n, 6).alias(f"rate_{name}") for c, name in _RATES.items()]
    passed = F.count_if(F.col("s") >= 0.6)
    return j.rollup("edit_type").agg(n.alias("n"), passed.alias("passed"), F.round(passed / n, 6).alias("pass_rate"), F.round(F.avg("s"), 6).alias("mean"), F.round(F.percentile("s", 0.5), 6).alias("median"), *rates)


_VIEW = """WITH o AS (SELECT *, has_verdict AND (rule_pass IS NOT NULL OR vlm_pass IS NOT NULL) AS own FROM fx_verdicts),
 p AS (SELECT *, CASE WHEN own THEN rule_pass END AS r, CASE WHEN own THEN vlm_pass WHEN status IN ('pass', 'fail') THEN status = 'pass' ELSE legacy_pass END AS v, CASE WHEN own THEN vlm_reason WHEN status IN ('pass', 'fail') THEN 'from_stage_status' END AS why FROM o),
 q AS (SELECT obj_id, edit_id, gate, CASE WHEN NOT r THEN coalesce(rule_code, 'rule_fail') WHEN NOT v THEN coalesce(why, 'vlm_fail')[1:80] END AS reason FROM p),
 w AS (SELECT obj_id, edit_id, max(reason) FILTER (gate = 'gate_a') AS ra, max(reason) FILTER (gate = 'gate_c') AS rc, max(reason) FILTER (gate = 'gate_e') AS re FROM q GROUP BY obj_id, edit_id),
 view AS (SELECT obj_id, edit_id, ra IS NULL AS a, rc IS NULL AS c, re IS NULL AS e, CASE WHEN ra IS NOT NULL THEN 'A' WHEN rc IS NOT NULL THEN 'C' WHEN re IS NOT NULL THEN 'E' END AS fail_gate, coalesce(ra, rc, re) AS fail_reason, coalesce(ra, rc, re) IS NULL AS final_pass FROM w) """


@query("sta1_win6_flt7_verdict_view", with_fixtures(_VIEW + "SELECT * FROM view", "fx_verdicts"))
def sta1(s, d):
    return state.verdict_view(fixture(s, d, "fx_verdicts"))


@query("sta7_failure_flags", with_fixtures(_VIEW + "SELECT DISTINCT e.obj_id, e.edit_id, coalesce(NOT final_pass, false) AS edit_failed, coalesce(NOT a, false) AS gate_a_failed FROM fx_stage_events e LEFT JOIN view USING (edit_id)", "fx_verdicts", "fx_stage_events"))
def sta7(s, d):
    """Edits without any gate have failed none."""
    view = state.verdict_view(fixture(s, d, "fx_verdicts")).select("edit_id", "final_pass", "a")
    every = fixture(s, d, "fx_stage_events").select("obj_id", "edit_id").distinct()
    return every.join(view, "edit_id", "left").select("obj_id", "edit_id", F.coalesce(~F.col("final_pass"), F.lit(False)).alias("edit_failed"), F.coalesce(~F.col("a"), F.lit(False)).alias("gate_a_failed"))


_GATE_COLUMNS = ", ".join(f"max({c}) FILTER (stage = '{g}') AS {g}_{c}" for g in ("gate_a", "gate_c", "gate_e") for c in ("status", "ts", "score"))


@query("sta4_gate_summary", with_fixtures(_LATEST + f"SELECT *, NOT coalesce(gate_a_status = 'fail' OR gate_c_status = 'fail' OR gate_e_status = 'fail', false) AS final_pass FROM (SELECT obj_id, edit_id, {_GATE_COLUMNS} FROM latest GROUP BY obj_id, edit_id)", "fx_stage_events"))
def sta4(s, d):
    return state.gate_summary(_state(s, d))


@query("win5_object_shuffle", with_fixtures("SELECT obj_id, edit_idx, md5('7:' || obj_id) AS object_key, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY md5('7:' || obj_id || ':' || CAST(edit_idx AS VARCHAR)), edit_idx) AS INT) AS place FROM fx_edits", "fx_edits"))
def win5(s, d):
    """A keyed order of objects, and of the edits within each: an epoch's order is that of (object_key, place)."""
    key = F.md5(F.concat(F.lit("7:"), F.col("obj_id")))
    own = F.md5(F.concat(F.lit("7:"), F.col("obj_id"), F.lit(":"), F.col("edit_idx").cast("string")))
    return fixture(s, d, "fx_edits").select("obj_id", "edit_idx", key.alias("object_key"), F.row_number().over(Window.partitionBy("obj_id").orderBy(own, "edit_idx")).alias("place"))
