"""Queries over edit plans, stage state, judgements and voxel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators import edits, grid, judging, order, state
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored

_GEN = "('modification', 'scale', 'material', 'color', 'global')"
_IDS = f"""WITH k AS (SELECT *, CASE WHEN edit_type = 'deletion' THEN 'd' WHEN edit_type IN {_GEN} THEN 'g' END AS kind FROM fx_edits),
 ids AS (SELECT *, CAST(row_number() OVER (PARTITION BY obj_id, kind ORDER BY edit_idx) - 1 AS INT) AS seq FROM k WHERE kind IS NOT NULL),
 named AS (SELECT *, CASE edit_type WHEN 'deletion' THEN 'del' WHEN 'modification' THEN 'mod' WHEN 'scale' THEN 'scl' WHEN 'material' THEN 'mat' WHEN 'color' THEN 'clr' ELSE 'glb' END || '_' || obj_id || '_' || CASE WHEN seq < 1000 THEN lpad(CAST(seq AS VARCHAR), 3, '0') ELSE CAST(seq AS VARCHAR) END AS edit_id FROM ids) """
_LATEST = """WITH latest AS (SELECT obj_id, edit_id, stage, arg_max(status, {'a': ts, 'b': seq}) AS status, arg_max(best_view, {'a': ts, 'b': seq}) FILTER (best_view IS NOT NULL) AS best_view,
 arg_max(score, {'a': ts, 'b': seq}) FILTER (score IS NOT NULL) AS score, max(ts) AS ts FROM fx_stage_events GROUP BY obj_id, edit_id, stage) """
_WIDE = _LATEST + """, wide AS (SELECT obj_id, edit_id, max(status) FILTER (stage = 'gate_a') AS gate_a, max(status) FILTER (stage = 'gate_c') AS gate_c, max(status) FILTER (stage = 'gate_e') AS gate_e FROM latest GROUP BY obj_id, edit_id) """


def _edits(sql: str) -> str:
    return with_fixtures(sql, "fx_edits")


def _state(s, d) -> DataFrame:
    return state.latest(fixture(s, d, "fx_stage_events"))


@query("key1_edit_ids", _edits(_IDS + "SELECT obj_id, edit_idx, edit_type, seq, edit_id FROM named"))
def key1(s, d):
    return edits.assign_ids(fixture(s, d, "fx_edits")).select("obj_id", "edit_idx", "edit_type", "seq", "edit_id")


@query("key4_type_and_pair_of_id", with_fixtures("SELECT DISTINCT edit_id, CASE split_part(edit_id, '_', 1) WHEN 'del' THEN 'deletion' WHEN 'mod' THEN 'modification' ELSE 'addition' END AS edit_type, CASE WHEN starts_with(edit_id, 'del_') THEN 'add_' || substr(edit_id, 5) WHEN starts_with(edit_id, 'add_') THEN 'del_' || substr(edit_id, 5) END AS paired FROM fx_stage_events", "fx_stage_events"))
def key4(s, d):
    e = fixture(s, d, "fx_stage_events").select("edit_id").distinct()
    return e.select("edit_id", edits.type_of(F.col("edit_id")).alias("edit_type"), edits.paired_id(F.col("edit_id")).alias("paired"))


@query("key6_normal_shard", "SELECT DISTINCT c_nationkey, CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN '0' || CAST(c_nationkey AS VARCHAR) ELSE CAST(c_nationkey AS VARCHAR) END AS shard FROM customer")
def key6(s, d):
    from pairloom.session import table

    return table(s, d, "customer").select("c_nationkey", edits.normal_shard(F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" "))).alias("shard")).distinct()


@query("key7_range_shards", "WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT o_orderkey FROM orders)) SELECT o_orderkey, idx, CAST(floor(idx / ceil(n / 7)) AS BIGINT) AS shard, idx % 4 AS slice FROM i")
def key7(s, d):
    from pairloom.session import table

    at = order.shards(table(s, d, "orders").select("o_orderkey").distinct(), "o_orderkey", 7)
    return at.select("o_orderkey", F.col("rn").alias("idx"), F.col("shard").cast("long").alias("shard"), F.pmod("rn", F.lit(4)).alias("slice"))


@query("key9_voxel_key", with_fixtures("SELECT pair_id, CAST(x AS BIGINT) * 1024 + y * 32 + z AS key, x, y, z FROM fx_voxels", "fx_voxels"))
def key9(s, d):
    keyed = fixture(s, d, "fx_voxels").select("pair_id", grid.cell_key(32).alias("key"))
    return keyed.select("pair_id", "key", *grid.cell_of(F.col("key"), 32))


@query("flt1_invalid_parts", with_fixtures("SELECT e.obj_id, edit_idx, CAST((SELECT count(*) FROM (SELECT pid1 AS p UNION SELECT pid2) q WHERE NOT EXISTS (SELECT 1 FROM fx_parts f WHERE f.obj_id = e.obj_id AND f.part_id = q.p)) AS INT) AS n_invalid FROM fx_edits e", "fx_edits", "fx_parts"))
def flt1(s, d):
    return edits.invalid_parts(fixture(s, d, "fx_edits"), fixture(s, d, "fx_parts")).select("obj_id", "edit_idx", "n_invalid")


@query("flt3_repeated_edits", _edits("SELECT obj_id, edit_idx, nth FROM (SELECT *, CAST(row_number() OVER (PARTITION BY obj_id, edit_type, least(pid1, pid2), greatest(pid1, pid2) ORDER BY edit_idx) AS INT) AS nth FROM fx_edits WHERE edit_type <> 'global') WHERE nth > 1"))
def flt3(s, d):
    return edits.repeated_edits(fixture(s, d, "fx_edits")).select("obj_id", "edit_idx", "nth")


_VERBS = "".join(f" WHEN starts_with(lower(p), '{v}') THEN 'Add' || substr(p, {len(v) + 1}) WHEN contains(lower(p), ' {v} ') THEN substr(p, 1, instr(lower(p), ' {v} ')) || 'add' || substr(p, instr(lower(p), ' {v} ') + {len(v) + 1})" for v in edits.REMOVE_VERBS)
_INVERT = f"SELECT prompt, CASE WHEN p = '' THEN '' WHEN instr(o, ' from ') > 0 THEN substr(o, 1, instr(o, ' from ') - 1) || ' to ' || substr(o, instr(o, ' from ') + 6) ELSE o END AS inverse FROM (SELECT prompt, p, CASE {_VERBS} ELSE 'Add back ' || p END AS o FROM (SELECT prompt, trim(prompt) AS p FROM (SELECT DISTINCT prompt FROM fx_edits)))"


@query("txt1_invert_prompt", _edits(_INVERT))
def txt1(s, d):
    return fixture(s, d, "fx_edits").select("prompt").distinct().select("prompt", edits.invert_prompt(F.col("prompt")).alias("inverse"))


_QUOTA = "CAST(greatest(1, least(8, ceil(n / 2.5))) AS INT) AS q_deletion, CAST(greatest(1, least(8, ceil(n / 2))) AS INT) AS q_modification, CASE WHEN n < 8 THEN 1 ELSE 2 END AS q_scale, CASE WHEN n % 5 = 0 THEN 0 WHEN n < 8 THEN 1 ELSE 2 END AS q_material, CASE WHEN n % 5 = 0 THEN 0 WHEN n < 8 THEN 1 ELSE 2 END AS q_color, 2 AS q_global"


@query("mat1_quota", with_fixtures(f"SELECT obj_id, n, {_QUOTA} FROM (SELECT obj_id, count(*) AS n FROM fx_parts GROUP BY obj_id)", "fx_parts"))
def mat1(s, d):
    n = fixture(s, d, "fx_parts").groupBy("obj_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("obj_id", "n", *[v.alias(k) for k, v in edits.quota(F.col("n"), F.col("n") % 5 == 0).items()])


@query("mat2_halved_quota", with_fixtures(f"SELECT obj_id, greatest(1, q_deletion // 2) AS q_deletion, greatest(1, q_modification // 2) AS q_modification, q_scale // 2 AS q_scale, q_material // 2 AS q_material, q_color // 2 AS q_color, 1 AS q_global FROM (SELECT obj_id, {_QUOTA} FROM (SELECT obj_id, count(*) AS n FROM fx_parts GROUP BY obj_id))", "fx_parts"))
def mat2(s, d):
    n = fixture(s, d, "fx_parts").groupBy("obj_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("obj_id", *[v.alias(k) for k, v in edits.halved(edits.quota(F.col("n"), F.col("n") % 5 == 0)).items()])


@query("win1_latest_stage", with_fixtures(_LATEST + "SELECT obj_id, edit_id, stage, status, best_view, score FROM latest", "fx_stage_events"))
def win1(s, d):
    return _state(s, d).drop("ts")


@query("agg2_stage_funnel", with_fixtures(_LATEST + """, st(stage_no, stage) AS (VALUES (0, 'gate_a'), (1, 's4'), (2, 'gate_c'), (3, 's5'), (4, 'gate_e')),
 c AS (SELECT stage_no, st.stage, count_if(status IN ('pass', 'done')) AS pass_done, count_if(status = 'fail') AS fail, count_if(status = 'error' AND NOT starts_with(st.stage, 'gate')) AS error FROM st LEFT JOIN latest ON latest.stage = st.stage GROUP BY stage_no, st.stage)
 SELECT stage, stage_no, pass_done, fail, error, pass_done + fail + error AS eligible, CASE WHEN stage_no = 0 THEN (SELECT count(DISTINCT edit_id) FROM latest) - (pass_done + fail + error) ELSE 0 END AS pending FROM c""", "fx_stage_events"))
def agg2(s, d):
    return state.stage_funnel(_state(s, d))


@query("agg1_status_histogram", with_fixtures(_LATEST + "SELECT stage, coalesce(status, '?') AS status, count(*) AS n, count(DISTINCT obj_id) AS objects FROM latest GROUP BY stage, coalesce(status, '?')", "fx_stage_events"))
def agg1(s, d):
    return _state(s, d).groupBy("stage", F.coalesce("status", F.lit("?")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("obj_id").alias("objects"))


@query("agg9_object_badges", with_fixtures(_LATEST + "SELECT obj_id, stage, count(*) AS total, count_if(status IN ('pass', 'done', 'ok')) AS ok, count_if(status = 'fail') AS fail, CASE WHEN stage = 'gate_e' THEN round(count_if(status = 'pass') / count(*), 6) END AS pass_rate FROM latest GROUP BY obj_id, stage", "fx_stage_events"))
def agg9(s, d):
    return _state(s, d).groupBy("obj_id", "stage").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status").isin("pass", "done", "ok")).alias("ok"), F.count_if(F.col("status") == "fail").alias("fail"), F.when(F.col("stage") == "gate_e", F.round(F.count_if(F.col("status") == "pass") / F.count(F.lit(1)), 6)).alias("pass_rate"))


@query("sta1_gate_view", with_fixtures(_WIDE + "SELECT obj_id, edit_id, gate_a, gate_c, gate_e, CASE WHEN gate_a = 'fail' THEN 'gate_a' WHEN gate_c = 'fail' THEN 'gate_c' WHEN gate_e = 'fail' THEN 'gate_e' END AS fail_gate, NOT coalesce(gate_a = 'fail' OR gate_c = 'fail' OR gate_e = 'fail', false) AS final_pass FROM wide", "fx_stage_events"))
def sta1(s, d):
    return state.gates(_state(s, d))


@query("flt9_accept_generated", with_fixtures(_WIDE + "SELECT edit_id, CASE WHEN gate_a IS DISTINCT FROM 'pass' THEN 'gate_A=' || coalesce('''' || gate_a || '''', 'None') WHEN gate_e IS DISTINCT FROM 'pass' THEN 'gate_E=' || coalesce('''' || gate_e || '''', 'None') END AS reason, gate_a IS NOT DISTINCT FROM 'pass' AND gate_e IS NOT DISTINCT FROM 'pass' AS accepted FROM wide WHERE starts_with(edit_id, 'mod_')", "fx_stage_events"))
def flt9(s, d):
    return state.accept_generated(state.gates(_state(s, d)).where("edit_id LIKE 'mod\\_%'")).select("edit_id", "reason", "accepted")


_DUE = """SELECT obj_id, edit_id FROM (SELECT obj_id, edit_id, count_if(stage = 's5') AS seen, max(status) FILTER (stage = 's5') AS own, max(status) FILTER (stage = '{g}') AS gate FROM latest GROUP BY obj_id, edit_id)
 WHERE (gate = 'pass' OR ('{g}' = 'gate_a' AND starts_with(edit_id, 'add_'))) AND (seen = 0 OR own = 'error')"""


@query("joi3_needs_stage", with_fixtures(_LATEST + _DUE.format(g="gate_c"), "fx_stage_events"))
def joi3(s, d):
    return state.needs_stage(_state(s, d), "s5", "gate_c")


@query("joi3_joi5_after_gate_a", with_fixtures(_LATEST + _DUE.format(g="gate_a"), "fx_stage_events"))
def joi3_without_gate_c(s, d):
    """The gate before s5 where only the text gate is switched on."""
    return state.needs_stage(_state(s, d), "s5", state.prerequisites({"gate_text_align", "gate_quality"})["s5"])


_P1 = "coalesce(edit_executed, false) AND visual_quality >= 3 AND correct_region AND preserve_other"


@query("flt10_12_judge_thresholds", with_fixtures(f"SELECT edit_no, {_P1} AS v1, mesh_quality >= 4 AND coalesce(edit_strength, CASE WHEN edit_executed THEN 1 ELSE 0 END) >= 2 AND visual_quality >= 2 AND correct_region AND preserve_other AS v2, {_P1} AND coalesce(artifact_free, false) AS v3 FROM fx_judge", "fx_judge"))
def flt10(s, d):
    return fixture(s, d, "fx_judge").select("edit_no", *[judging.passes(v).alias(f"v{v}") for v in (1, 2, 3)])


_SCORE = "round_even(0.3::DOUBLE * coalesce(edit_executed, false)::INT + 0.2::DOUBLE * correct_region::INT + 0.2::DOUBLE * preserve_other::INT + 0.2::DOUBLE * ((visual_quality - 1) / 4) + 0.1::DOUBLE * coalesce(artifact_free, false)::INT, 4)"


@query("mat3_sco2_score_and_tier", with_fixtures(f"SELECT edit_no, s AS score, CASE WHEN NOT coalesce(edit_executed, false) THEN 'negative' WHEN s >= 0.8 THEN 'high' WHEN s >= 0.6 THEN 'medium' WHEN s >= 0.4 THEN 'low' ELSE 'negative' END AS tier FROM (SELECT *, {_SCORE} AS s FROM fx_judge)", "fx_judge"))
def mat3(s, d):
    j = fixture(s, d, "fx_judge").withColumn("score", judging.composite())
    return j.select("edit_no", "score", judging.tier(F.col("score"), F.coalesce("edit_executed", F.lit(False))).alias("tier"))


@query("agg5_6_tier_summary", with_fixtures(f"WITH t AS (SELECT edit_type, CASE WHEN NOT coalesce(edit_executed, false) THEN 'negative' WHEN s >= 0.8 THEN 'high' WHEN s >= 0.6 THEN 'medium' WHEN s >= 0.4 THEN 'low' ELSE 'negative' END AS tier FROM (SELECT *, {_SCORE} AS s FROM fx_judge)) SELECT edit_type, tier, count(*) AS n, round(count(*) / (SELECT count(*) FROM t), 6) AS part FROM t GROUP BY GROUPING SETS ((), (tier), (edit_type), (edit_type, tier))", "fx_judge"))
def agg5(s, d):
    t = fixture(s, d, "fx_judge").select("edit_type", judging.tier(judging.composite(), F.coalesce("edit_executed", F.lit(False))).alias("tier"))
    counts = t.groupBy("edit_type", "tier").agg(F.count(F.lit(1)).alias("n"))  # a row for each type and tier: from here on all is small
    total = F.max(F.sum("n")).over(Window.partitionBy())
    return counts.cube("edit_type", "tier").agg(F.sum("n").alias("n"), F.round(F.sum("n") / total, 6).alias("part"))


@query("agg8_benchmark_summary", with_fixtures("SELECT edit_type, round(avg(visual_quality), 6) AS mean, round(stddev_pop(visual_quality), 6) AS std, count(visual_quality) AS n FROM fx_judge GROUP BY edit_type", "fx_judge"))
def agg8(s, d):
    return fixture(s, d, "fx_judge").groupBy("edit_type").agg(F.round(F.avg("visual_quality"), 6).alias("mean"), F.round(F.stddev_pop("visual_quality"), 6).alias("std"), F.count("visual_quality").alias("n"))


@query("agg19_type_counts", _edits("SELECT edit_type, count(*) AS edits, count(DISTINCT obj_id) AS objects FROM fx_edits GROUP BY edit_type"))
def agg19(s, d):
    return fixture(s, d, "fx_edits").groupBy("edit_type").agg(F.count(F.lit(1)).alias("edits"), F.countDistinct("obj_id").alias("objects"))


@query("lim1_type_quota", _edits(_IDS + "SELECT edit_id, edit_type, nth FROM (SELECT edit_id, edit_type, CAST(row_number() OVER (PARTITION BY edit_type ORDER BY obj_id, seq) AS INT) AS nth FROM named WHERE after_desc <> '') WHERE nth <= 50"))
def lim1(s, d):
    e = edits.assign_ids(fixture(s, d, "fx_edits")).where("after_desc <> ''")
    return e.select("edit_id", "edit_type", F.row_number().over(Window.partitionBy("edit_type").orderBy("obj_id", "seq")).alias("nth")).where("nth <= 50")


_REGION = "WITH reg AS (SELECT DISTINCT pair_id, x + a AS x, y + b AS y, z + c AS z FROM fx_voxels, range(-1, 2) p(a), range(-1, 2) q(b), range(-1, 2) r(c) WHERE part_id = 3 AND x + a BETWEEN 0 AND 31 AND y + b BETWEEN 0 AND 31 AND z + c BETWEEN 0 AND 31), region AS (SELECT * FROM reg r WHERE NOT EXISTS (SELECT 1 FROM fx_voxels v WHERE v.part_id <> 3 AND v.pair_id = r.pair_id AND v.x = r.x AND v.y = r.y AND v.z = r.z)) "


def _vox(sql: str) -> str:
    return with_fixtures(sql, "fx_voxels")


def _cells(s, d) -> DataFrame:
    """Stored once: the region and what is taken from it both start from them."""
    return stored(fixture(s, d, "fx_voxels"))


def _region(cells: DataFrame) -> DataFrame:
    return grid.part_region(cells, 3, 1, 32)


@query("vox1_downsample", _vox("SELECT DISTINCT pair_id, x // 4 AS x, y // 4 AS y, z // 4 AS z FROM fx_voxels"))
def vox1(s, d):
    return grid.downsample(fixture(s, d, "fx_voxels"), 4)


@query("vox3_dilate", _vox(_REGION + "SELECT * FROM reg"))
def vox3(s, d):
    return grid.dilate(fixture(s, d, "fx_voxels").where("part_id = 3"), 1, 32)


@query("vox4_part_region", _vox(_REGION + "SELECT * FROM region"))
def vox4(s, d):
    return _region(_cells(s, d))


@query("vox5_keep_blocks", _vox(_REGION + "SELECT pair_id, x // 4 AS x, y // 4 AS y, z // 4 AS z, count(*) AS n FROM region GROUP BY ALL HAVING count(*) * 10 >= 64"))
def vox5(s, d):
    return grid.keep_blocks(_region(_cells(s, d)))


@query("vox9_preserve_bridge", _vox(_REGION + "SELECT pair_id, x, y, z FROM fx_voxels v WHERE in_before = 1 AND in_after = 1 AND NOT EXISTS (SELECT 1 FROM region r WHERE v.pair_id = r.pair_id AND v.x = r.x AND v.y = r.y AND v.z = r.z)"))
def vox9(s, d):
    v = _cells(s, d)
    return grid.preserved(v, _region(v)).select(*grid.CELL)


@query("vox29_warm_start", _vox(_REGION + "SELECT pair_id, x, y, z FROM fx_voxels v WHERE in_before = 1 AND in_after = 1 AND EXISTS (SELECT 1 FROM region r WHERE v.pair_id = r.pair_id AND v.x = r.x AND v.y = r.y AND v.z = r.z)"))
def vox29(s, d):
    v = _cells(s, d)
    return grid.warm_start(v, _region(v)).select(*grid.CELL)


@query("vox10_restore", _vox(_REGION + "SELECT pair_id, x, y, z FROM fx_voxels v WHERE in_after = 1 OR (in_before = 1 AND NOT EXISTS (SELECT 1 FROM region r WHERE v.pair_id = r.pair_id AND v.x = r.x AND v.y = r.y AND v.z = r.z))"))
def vox10(s, d):
    v = _cells(s, d)
    return grid.restore(v, _region(v))


@query("set1_vox17_set_counts", _vox("SELECT *, round(common / greatest(only_before + only_after + common, 1), 6) AS iou, round((only_before + only_after) / greatest(only_before + only_after + common, 1), 6) AS diff_ratio FROM (SELECT pair_id, count_if(in_before = 1 AND in_after = 0) AS only_before, count_if(in_after = 1 AND in_before = 0) AS only_after, count_if(in_before = 1 AND in_after = 1) AS common FROM fx_voxels GROUP BY pair_id)"))
def set1(s, d):
    return grid.set_counts(fixture(s, d, "fx_voxels"))


@query("gra1_components", _vox("""WITH RECURSIVE k AS (SELECT pair_id, x * 1024 + y * 32 + z AS id, x, y, z FROM fx_voxels),
 e AS (SELECT a.pair_id, a.id AS i, b.id AS j FROM k a CROSS JOIN (VALUES (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) o(p, q, r) JOIN k b ON a.pair_id = b.pair_id AND b.x = a.x + p AND b.y = a.y + q AND b.z = a.z + r),
 t AS (SELECT pair_id, i, j FROM e UNION SELECT t.pair_id, t.i, e.j FROM t JOIN e ON t.pair_id = e.pair_id AND t.j = e.i), l AS (SELECT pair_id, i, min(j) AS c FROM t GROUP BY pair_id, i)
 SELECT pair_id, count(*) AS n_components, max(n) AS largest FROM (SELECT pair_id, c, count(*) AS n FROM l GROUP BY pair_id, c) GROUP BY pair_id"""))
def gra1(s, d):
    return grid.component_counts(fixture(s, d, "fx_voxels"), 32)


@query("chk1_5_cell_checks", _vox("SELECT pair_id, count(*) AS n_cells, count(*) BETWEEN 100 AND 40000 AS count_ok, min(least(x, y, z)) >= 0 AND max(greatest(x, y, z)) < 64 AS coords_ok, max(abs(f1)) > 50 AS too_large, round(stddev_pop(f0), 6) AS spread FROM fx_voxels GROUP BY pair_id"))
def chk1(s, d):
    v = fixture(s, d, "fx_voxels")
    n = F.count(F.lit(1))
    return v.groupBy("pair_id").agg(n.alias("n_cells"), n.between(100, 40000).alias("count_ok"), ((F.min(F.least("x", "y", "z")) >= 0) & (F.max(F.greatest("x", "y", "z")) < 64)).alias("coords_ok"), (F.max(F.abs("f1")) > 50).alias("too_large"), F.round(F.stddev_pop("f0"), 6).alias("spread"))


@query("met1_2_bounding_boxes", _vox("SELECT pair_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1, round(sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2) + pow(max(z) - min(z), 2)), 6) AS diagonal, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz FROM fx_voxels WHERE in_after = 1 GROUP BY pair_id"))
def met1(s, d):
    v = fixture(s, d, "fx_voxels").where("in_after = 1")
    ends = [f(a).alias(f"{a}{i}") for a in "xyz" for i, f in enumerate((F.min, F.max))]
    length = sum((F.pow(F.max(a) - F.min(a), F.lit(2)) for a in "xyz"), F.lit(0.0))
    centre = [((F.min(a) + F.max(a)) / 2).alias(f"c{a}") for a in "xyz"]
    return v.groupBy("pair_id").agg(*ends, F.round(F.sqrt(length), 6).alias("diagonal"), *centre)
