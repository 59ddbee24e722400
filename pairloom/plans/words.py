"""Queries over texts of edits and meshes: names, slots, requests, merged settings, mesh metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import settings, texts
from pairloom.operators import checks, choice, meshes
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored, table

_CAPTIONS = "[CASE WHEN p_partkey % 3 = 0 THEN '  ' ELSE ' A  the  ' || p_name || '.' END, CASE WHEN p_partkey % 5 <> 0 THEN p_type || '   x' ELSE '' END]"


def _captions():
    first = F.when(F.col("p_partkey") % 3 == 0, "  ").otherwise(F.concat(F.lit(" A  the  "), "p_name", F.lit(".")))
    return F.array(first, F.when(F.col("p_partkey") % 5 != 0, F.concat("p_type", F.lit("   x"))).otherwise(""))


@query("txt7_part_labels", f"SELECT p_partkey, list_filter(list_transform({_CAPTIONS}, lambda c: trim(regexp_replace(c, '\\s+', ' ', 'g'))), lambda c: c <> '')[1] AS label FROM part")
def txt7(s, d):
    return table(s, d, "part").select("p_partkey", texts.part_label(_captions()).alias("label"))


@query("txt8_part_names", """WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'the ' || p_name || '.' END AS cap, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a view of the ' || p_type || '._12' WHEN 2 THEN 'An ' || p_type || '.' ELSE p_name END AS raw FROM part)
 SELECT p_partkey, CASE WHEN cap <> '' THEN cap[5:-2] WHEN p_partkey % 4 = 0 THEN 'part_' || p_partkey WHEN p_partkey % 4 = 1 THEN raw[15:-5] WHEN p_partkey % 4 = 2 THEN raw[4:-2] ELSE raw END AS name FROM n""")
def txt8(s, d):
    k = F.col("p_partkey")
    cap = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("the "), "p_name", F.lit(".")))
    raw = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("a view of the "), "p_type", F.lit("._12"))).when(k % 4 == 2, F.concat(F.lit("An "), "p_type", F.lit("."))).otherwise(F.col("p_name"))
    return table(s, d, "part").select("p_partkey", texts.part_name(F.array(cap), raw, k).alias("name"))


def _strip(text: str, words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    marks = texts._MARKS.replace("'", "''")
    return f"trim(replace(replace(array_to_string(list_filter(regexp_split_to_array(trim(regexp_replace({text}, '\\s+', ' ', 'g')), ' '), lambda t: lower(trim(t, '{marks}')) NOT IN ({listed})), ' '), ' ,', ','), ' .', '.'))"


_DESC = "'A Round, ' || p_name || ' (red)  part with glossy , large ' || p_type || ' .'"


@query("txt9_structure_and_appearance", f"SELECT p_partkey, {_strip(_DESC, texts.APPEARANCE)} AS structure, {_strip(_DESC, texts.STRUCTURE)} AS appearance FROM part")
def txt9(s, d):
    text = F.concat(F.lit("A Round, "), "p_name", F.lit(" (red)  part with glossy , large "), "p_type", F.lit(" ."))
    return table(s, d, "part").select("p_partkey", texts.structure(text).alias("structure"), texts.appearance(text).alias("appearance"))


_SPEC = "p AS (SELECT *, 'a red round ' || obj_id AS whole, CASE WHEN pid1 % 5 = 0 THEN 'Global' WHEN edit_type IN ('material', 'color', 'global') THEN 'TextureOnly' WHEN edit_type = 'deletion' THEN 'Deletion' WHEN edit_type = 'addition' THEN 'Addition' ELSE 'Modification' END AS eff FROM fx_edits)"
_LIFT = "eff = 'Global' AND edit_type <> 'global'"


@query("txt10_prompt_slots", with_fixtures(f"""WITH {_SPEC}, q AS (SELECT *, CASE WHEN {_LIFT} THEN whole ELSE coalesce(nullif(after_desc, ''), whole) END AS new_cpl, CASE WHEN {_LIFT} THEN whole ELSE coalesce(nullif(after_desc, ''), target_part_desc) END AS target_part, CASE WHEN {_LIFT} THEN whole ELSE target_part_desc END AS bp FROM p)
 SELECT obj_id, edit_idx, eff AS effective_type, target_part, new_cpl, CASE WHEN {_LIFT} OR pid2 % 2 = 0 THEN {_strip("whole", texts.APPEARANCE)} ELSE 'given' END AS ori_s1_cpl, {_strip("new_cpl", texts.STRUCTURE)} AS new_s2_cpl, {_strip("bp", texts.APPEARANCE)} AS ori_s1_part FROM q""", "fx_edits"))
def txt10(s, d):
    empty = ("object_desc_s2", "after_desc_s1", "after_desc_s2", "new_parts_desc_s1", "new_parts_desc_s2")
    e = fixture(s, d, "fx_edits").withColumn("object_desc", F.concat(F.lit("a red round "), "obj_id")).withColumn("new_parts_desc", F.col("after_desc")).withColumn("object_desc_s1", F.when(F.col("pid2") % 2 == 0, "").otherwise("given")).withColumns({c: F.lit(None).cast("string") for c in empty})
    slots = e.select("obj_id", "edit_idx", *texts.prompt_slots(F.when(F.col("pid1") % 5 == 0, "Global").otherwise(choice.executed_as(F.col("edit_type")))))
    return slots.select("obj_id", "edit_idx", "effective_type", "target_part", "new_cpl", "ori_s1_cpl", "new_s2_cpl", "ori_s1_part")


@query("txt11_judge_requests", with_fixtures("""SELECT obj_id, edit_idx, concat_ws(chr(10), 'edit_type: ' || edit_type, 'Object: ' || obj_id, 'Edit instruction: "' || prompt || '"', 'Target part: ' || coalesce('part ' || pid1, ''), CASE WHEN target_part_desc <> '' THEN 'Target part description (before): "' || target_part_desc || '"' END,
 CASE WHEN edit_type = 'modification' AND coalesce(new_part_desc, '') <> '' THEN 'Expected shape after: "' || new_part_desc || '"' WHEN edit_type = 'scale' AND factor IS NOT NULL THEN 'Scale factor (shrink): ' || factor WHEN edit_type = 'material' AND target_material <> '' THEN 'Expected material/finish: "' || target_material || '"' WHEN edit_type = 'color' AND target_color <> '' THEN 'Expected colour: "' || target_color || '"'
 WHEN edit_type = 'global' AND target_style <> '' THEN 'Expected style: "' || target_style || '"' END) AS request FROM fx_plans""", "fx_plans"))
def txt11(s, d):
    p = fixture(s, d, "fx_plans")
    return p.withColumn("object_desc", F.col("obj_id")).withColumn("label", F.concat(F.lit("part "), "pid1")).select("obj_id", "edit_idx", texts.judge_request().alias("request"))


_TEMPLATES = {"deletion": "Take {label} out: {prompt}", "global": "All over: {prompt}", "": "{prompt} ({label}, then {after})"}


@query("txt12_filled_requests", with_fixtures("SELECT obj_id, edit_idx, CASE edit_type WHEN 'deletion' THEN 'Take part ' || pid1 || ' out: ' || prompt WHEN 'global' THEN 'All over: ' || prompt ELSE prompt || ' (part ' || pid1 || ', then ' || after_desc || ')' END AS request FROM fx_edits", "fx_edits"))
def txt12(s, d):
    slots = {"label": F.concat(F.lit("part "), F.col("pid1").cast("string")), "prompt": F.col("prompt"), "after": F.col("after_desc")}
    return fixture(s, d, "fx_edits").select("obj_id", "edit_idx", texts.filled(_TEMPLATES, F.col("edit_type"), **slots).alias("request"))


@query("mat6_merged_thresholds", with_fixtures("SELECT edit_no, visual_quality >= CASE edit_type WHEN 'scale' THEN 4 WHEN 'color' THEN 2 ELSE 3 END AS ok FROM fx_judge", "fx_judge"))
def mat6(s, d):
    """Thresholds by type from nested settings, joined as a small table."""
    base = {t: {"min_visual_quality": 3, "other": 1} for t in ("deletion", "modification", "scale", "material", "color", "global")}
    limits = settings.as_table(s, settings.merged(base, {"scale": {"min_visual_quality": 4}, "color": {"min_visual_quality": 2}})).where("name = 'min_visual_quality'")
    return fixture(s, d, "fx_judge").join(F.broadcast(limits.withColumnRenamed("kind", "edit_type")), "edit_type").select("edit_no", (F.col("visual_quality") >= F.col("value")).alias("ok"))


_CORNERS = """corners AS (SELECT pair_id, side, (x * 1024 + y * 32 + z) AS face, k.range::INT AS k, x + CASE WHEN k.range = 1 THEN 1 ELSE 0 END + f0 / 100 AS vx, y + CASE WHEN k.range = 2 THEN 1 ELSE 0 END AS vy, z + 0 AS vz FROM fx_sides, range(3) k)"""


def _triangles(s, d) -> DataFrame:
    """A triangle for each cell: its corner and the next ones along x and y, moved a little by a feature."""
    cells = stored(fixture(s, d, "fx_sides").select("pair_id", "side", "x", "y", "z", "f0"))  # what follows reads them often, and the input once
    v = cells.select("pair_id", "side", (F.col("x") * 1024 + F.col("y") * 32 + F.col("z")).alias("face"), "x", "y", "z", "f0", F.explode(F.array(*map(F.lit, range(3)))).alias("k"))
    return v.select("pair_id", "side", "face", "k", (F.col("x") + F.when(F.col("k") == 1, 1).otherwise(0) + F.col("f0") / 100).alias("vx"), (F.col("y") + F.when(F.col("k") == 2, 1).otherwise(0)).alias("vy"), F.col("z").alias("vz"))


_MESH = f"""{_CORNERS}, v AS (SELECT DISTINCT pair_id, side, round(vx, 4) AS vx, vy, vz FROM corners), n AS (SELECT pair_id, count_if(side = 0) AS nb, count_if(side = 1) AS na FROM v GROUP BY pair_id),
 twin AS (SELECT pair_id, vx, vy, vz, count_if(side = 0) AS b, count_if(side = 1) AS a FROM v GROUP BY ALL), diff AS (SELECT pair_id, count_if(a <> b) AS apart FROM twin GROUP BY pair_id),
 tri AS (SELECT pair_id, side, face, arg_min(vx, k) AS x0, max(vx) FILTER (k = 1) AS x1, max(vx) FILTER (k = 2) AS x2, arg_min(vy, k) AS y0, max(vy) FILTER (k = 1) AS y1, max(vy) FILTER (k = 2) AS y2 FROM corners GROUP BY ALL),
 area AS (SELECT pair_id, sum(abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2) FILTER (side = 0) AS ab, sum(abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2) FILTER (side = 1) AS aa FROM tri GROUP BY pair_id)"""


@query("msh1_mesh_pair_metrics", with_fixtures(f"WITH {_MESH} SELECT pair_id, nb AS n_before, na AS n_after, round(apart / greatest(nb, na), 6) AS edit_ratio, round(aa / ab, 5) AS area_ratio FROM n JOIN diff USING (pair_id) JOIN area USING (pair_id)", "fx_sides"))
def msh1(s, d):
    m = meshes.pair_metrics(_triangles(s, d))
    return m.select("pair_id", "n_before", "n_after", F.round("edit_ratio", 6).alias("edit_ratio"), F.round("area_ratio", 5).alias("area_ratio"))


_BOX = "b AS (SELECT pair_id, side, " + ", ".join(f"{f}({a}) AS {n}_{a}" for a in ("vx", "vy", "vz") for f, n in (("min", "lo"), ("max", "hi"))) + " FROM corners GROUP BY ALL)"
_EXT = [f"(hi_{a} - lo_{a})" for a in ("vx", "vy", "vz")]
_COMMON = " * ".join(f"greatest(least(p.hi_{a}, q.hi_{a}) - greatest(p.lo_{a}, q.lo_{a}), 0)" for a in ("vx", "vy", "vz"))
_DRIFTED = "sqrt(" + " + ".join(f"pow((q.lo_{a} + q.hi_{a} - p.lo_{a} - p.hi_{a}) / 2, 2)" for a in ("vx", "vy", "vz")) + ")"
_MESH_ALL = f"""{_MESH}, {_BOX}, e AS (SELECT *, {" * ".join(_EXT)} AS volume, sqrt({" + ".join(f"pow({x}, 2)" for x in _EXT)}) AS diagonal, least({", ".join(_EXT)}) AS thin FROM b),
 boxes AS (SELECT p.pair_id, q.volume / p.volume AS volume_ratio, ({_COMMON}) / (p.volume + q.volume - {_COMMON}) AS iou, {_DRIFTED} / p.diagonal AS drift, least(p.thin, q.thin) AS thin FROM e p JOIN e q ON p.pair_id = q.pair_id AND p.side = 0 AND q.side = 1),
 f AS (SELECT pair_id, count(DISTINCT face) FILTER (side = 0) AS fb, count(DISTINCT face) FILTER (side = 1) AS fa, count(DISTINCT (vx, vy, vz)) FILTER (side = 0) AS vb, count(DISTINCT (vx, vy, vz)) FILTER (side = 1) AS va FROM corners GROUP BY pair_id),
 w AS (SELECT pair_id, face, round(vx, 4) || '/' || vy || '/' || vz AS v FROM corners WHERE side = 1), link AS (SELECT DISTINCT a.pair_id, a.v AS i, b.v AS j FROM w a JOIN w b ON a.pair_id = b.pair_id AND a.face = b.face),
 touch AS (SELECT pair_id, i, j FROM link UNION SELECT t.pair_id, t.i, l.j FROM touch t JOIN link l ON t.pair_id = l.pair_id AND t.j = l.i), comps AS (SELECT pair_id, count(DISTINCT c) AS comps FROM (SELECT pair_id, i, min(j) AS c FROM touch GROUP BY ALL) GROUP BY pair_id),
 m AS (SELECT * FROM n JOIN diff USING (pair_id) JOIN area USING (pair_id) JOIN boxes USING (pair_id) JOIN f USING (pair_id) JOIN comps USING (pair_id)),
 r AS (SELECT pair_id, 'volume_ratio' AS name, volume_ratio AS value, volume_ratio BETWEEN 0.05 AND 20 AS passed, 1.5::DOUBLE AS weight FROM m UNION ALL SELECT pair_id, 'surface_area_ratio', aa / ab, aa / ab BETWEEN 0.1 AND 8, 1 FROM m
 UNION ALL SELECT pair_id, 'edit_ratio', apart / greatest(nb, na), apart / greatest(nb, na) BETWEEN 0.001 AND 1, 2 FROM m UNION ALL SELECT pair_id, 'part_proportion', abs(fb - fa) / greatest(fb, fa), abs(fb - fa) / greatest(fb, fa) BETWEEN 0.005 AND 0.8, 1.5 FROM m
 UNION ALL SELECT pair_id, 'connected_components', comps, comps <= 5, 1 FROM m UNION ALL SELECT pair_id, 'has_geometry', least(vb, va), least(vb, va) >= 50, 2 FROM m UNION ALL SELECT pair_id, 'not_degenerate', CASE WHEN thin < 1e-4 THEN thin ELSE 1 END, thin >= 1e-4, 1 FROM m
 UNION ALL SELECT pair_id, 'center_drift', drift, drift < 0.3, 1 FROM m UNION ALL SELECT pair_id, 'vertex_color', 1, true, 0.5 FROM m UNION ALL SELECT pair_id, 'bbox_overlap', iou, iou >= 0.1, 1 FROM m)"""


def _mesh_checks(s, d) -> DataFrame:
    return meshes.mesh_checks(_triangles(s, d).withColumns({"r": (F.col("face") % 200).cast("int"), "g": F.lit(0), "b": F.lit(0)}))


@query("msh1_mesh_checks", with_fixtures(f"WITH RECURSIVE {_MESH_ALL} SELECT pair_id, name, round(value, 5) AS value, passed, weight FROM r", "fx_sides"))
def msh1_checks(s, d):
    return _mesh_checks(s, d).select("pair_id", "name", F.round("value", 5).alias("value"), "passed", "weight")


_SWAP = """x AS (SELECT pair_id, greatest(max(x) FILTER (side = 0) - min(x) FILTER (side = 0), max(y) FILTER (side = 0) - min(y) FILTER (side = 0), max(z) FILTER (side = 0) - min(z) FILTER (side = 0)) AS db,
 greatest(max(x) FILTER (side = 1) - min(x) FILTER (side = 1), max(y) FILTER (side = 1) - min(y) FILTER (side = 1), max(z) FILTER (side = 1) - min(z) FILTER (side = 1)) AS da, max(greatest(x, y, z)) AS ext FROM fx_sides GROUP BY pair_id)"""


def _swapped(s, d) -> tuple[DataFrame, DataFrame]:
    v = fixture(s, d, "fx_sides").select("pair_id", "side", F.col("x").alias("vx"), F.col("y").alias("vy"), F.col("z").alias("vz"))
    return v, v.groupBy("pair_id").agg(F.max(F.greatest("vx", "vy", "vz")).alias("extent")).withColumn("gap", F.col("pair_id") / 100)


@query("msh2_swap_metrics", with_fixtures(f"WITH {_SWAP} SELECT pair_id, round(greatest(da / db, db / da), 6) AS scale_match, greatest(da / db, db / da) <= 3 AS scale_ok, round(pair_id / 100 / ext, 6) AS gap_share, pair_id / 100 / ext <= 0.15 AS gap_ok FROM x", "fx_sides"))
def msh2(s, d):
    return meshes.swap_metrics(*_swapped(s, d)).select("pair_id", F.round("scale_match", 6).alias("scale_match"), "scale_ok", F.round("gap_share", 6).alias("gap_share"), "gap_ok")


@query("msh2_rescored_swaps", with_fixtures(f"""WITH RECURSIVE {_MESH_ALL}, {_SWAP}, every AS (SELECT pair_id, passed, weight FROM r UNION ALL SELECT pair_id, greatest(da / db, db / da) <= 3, 1.5 FROM x UNION ALL SELECT pair_id, pair_id / 100 / ext <= 0.15, 1.5 FROM x)
 SELECT pair_id, round_even(coalesce(sum(weight) FILTER (passed), 0) / sum(weight), 4) AS score, bool_and(passed) AS passed FROM every GROUP BY pair_id""", "fx_sides"))
def msh2_rescored(s, d):
    return checks.score_of(_mesh_checks(s, d).union(meshes.swap_checks(*_swapped(s, d))), "pair_id").select("pair_id", "score", "passed")
