"""Queries over instructions, promotion, export rows and the work that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import choice, edits, grid, release
from pairloom.plans.choice import _SEEN, _seen
from pairloom.plans.core import _IDS, _LATEST, _VERBS, _state
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored

_GEN = "('modification', 'scale', 'material', 'color', 'global')"
_INVERSE = f"CASE WHEN p = '' THEN '' WHEN instr(o, ' from ') > 0 THEN substr(o, 1, instr(o, ' from ') - 1) || ' to ' || substr(o, instr(o, ' from ') + 6) ELSE o END"
_INVERTED = f"inv AS (SELECT prompt AS src, {_INVERSE} AS inverse FROM (SELECT prompt, p, CASE {_VERBS} ELSE 'Add back ' || p END AS o FROM (SELECT DISTINCT prompt, trim(prompt) AS p FROM fx_edits)))"


def _ed(sql: str) -> str:
    return with_fixtures(sql, "fx_edits")


def _named(s, d) -> DataFrame:
    """Plans with ids, under the columns that instructions are made of."""
    e = edits.assign_ids(fixture(s, d, "fx_edits")).withColumn("pids", F.array("pid1", "pid2"))
    params = F.when(F.col("edit_type") == "scale", F.create_map(F.lit("size"), F.col("pid1").cast("string")))
    return e.withColumn("object_desc", F.concat(F.lit("object "), "obj_id")).withColumn("new_parts_desc", F.when(F.col("pid1") % 3 == 0, F.col("after_desc"))).withColumn("params", params)


_INSTR = (
    _IDS
    + f""", own AS (SELECT obj_id, edit_id, prompt, 'object ' || obj_id AS object_desc, target_part_desc, CASE WHEN edit_type = 'modification' THEN coalesce(CASE WHEN pid1 % 3 = 0 THEN nullif(after_desc, '') END, nullif(target_part_desc, ''), '') END AS new_parts_desc,
 CASE WHEN edit_type IN {_GEN} THEN nullif(after_desc, '') END AS after_desc, CASE WHEN edit_type = 'scale' THEN CAST(pid1 AS VARCHAR) END AS size, CAST(NULL AS BOOLEAN) AS synthesized FROM named), {_INVERTED},
 instr AS (SELECT * FROM own UNION ALL SELECT obj_id, 'add_' || substr(edit_id, 5), inverse, object_desc, target_part_desc, NULL, NULL, NULL, true FROM own JOIN inv ON src = prompt WHERE starts_with(edit_id, 'del_')) """
)


@query("txt2_3_instructions", _ed(_INSTR + "SELECT * FROM instr"))
def txt2(s, d):
    i = release.instructions(_named(s, d))
    return i.select("obj_id", "edit_id", "instruction.prompt", "instruction.object_desc", "instruction.target_part_desc", "instruction.new_parts_desc", "instruction.after_desc", F.col("instruction.edit_params")["size"].alias("size"), "instruction.synthesized")


@query("joi20_backfilled_additions", _ed(_IDS + f""", {_INVERTED} SELECT obj_id, 'add_' || substr(edit_id, 5) AS edit_id, inverse AS prompt, pid1, edit_id AS source_del_id, 'inverse of ' || edit_id AS rationale FROM named JOIN inv ON src = prompt WHERE edit_type = 'deletion' AND NOT (pid1 % 3 = 0)"""))
def joi20(s, d):
    n = _named(s, d).where("edit_type = 'deletion'")
    have = n.where("pid1 % 3 = 0").select(edits.paired_id(F.col("edit_id")).alias("edit_id"))
    return release.backfilled_additions(n, have).select("obj_id", "edit_id", "prompt", F.col("pids")[0].alias("pid1"), "source_del_id", "rationale")


@query("exp2_addition_prompts", _ed(_IDS + f""", {_INVERTED} SELECT 'add_' || substr(edit_id, 5) AS edit_id, CASE WHEN pid2 % 4 = 0 THEN 'own ' || pid2 ELSE inverse END AS prompt FROM named JOIN inv ON src = prompt WHERE edit_type = 'deletion'"""))
def exp2(s, d):
    n = _named(s, d).where("edit_type = 'deletion'")
    add = n.select(edits.paired_id(F.col("edit_id")).alias("edit_id"), "pid2")
    own = add.select("edit_id", F.when(F.col("pid2") % 4 == 0, F.concat(F.lit("own "), F.col("pid2").cast("string"))).otherwise("").alias("prompt"))
    return release.addition_instructions(add, own, n)


@query("exp3_mirrored_pairs", _ed(_IDS + f""", {_INVERTED} SELECT obj_id, edit_id, prompt, obj_id AS before, edit_id AS after FROM named WHERE edit_type = 'deletion' UNION ALL SELECT obj_id, 'add_' || substr(edit_id, 5), inverse, edit_id, obj_id FROM named JOIN inv ON src = prompt WHERE edit_type = 'deletion'"""))
def exp3(s, d):
    n = _named(s, d).where("edit_type = 'deletion'").withColumn("full", F.col("obj_id")).withColumn("reduced", F.col("edit_id"))
    return release.mirrored(n).drop("pids")


@query("snk6_pair_records", _ed(_IDS + "SELECT edit_id, edit_type, obj_id, shard, prompt, target_part_desc AS before_desc, after_desc, 'pairs/' || edit_type || '/' || shard || '/' || obj_id || '/' || edit_id || '/before.npz' AS before_path, 'pairs/' || edit_type || '/' || shard || '/' || obj_id || '/' || edit_id || '/after.npz' AS after_path FROM named"))
def snk6(s, d):
    return release.pair_records(_named(s, d))


@query("snk6_training_records", _ed(_IDS + """, q AS (SELECT edit_id, CASE WHEN pid1 % 2 = 0 THEN 'high' ELSE 'low' END AS tier, pid1 / 20 AS score, pid2 % 2 = 0 AS fine FROM named WHERE pid1 % 3 <> 0)
 SELECT edit_id, edit_type, prompt AS instruction, '' AS instruction_variants, obj_id AS source_obj_id, shard AS source_shard, CAST(NULL AS VARCHAR) AS donor_obj_id, CASE WHEN edit_type IN ('deletion', 'modification') THEN pid1 || ',' || pid2 ELSE '' END AS removed_part_ids,
 CASE WHEN edit_type IN ('addition', 'modification') THEN pid1 || ',' || pid2 ELSE '' END AS added_part_ids, target_part_desc AS old_part_label, '' AS new_part_label, 'object ' || obj_id AS object_desc, prompt AS edit_prompt, after_desc,
 coalesce(tier, '') AS quality_tier, coalesce(score, 0) AS quality_score, coalesce(CASE WHEN fine THEN 'fine=true' ELSE CASE WHEN q.edit_id IS NOT NULL THEN 'fine=false' END END, '') AS quality_checks, 'out/meshes/' || edit_id || '_before.ply' AS before_mesh, 'out/meshes/' || edit_id || '_after.ply' AS after_mesh FROM named LEFT JOIN q USING (edit_id)"""))
def snk6_records(s, d):
    n = _named(s, d).withColumn("object_desc", F.concat(F.lit("object "), "obj_id")).withColumn("pids", F.array("pid1", "pid2")).withColumn("new_part_desc", F.lit(None).cast("string"))
    q = n.where("pid1 % 3 <> 0").select("obj_id", "edit_id", F.when(F.col("pid1") % 2 == 0, "high").otherwise("low").alias("tier"), (F.col("pid1") / 20).alias("score"), F.create_map(F.lit("fine"), F.col("pid2") % 2 == 0).alias("checks"))
    r = release.training_records(n, q, "out/")
    checks = F.array_join(F.transform(F.map_entries("quality_checks"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return r.withColumns({k: F.array_join(k, ",") for k in ("instruction_variants", "removed_part_ids", "added_part_ids")} | {"quality_checks": checks})


@query("snk4_layout", _ed(_IDS + "SELECT edit_id, edit_type || '/' || shard || '/' || obj_id || '/' || edit_id AS path FROM named"))
def snk4(s, d):
    return _named(s, d).select("edit_id", release.layout_path().alias("path"))


@query("exp4_surviving_cells", with_fixtures("WITH c AS (SELECT pair_id, count_if(part_id NOT IN (pair_id % 8, 3)) AS n_left FROM fx_voxels GROUP BY pair_id) SELECT pair_id, n_left, n_left = 0 AS rejected FROM c", "fx_voxels"))
def exp4(s, d):
    v = fixture(s, d, "fx_voxels")
    parts = v.select("pair_id").distinct().select("pair_id", F.array((F.col("pair_id") % 8).cast("int"), F.lit(3)).alias("pids"))
    return release.surviving_cells(v, parts, "pair_id")[1]


def _as(sql: str) -> str:
    return with_fixtures(sql, "fx_assets", "fx_stage_events")


_SOURCE = "source AS (SELECT obj_id, coalesce(min(edit_id) FILTER (has_before AND starts_with(edit_id, 'mod_')), CASE WHEN bool_or(has_latent) THEN 'latent' END) AS source FROM fx_assets WHERE obj_id <> 'u5' GROUP BY obj_id)"


def _assets(s, d) -> DataFrame:
    """One object has no assets at all."""
    return fixture(s, d, "fx_assets")


def _sources(s, d) -> DataFrame:
    return release.object_assets(_assets(s, d).where("obj_id <> 'u5'"))


@query("key10_object_assets", _as(f"WITH {_SOURCE} SELECT * FROM source"))
def key10(s, d):
    return _sources(s, d)


@query("joi9_after_sides", _as("""SELECT a.obj_id, a.edit_id, CASE WHEN b.has_after THEN b.edit_id END AS after_of, CASE WHEN b.has_after THEN NULL WHEN starts_with(a.edit_id, 'add_') THEN 'no after of del_' || substr(a.edit_id, 5) ELSE 'no after' END AS reason
 FROM fx_assets a LEFT JOIN fx_assets b ON b.edit_id = CASE WHEN starts_with(a.edit_id, 'add_') THEN 'del_' || substr(a.edit_id, 5) ELSE a.edit_id END"""))
def joi9(s, d):
    return release.after_sides(_assets(s, d))


_PROMOTED = (
    _LATEST
    + _SEEN
    + f""", {_SOURCE}, views AS (SELECT e.obj_id, e.edit_id, coalesce(a.best_view, p.best_view, CASE WHEN NOT starts_with(e.edit_id, 'mod_') THEN 4 END) AS view FROM (SELECT DISTINCT obj_id, edit_id FROM latest) e LEFT JOIN valid a ON a.stage = 'gate_a' AND a.edit_id = e.edit_id
 LEFT JOIN valid p ON p.stage = 'gate_a' AND starts_with(e.edit_id, 'add_') AND p.edit_id = 'del_' || substr(e.edit_id, 5)),
 j AS (SELECT v.obj_id, v.edit_id, view, source, has_before, has_after, has_image FROM views v JOIN fx_assets USING (edit_id) LEFT JOIN source s ON s.obj_id = v.obj_id),
 one AS (SELECT *, CASE WHEN starts_with(edit_id, 'del_') THEN CASE WHEN NOT has_after THEN 'no after' WHEN source IS NULL THEN 'no asset of the object' END WHEN starts_with(edit_id, 'mod_') THEN CASE WHEN NOT has_before THEN 'no before' WHEN NOT has_after THEN 'no after' WHEN source IS NULL THEN 'no asset of the object' WHEN view IS NULL THEN 'no view' END END AS why FROM j),
 two AS (SELECT o.*, CASE WHEN starts_with(o.edit_id, 'add_') THEN CASE WHEN d.edit_id IS NULL THEN 'its deletion is not promoted' WHEN o.source IS NULL THEN 'no asset of the object' WHEN NOT d.has_image THEN 'no image of its deletion' END ELSE o.why END AS reason
  FROM one o LEFT JOIN one d ON starts_with(o.edit_id, 'add_') AND d.edit_id = 'del_' || substr(o.edit_id, 5) AND d.why IS NULL) """
)


def _promoted(s, d) -> DataFrame:
    views = choice.resolved_views(_seen(_state(s, d)))
    flags = _assets(s, d).select("edit_id", "has_before", "has_after", "has_image")
    return release.promoted(views.join(flags, "edit_id").join(_sources(s, d), "obj_id", "left"))


@query("joi10_12_promotion", _as(_PROMOTED + "SELECT obj_id, edit_id, view, reason, reason IS NULL AS ok FROM two"))
def joi10(s, d):
    return _promoted(s, d).select("obj_id", "edit_id", "view", "reason", "ok")


@query("exp1_5_release_records", _as(_PROMOTED + """SELECT obj_id, edit_id, CASE edit_id[1:3] WHEN 'del' THEN 'deletion' WHEN 'add' THEN 'addition' ELSE 'modification' END AS edit_type, 3 AS schema_version, view AS best_view_index, '' AS prompt,
 NOT EXISTS (SELECT 1 FROM latest f WHERE f.edit_id = two.edit_id AND starts_with(f.stage, 'gate') AND f.status = 'fail') AS final_pass, 'v3' AS pipeline_version FROM two WHERE reason IS NULL"""))
def exp1(s, d):
    none = release.instructions(_named(s, d).limit(0))
    r = release.base_records(_promoted(s, d), none, choice.quality_block(_state(s, d)))
    return r.select("obj_id", "edit_id", "edit_type", "schema_version", "views.best_view_index", F.coalesce("instruction.prompt", F.lit("")).alias("prompt"), "quality.final_pass", "lineage.pipeline_version")


@query("snk5_promotion_log", _as(_PROMOTED + "SELECT edit_id, CASE edit_id[1:3] WHEN 'del' THEN 'deletion' WHEN 'add' THEN 'addition' ELSE 'modification' END AS edit_type, 'then' AS promoted_at, 3 AS schema_version, 'v3' AS pipeline_version FROM two WHERE reason IS NULL"))
def snk5(s, d):
    return release.promotion_log(_promoted(s, d), F.lit("then"))


@query("joi14_preview_slots", _as("""WITH v AS (SELECT obj_id, edit_id, CASE WHEN max(seq) % 3 <> 0 THEN CAST(max(seq) % 8 AS INT) END AS verdict_view, CASE WHEN max(seq) % 5 <> 0 THEN CAST(max(seq) % 7 - 1 AS INT) END AS legacy_view FROM fx_stage_events GROUP BY obj_id, edit_id),
 o AS (SELECT obj_id, edit_id, coalesce(CASE WHEN verdict_view BETWEEN 0 AND 4 THEN verdict_view END, CASE WHEN legacy_view BETWEEN 0 AND 4 THEN legacy_view END) AS own FROM v)
 SELECT o.obj_id, o.edit_id, coalesce(o.own, p.own, 4) AS slot FROM o LEFT JOIN o p ON starts_with(o.edit_id, 'add_') AND p.edit_id = 'del_' || substr(o.edit_id, 5)"""))
def joi14(s, d):
    last = F.max("seq")
    v = fixture(s, d, "fx_stage_events").groupBy("obj_id", "edit_id").agg(F.when(last % 3 != 0, (last % 8).cast("int")).alias("verdict_view"), F.when(last % 5 != 0, (last % 7 - 1).cast("int")).alias("legacy_view"))
    return choice.preview_slots(v)


@query("joi16_merged_results", _as("SELECT edit_id, obj_id, round(n_rows / 40, 6) AS score FROM fx_assets WHERE n_rows >= 20"))
def joi16(s, d):
    a = _assets(s, d)
    return release.merged_results(a.select("edit_id", "obj_id"), a.select("edit_id", F.round(F.col("n_rows") / 40, 6).alias("score")), 0.5).select("edit_id", "obj_id", "score")


_SIDES = "shown AS (SELECT DISTINCT edit_id, CAST(seq % 5 AS INT) AS view FROM fx_stage_events WHERE seq % 3 = 0), made AS (SELECT DISTINCT edit_id, CAST(seq % 5 AS INT) AS view FROM fx_stage_events WHERE seq % 2 = 0)"


_SAID = """said AS (SELECT edit_id, CASE WHEN k % 4 <> 0 THEN 'do ' || k END AS original, CASE WHEN k % 3 = 0 THEN 'better ' || k WHEN k % 3 = 1 THEN '' END AS improved, k % 6 AS visual_quality, CASE WHEN k % 5 <> 0 THEN 'since ' || k END AS reason
 FROM (SELECT edit_id, max(seq) AS k FROM fx_stage_events WHERE stage = 'gate_e' GROUP BY edit_id) WHERE k % 7 <> 0)"""


@query("joi18_gallery", _as(_LATEST + f""", {_SIDES}, {_SAID}, e AS (SELECT l.obj_id, l.edit_id, l.score, a.best_view AS own FROM latest l LEFT JOIN latest a ON a.edit_id = l.edit_id AND a.stage = 'gate_a' WHERE l.stage = 'gate_e' AND l.status = 'pass'),
 w AS (SELECT e.*, v.view, CASE WHEN v.view = own THEN 0 WHEN v.view = 2 THEN 1 ELSE 2 + v.view END AS place FROM e JOIN shown v USING (edit_id) JOIN made m ON m.edit_id = e.edit_id AND m.view = v.view),
 b AS (SELECT obj_id[-1:] AS shard, obj_id, edit_id, arg_min(view, place) AS view, coalesce(arg_min(view, place) = max(own), false) AS matched, max(score) AS score FROM w GROUP BY ALL),
 n AS (SELECT *, CAST(row_number() OVER (PARTITION BY shard ORDER BY edit_id) AS INT) AS nth FROM b)
 SELECT n.*, coalesce(nullif(improved, ''), original, '') AS prompt, coalesce(original, '') AS original, visual_quality, coalesce(reason, '') AS description FROM n LEFT JOIN said USING (edit_id) WHERE nth <= 6"""))
def joi18(s, d):
    events, k = fixture(s, d, "fx_stage_events"), F.col("k")
    views = lambda c: events.where(c).select("edit_id", (F.col("seq") % 5).cast("int").alias("view"))
    state = _state(s, d).withColumn("shard", F.right("obj_id", F.lit(1)))
    said = events.where("stage = 'gate_e'").groupBy("edit_id").agg(F.max("seq").alias("k")).where("k % 7 <> 0")
    text = lambda start: F.concat(F.lit(start), k)
    said = said.select("edit_id", F.when(k % 4 != 0, text("do ")).alias("original"), F.when(k % 3 == 0, text("better ")).when(k % 3 == 1, "").alias("improved"), (k % 6).alias("visual_quality"), F.when(k % 5 != 0, text("since ")).alias("reason"))
    return release.gallery(state, views("seq % 3 = 0"), views("seq % 2 = 0"), 2, 6, judged=said)


@query("joi19_repaste_list", _as(_LATEST + """SELECT edit_id, a.best_view AS view, CASE WHEN n_rows <> n_stored THEN 'rows differ: ' || n_rows || ', ' || n_stored END AS error FROM fx_assets JOIN latest e USING (edit_id) JOIN latest a USING (edit_id)
 WHERE e.stage = 'gate_e' AND e.status = 'pass' AND a.stage = 'gate_a' AND a.best_view IS NOT NULL AND has_latent AND n_rows % 4 <> 0"""))
def joi19(s, d):
    state = _state(s, d).groupBy("edit_id").agg(F.max(F.when(F.col("stage") == "gate_e", F.col("status"))).alias("e"), F.max(F.when(F.col("stage") == "gate_a", F.col("best_view"))).alias("view"))
    a = _assets(s, d)
    return release.repaste_list(a, state.where("e = 'pass'"), a.where("n_rows % 4 = 0"))


@query("joi22_repaste_rows", _as("SELECT edit_id, n_rows AS tokens, n_stored AS preserved, CASE WHEN n_rows % 3 = 0 THEN 'better ' || n_rows WHEN n_rows % 3 = 1 THEN 'old' ELSE '' END AS prompt FROM fx_assets"))
def joi22(s, d):
    a = _assets(s, d)
    third = F.col("n_rows") % 3
    prompts = a.where("n_rows % 3 < 2").select("edit_id", F.when(third == 0, F.concat(F.lit("better "), "n_rows")).otherwise("").alias("improved"), F.lit("old").alias("original"))
    return release.repaste_rows(a.select("edit_id", F.col("n_rows").alias("tokens"), F.col("n_stored").alias("preserved")), prompts)


_FILES = ("after.npz", "before.npz", "mask.npz")
_LIST = "listing AS (SELECT edit_id, f.file, (n_rows + f.i) % 9 AS size FROM fx_assets, (VALUES (1, 'after.npz'), (2, 'before.npz'), (3, 'mask.npz')) f(i, file) WHERE (n_stored + f.i) % 11 <> 0)"


def _listing(s, d) -> DataFrame:
    files = F.posexplode(F.array(*map(F.lit, _FILES))).alias("i", "file")
    return _assets(s, d).select("edit_id", "n_rows", "n_stored", files).where((F.col("n_stored") + F.col("i") + 1) % 11 != 0).select("edit_id", "file", ((F.col("n_rows") + F.col("i") + 1) % 9).alias("size"))


@query("joi23_pending_pairs", _as(f"""WITH {_LIST}, del AS (SELECT obj_id, edit_id FROM fx_assets WHERE starts_with(edit_id, 'del_')), need AS (SELECT obj_id, edit_id FROM del UNION ALL SELECT obj_id, 'add_' || substr(edit_id, 5) FROM del)
 SELECT DISTINCT obj_id FROM need WHERE (SELECT count(*) FROM listing l WHERE l.edit_id = need.edit_id AND size > 0) < 3"""))
def joi23(s, d):
    return release.pending_pairs(_assets(s, d).where("edit_id LIKE 'del\\\\_%'"), _listing(s, d), _FILES)


@query("joi21_lacking_prerequisite", _as(_LATEST + "SELECT DISTINCT obj_id FROM latest WHERE stage = 'gate_a' AND status = 'pass' AND starts_with(edit_id, 'mod_') AND obj_id NOT IN (SELECT obj_id FROM fx_assets WHERE n_rows > 36)"))
def joi21(s, d):
    a, passed = _assets(s, d), _state(s, d).where("stage = 'gate_a' AND status = 'pass'")
    return release.lacking_prerequisite(a.where(F.col("edit_id").startswith("mod_")), passed, a.where("n_rows > 36"))


@query("agg14_product_coverage", _as(f"""WITH {_LIST}, need AS (SELECT obj_id, edit_id, f AS file FROM fx_assets, (SELECT unnest(['after.npz', 'mask.npz']) AS f)), j AS (SELECT n.*, l.size > 0 AS ok FROM need n LEFT JOIN listing l USING (edit_id, file))
 SELECT obj_id, count(*) AS expected, count_if(ok) AS found, array_to_string(list_sort(list(edit_id || '/' || file) FILTER (NOT coalesce(ok, false)))[1:10], ',') AS missing, count(*) = count_if(ok) AS ok FROM j GROUP BY obj_id"""))
def agg14(s, d):
    r = release.product_coverage(_assets(s, d), ("after.npz", "mask.npz"), _listing(s, d))
    return r.withColumn("missing", F.when(F.size("missing") > 0, F.array_join("missing", ",")))


@query("flt15_mask_rows", _ed(_IDS + """SELECT edit_id, edit_type, pid1 * 10 AS n_cells FROM (SELECT *, row_number() OVER (PARTITION BY edit_type ORDER BY edit_id) AS n FROM named WHERE edit_type <> 'global' AND pid2 % 3 > 0 AND pid1 * 10 >= 50 AND pid1 % 2 = 0) WHERE n <= 40 ORDER BY edit_id LIMIT 100"""))
def flt15(s, d):
    n = _named(s, d)
    e = n.select("edit_id", "edit_type", (F.col("pid2") % 3).alias("n_parts"))
    return release.mask_rows(e, n.select("edit_id", (F.col("pid1") * 10).alias("n_cells")), 50, 40, 100, n.where("pid1 % 2 = 0")).select("edit_id", "edit_type", "n_cells")


@query("src8_lim3_resolved_objects", _as("SELECT obj_id FROM (SELECT obj_id FROM fx_assets WHERE n_rows > 30 UNION SELECT obj_id FROM fx_stage_events WHERE seq % 5 = 0) ORDER BY obj_id LIMIT 40"))
def src8(s, d):
    return release.resolved_objects(_assets(s, d).where("n_rows > 30"), fixture(s, d, "fx_stage_events").where("seq % 5 = 0"), limit=40)


@query("src7_object_index", _as("SELECT DISTINCT a.obj_id[-1:] AS shard, a.obj_id FROM fx_assets a JOIN fx_assets b ON a.obj_id = b.obj_id WHERE a.n_rows > 35 AND b.n_stored > 35"))
def src7(s, d):
    a = _assets(s, d).withColumn("shard", F.right("obj_id", F.lit(1)))
    return release.object_index(a.where("n_rows > 35"), a.where("n_stored > 35"))


@query("vox12_repaste_features", with_fixtures("""WITH reg AS (SELECT DISTINCT pair_id, x, y, z FROM fx_sides WHERE part_id = 3), b AS (SELECT * FROM fx_sides WHERE side = 0), a AS (SELECT * FROM fx_sides WHERE side = 1),
 j AS (SELECT a.pair_id, a.x, a.y, a.z, CASE WHEN b.pair_id IS NOT NULL AND r.pair_id IS NULL THEN b.f0 ELSE a.f0 END AS f0, b.pair_id IS NOT NULL AND r.pair_id IS NULL AS kept FROM a LEFT JOIN b USING (pair_id, x, y, z) LEFT JOIN reg r ON r.pair_id = a.pair_id AND r.x = a.x AND r.y = a.y AND r.z = a.z)
 SELECT pair_id, count_if(kept) AS n_preserved, count(*) AS n_total, round(sum(f0), 4) AS f0 FROM j GROUP BY pair_id""", "fx_sides"))
def vox12(s, d):
    sides = stored(fixture(s, d, "fx_sides"))
    region = sides.where("part_id = 3").select(*grid.CELL).distinct()
    p = grid.repasted(sides.where("side = 0"), sides.where("side = 1"), region, ["f0", "f1", "f2", "f3"])
    return p.groupBy("pair_id").agg(F.count_if("preserved").alias("n_preserved"), F.count(F.lit(1)).alias("n_total"), F.round(F.sum("f0"), 4).alias("f0"))
