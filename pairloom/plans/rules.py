"""Queries over rules, validation, specs and completeness of inputs."""

from __future__ import annotations

import io
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import edits, rules
from pairloom.plans.core import _IDS, _QUOTA
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import spread, stored, table
from pairloom.sources import containers


def _plans(s, d, tasks: int | None = None) -> DataFrame:
    pids = F.array_compact(F.array("pid1", "pid2"))
    return fixture(s, d, "fx_plans", tasks).withColumn("pids", pids)


def _pl(sql: str) -> str:
    return with_fixtures(sql, "fx_plans", "fx_parts")


_P = """WITH p AS (SELECT *, list_filter([pid1, pid2], lambda x: x IS NOT NULL) AS pids, lower(trim(prompt)) AS low FROM fx_plans), known AS (SELECT obj_id, list(part_id) AS known FROM fx_parts GROUP BY obj_id),
 k AS (SELECT p.*, len(list_filter(pids, lambda x: NOT list_contains(coalesce(known, []), x))) AS unknown FROM p LEFT JOIN known USING (obj_id)) """
_GEN = "('modification', 'scale', 'material', 'color', 'global')"
_HAS = lambda words: "(" + " OR ".join(f"contains(low, '{w}')" for w in words) + ")"
_CODES = f"""concat_ws(',', CASE WHEN length(low) < 8 THEN 'prompt_too_short' END, CASE WHEN edit_type NOT IN ('global', 'addition', 'identity') AND len(pids) = 0 THEN 'parts_missing' END,
 CASE WHEN edit_type NOT IN ('global', 'addition', 'identity') AND len(pids) > 0 AND unknown > 0 THEN 'parts_invalid' END, CASE WHEN edit_type = 'modification' AND trim(coalesce(new_part_desc, '')) = '' THEN 'new_desc_missing' END,
 CASE WHEN edit_type IN ('modification', 'scale', 'material', 'color') AND trim(coalesce(target_part_desc, '')) = '' THEN 'target_desc_missing' END,
 CASE WHEN edit_type = 'deletion' AND {_HAS(("add ", "insert ", "attach ", "put "))} OR edit_type IN {_GEN} AND {_HAS(("remove", "delete", "erase", "strip", "eliminate"))} AND NOT {_HAS(("replace", "swap", "change", "modify", "convert"))} THEN 'verb_conflict' END)"""


@query("flt1_rule_codes", _pl(_P + f"SELECT obj_id, edit_idx, {_CODES} AS codes FROM k"))
def flt1(s, d):
    return rules.rule_codes(_plans(s, d), fixture(s, d, "fx_parts")).select("obj_id", "edit_idx", F.array_join("codes", ",").alias("codes"))


_NO = lambda kind, c: f"CASE WHEN edit_type = '{kind}' AND coalesce({c}, '') = '' THEN 'no_{c}' END"
_PROBLEMS = f"""concat_ws(',', CASE WHEN edit_type IS NULL OR edit_type NOT IN ('deletion', 'modification', 'scale', 'material', 'color', 'global') THEN 'bad_type' END, CASE WHEN unknown > 0 THEN 'bad_parts' END, CASE WHEN edit_type = 'global' AND len(pids) > 0 THEN 'parts_of_global' END, CASE WHEN edit_type <> 'global' AND len(pids) = 0 THEN 'no_parts' END,
 CASE WHEN view_index < 0 OR view_index > 4 THEN 'bad_view' END, CASE WHEN edit_type <> 'deletion' AND coalesce(after_desc, '') = '' THEN 'no_after_desc' END, CASE WHEN edit_type = 'scale' AND NOT coalesce(factor BETWEEN 0.3 AND 0.85, false) THEN 'bad_factor' END,
 {_NO("modification", "new_part_desc")}, {_NO("material", "target_material")}, {_NO("color", "target_color")}, {_NO("global", "target_style")})"""
_WITH_PROBLEMS = _P + f", q AS (SELECT *, {_PROBLEMS} AS problems FROM k) "


def _problems(s, d) -> DataFrame:
    return rules.plan_problems(_plans(s, d), fixture(s, d, "fx_parts"))


@query("flt2_plan_problems", _pl(_WITH_PROBLEMS + "SELECT obj_id, edit_idx, problems FROM q"))
def flt2(s, d):
    return _problems(s, d).select("obj_id", "edit_idx", F.array_join("problems", ",").alias("problems"))


_AGAIN = "row_number() OVER (PARTITION BY obj_id, edit_type, list_sort(pids), problems = '' ORDER BY edit_idx) > 1 AND problems = '' AND edit_type <> 'global'"


@query("flt2_3_plan_report", _pl(_WITH_PROBLEMS + f""", a AS (SELECT *, {_AGAIN} AS again FROM q), n AS (SELECT obj_id, count(*) AS n_edits, count_if(problems = '') AS n_kept, count_if(again) AS n_repeated FROM a GROUP BY obj_id),
 t AS (SELECT obj_id, q_deletion + q_modification + q_scale + q_material + q_color + q_global AS quota FROM (SELECT obj_id, {_QUOTA} FROM (SELECT obj_id, count(*) AS n FROM fx_parts GROUP BY obj_id)))
 SELECT obj_id, n_edits, n_kept, n_repeated, n_kept >= greatest(1, floor(coalesce(quota, n_edits) * 7 / 10 + 1e-9)) AS ok FROM n LEFT JOIN t USING (obj_id)"""))
def flt2_report(s, d):
    n = fixture(s, d, "fx_parts").groupBy("obj_id").agg(F.count(F.lit(1)).alias("n"))
    quotas = n.select("obj_id", sum(edits.quota(F.col("n"), F.col("n") % 5 == 0).values(), F.lit(0)).alias("quota"))
    return rules.plan_report(_problems(s, d), quotas)


_SPECS = _IDS + ", specs AS (SELECT n.*, g.status, g.best_view FROM named n JOIN fx_gate_a g USING (obj_id, edit_idx) WHERE g.status NOT IN ('fail', 'deferred') AND g.best_view IS NOT NULL) "


def _sp(sql: str) -> str:
    return with_fixtures(sql, "fx_edits", "fx_gate_a", "fx_parts")


@query("flt5_generated_specs", _sp(_SPECS + f"SELECT obj_id, edit_id, edit_type, best_view FROM specs WHERE edit_type IN {_GEN}"))
def flt5(s, d):
    return rules.specs(fixture(s, d, "fx_edits"), fixture(s, d, "fx_gate_a")).select("obj_id", "edit_id", "edit_type", "best_view")


@query("flt4_6_specs_by_type", _sp(_SPECS + "SELECT obj_id, edit_id, edit_type, best_view FROM specs WHERE edit_type IN ('deletion', 'color')"))
def flt6(s, d):
    return rules.specs(fixture(s, d, "fx_edits"), fixture(s, d, "fx_gate_a"), ("deletion", "color", "scale"), "color, deletion ,nothing").select("obj_id", "edit_id", "edit_type", "best_view")


@query("joi1_spec_with_gate", _sp(_IDS + "SELECT edit_id, status, best_view FROM named LEFT JOIN fx_gate_a USING (obj_id, edit_idx)"))
def joi1(s, d):
    return edits.assign_ids(fixture(s, d, "fx_edits")).join(fixture(s, d, "fx_gate_a"), ["obj_id", "edit_idx"], "left").select("edit_id", "status", "best_view")


@query("key2_ids_for_reports", _sp(_IDS + "SELECT edit_id, prompt, target_part_desc FROM named"))
def key2(s, d):
    return edits.assign_ids(fixture(s, d, "fx_edits")).select("edit_id", "prompt", "target_part_desc")


_NAMES = "names AS (SELECT obj_id, part_id, CASE WHEN part_id % 4 = 0 THEN '' ELSE 'part ' || part_id END AS name FROM fx_parts)"
_DESCRIBED = (
    _SPECS
    + f""", {_NAMES}, described AS (SELECT s.obj_id, s.edit_id, s.edit_type, s.shard, s.prompt, s.pid1, coalesce(a.name, '') AS label1, coalesce(b.name, '') AS label2, coalesce(nullif(after_desc, ''), nullif(target_part_desc, ''), '') AS new_parts_desc, target_part_desc, best_view AS view
 FROM specs s LEFT JOIN names a ON a.obj_id = s.obj_id AND a.part_id = pid1 LEFT JOIN names b ON b.obj_id = s.obj_id AND b.part_id = pid2 WHERE best_view BETWEEN 0 AND 4) """
)


def _described(s, d) -> DataFrame:
    names = fixture(s, d, "fx_parts").withColumn("name", F.when(F.col("part_id") % 4 == 0, "").otherwise(F.concat(F.lit("part "), "part_id")))
    plan = fixture(s, d, "fx_edits").withColumn("pids", F.array("pid1", "pid2")).withColumn("new_part_desc", F.lit(""))
    found = rules.specs(plan, fixture(s, d, "fx_gate_a"), ("deletion", *edits.GENERATED)).where(F.col("best_view").between(0, 4))
    return rules.described(found, names)


@query("joi2_described_specs", _sp(_DESCRIBED + "SELECT edit_id, label1 || ',' || label2 AS labels, new_parts_desc, view FROM described"))
def joi2(s, d):
    return _described(s, d).select("edit_id", F.array_join("labels", ",").alias("labels"), "new_parts_desc", "view")


@query("txt13_flat_descriptor", _sp(_DESCRIBED + "SELECT edit_id, edit_type, obj_id, shard, pid1 AS old_part_id, label1 AS old_label, prompt AS edit_prompt, new_parts_desc AS after_desc, target_part_desc AS before_part_desc, view AS best_view FROM described"))
def txt13(s, d):
    return rules.flat_descriptor(_described(s, d)).select("edit_id", "edit_type", "obj_id", "shard", "old_part_id", "old_label", "edit_prompt", "after_desc", "before_part_desc", "best_view")


@query("flt14_visible_parts", "WITH px AS (SELECT l_orderkey % 500 AS obj_id, l_suppkey % 24 AS part_id, max(l_quantity - 20) AS px FROM lineitem GROUP BY ALL), n AS (SELECT obj_id, count_if(px >= 1) AS n_visible, count_if(px < 1) AS n_dropped FROM px GROUP BY obj_id) SELECT *, CASE WHEN n_visible + n_dropped > 16 THEN 'too_many_parts' WHEN n_visible = 0 THEN 'none_visible' END AS skip FROM n")
def flt14(s, d):
    px = table(s, d, "lineitem").select((F.col("l_orderkey") % 500).alias("obj_id"), (F.col("l_suppkey") % 24).alias("part_id"), F.col("l_linenumber").alias("view"), (F.col("l_quantity") - 20).alias("px"))
    return rules.visible_parts(px)


_LISTED = {"mesh": "o_orderkey % 5 <> 0", "image": "o_custkey % 4 <> 0", "slat": "o_orderkey % 7 <> 3"}


@query("flt16_missing_inputs", "SELECT o_orderkey AS obj_id, concat_ws(',', CASE WHEN NOT (o_custkey % 4 <> 0) THEN 'image' END, CASE WHEN o_orderkey % 5 = 0 THEN 'mesh' END, CASE WHEN o_orderkey % 7 = 3 THEN 'slat' END) AS missing, o_custkey % 4 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 3 AS complete FROM (SELECT o_orderkey, min(o_custkey) AS o_custkey FROM orders GROUP BY o_orderkey)")
def flt16(s, d):
    o = table(s, d, "orders").groupBy("o_orderkey").agg(F.min("o_custkey").alias("o_custkey")).withColumn("obj_id", F.col("o_orderkey"))
    return rules.missing_inputs(o, **{k: o.where(c) for k, c in _LISTED.items()}).withColumn("missing", F.array_join("missing", ","))


_COLUMNS = ("l_orderkey % 400 AS obj_id", "CASE l_linenumber % 4 WHEN 0 THEN 'full.glb' WHEN 1 THEN 'part_captions.json' WHEN 2 THEN 'vd_scale' ELSE 'anno_info.json' END AS member", "CAST(min(l_quantity) AS INT) - 1 AS n_bytes",
 """CASE WHEN min(l_suppkey) % 3 = 0 THEN '{"other": 1}' ELSE '{"parts": 1}' END AS json""")
_CONTENTS = f"SELECT {', '.join(_COLUMNS)} FROM lineitem WHERE l_partkey % 4 <> l_linenumber % 5 GROUP BY ALL"
_REPORT = f"""WITH c AS ({_CONTENTS}), r AS (SELECT obj_id, concat_ws(',', CASE WHEN count_if(member = 'full.glb') = 0 THEN 'missing full.glb' END, CASE WHEN count_if(member = 'part_captions.json') = 0 THEN 'missing part_captions.json' END, CASE WHEN count_if(member = 'vd_scale') = 0 THEN 'missing vd_scale' END,
 max('empty full.glb') FILTER (member = 'full.glb' AND n_bytes <= 0), max('empty part_captions.json') FILTER (member = 'part_captions.json' AND n_bytes <= 0), max('empty vd_scale') FILTER (member = 'vd_scale' AND n_bytes <= 0),
 max('part_captions.json lacks parts') FILTER (member = 'part_captions.json' AND n_bytes > 0 AND NOT contains(json, 'parts'))) AS errors, CASE WHEN count_if(member = 'anno_info.json') = 0 THEN 'missing anno_info.json' ELSE '' END AS warnings FROM c GROUP BY obj_id),
 v AS (SELECT *, CASE WHEN errors <> '' THEN 'FAIL' WHEN warnings <> '' THEN 'WARN' ELSE 'PASS' END AS verdict FROM r) """


def _report(s, d) -> DataFrame:
    made = [c.rpartition(" AS ") for c in _COLUMNS]
    items = table(s, d, "lineitem").where("l_partkey % 4 <> l_linenumber % 5")
    return rules.container_report(items.groupBy(*[F.expr(c).alias(n) for c, _, n in made[:2]]).agg(*[F.expr(c).alias(n) for c, _, n in made[2:]]))


@query("flt17_container_report", _REPORT + "SELECT * FROM v")
def flt17(s, d):
    return _report(s, d).withColumn("errors", F.array_join("errors", ",")).withColumn("warnings", F.array_join("warnings", ","))


@query("agg21_batch_totals", _REPORT + "SELECT verdict, count(*) AS n FROM v GROUP BY verdict")
def agg21(s, d):
    return rules.batch_totals(_report(s, d))


_SCENES = """CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '{"offset": [1, 2, 3]}' WHEN 2 THEN '{"scale": 1.5, "offset": [1, 2]}' WHEN 3 THEN '{"scale": 0, "offset": [1, 2, 3]}' WHEN 4 THEN '{"scale": "x", "offset": [1, 2, 3]}'
 WHEN 5 THEN '{"scale": 2, "offset": [1, "y", 3]}' ELSE '{"scale": 2.5, "offset": [0.5, -1, 3]}' END AS transforms"""


@query("flt19_scene_errors", "SELECT DISTINCT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'transforms.json is missing' WHEN 1 THEN 'scale or offset is missing' WHEN 2 THEN 'offset isn''t of length 3' WHEN 3 THEN 'scale isn''t positive' WHEN 4 THEN 'scale isn''t a number' WHEN 5 THEN 'offset isn''t numbers' END AS error FROM orders")
def flt19(s, d):
    scenes = table(s, d, "orders").selectExpr("o_orderkey", _SCENES)
    return scenes.select("o_orderkey", rules.scene_error(F.col("transforms")).alias("error")).distinct()


def _packed(rows: DataFrame, pack) -> DataFrame:
    """path, content: containers that a function makes of each row."""

    def run(frames):
        for f in frames:
            made = [pack(r) for r in f.itertuples(index=False)]
            yield pd.DataFrame({"path": [m[0] for m in made], "content": [m[1] for m in made]})

    return stored(spread(rows).mapInPandas(run, "path string, content binary"))


def _npz(members: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{k: np.frombuffer(v, np.uint8) if isinstance(v, bytes) else np.asarray(v) for k, v in members.items()})
    return out.getvalue()


def _mesh_container(row) -> tuple[str, bytes]:
    """By the number of a customer something is missing, empty or wrong."""
    k = int(row.c_custkey)
    members = {"vd_offset": [0.5, 1, 2][: 2 if k % 8 == 1 else 3], "vd_scale": [1.0, 2.0] if k % 6 == 0 else [-1.0] if k % 6 == 1 else [2.5]}
    members |= {} if k % 7 == 0 else {"full.ply": b"" if k % 7 == 1 else b"mesh"}
    members |= {} if k % 5 == 0 else {"part_0.glb": b"" if k % 5 == 1 else b"part", "part_12.glb": b"part"}
    anno = {"bboxes": [1], "ordered_faceid": [1], "ordered_face_label": [1]}
    members |= {} if k % 4 == 0 else {"anno_info.json": b"{" if k % 4 == 2 else json.dumps({x: v for x, v in anno.items() if k % 4 != 1 or x != "bboxes"}).encode()}
    members |= {} if k % 3 == 0 else {"part_captions.json": b"{}" if k % 3 == 1 else b'{"0": "lid"}'}
    if k % 8 == 0:
        del members["vd_offset"]
    return f"/objects/{k}.npz", b"no container" if k % 50 == 0 else _npz(members)


@query("flt17_content_report", """SELECT '/objects/' || c_custkey || '.npz' AS path, CASE WHEN c_custkey % 50 = 0 THEN 'unreadable' ELSE concat_ws(',', CASE c_custkey % 7 WHEN 0 THEN 'missing full mesh' WHEN 1 THEN 'empty full mesh' END, CASE WHEN c_custkey % 5 = 0 THEN 'no parts' END,
 CASE c_custkey % 4 WHEN 0 THEN 'missing anno_info.json' WHEN 1 THEN 'anno_info.json lacks bboxes' WHEN 2 THEN 'anno_info.json: not JSON' END, CASE WHEN c_custkey % 6 = 0 THEN 'vd_scale isn''t of shape [1]' END,
 CASE c_custkey % 8 WHEN 0 THEN 'missing vd_offset' WHEN 1 THEN 'vd_offset isn''t of shape [3]' END, CASE WHEN c_custkey % 6 = 1 THEN 'vd_scale isn''t positive' END) END AS errors,
 CASE WHEN c_custkey % 50 = 0 THEN '' ELSE concat_ws(',', CASE WHEN c_custkey % 5 = 1 THEN 'empty parts' END, CASE c_custkey % 3 WHEN 0 THEN 'missing part_captions.json' WHEN 1 THEN 'empty part_captions.json' END) END AS warnings FROM customer""")
def flt17_contents(s, d):
    made = containers.contents(_packed(table(s, d, "customer").select("c_custkey"), _mesh_container))
    return rules.content_report(made).select("path", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


def _latent_files(s, d) -> DataFrame:
    """A container for each pair, with coordinates of three or four columns; every fifth lacks its features."""

    def pack(r):
        coords = np.stack([np.asarray(r.x), np.asarray(r.y), np.asarray(r.z)], axis=1).astype(np.int32)
        coords = coords if r.pair_id % 2 else np.insert(coords, 0, 0, axis=1)
        feats = {} if r.pair_id % 5 == 0 else {"slat_feats": np.asarray(r.f0, np.float32)[:, None] * [1, 2]}
        return f"/out/mod_o{r.pair_id}_003/after.npz", _npz({"slat_coords": coords, **feats, "ss": np.full((1, 2, 2), r.pair_id)})

    lists = [F.collect_list(c).alias(c) for c in ("x", "y", "z", "f0")]  # cells of a small grid
    return _packed(fixture(s, d, "fx_half").groupBy("pair_id").agg(*lists), pack)


@query("src6_latent_cells", with_fixtures("SELECT 'o' || pair_id AS obj_id, 'mod_o' || pair_id || '_003' AS edit_id, 'after' AS role, x, y, z, f0 * 2 AS f1 FROM fx_half WHERE pair_id % 5 <> 0 UNION ALL SELECT DISTINCT 'o' || pair_id, 'mod_o' || pair_id || '_003', 'error', NULL, NULL, NULL, NULL FROM fx_half WHERE pair_id % 5 = 0", "fx_half"))
def src6(s, d):
    c = containers.latent_cells(_latent_files(s, d))
    return c.select("obj_id", "edit_id", F.when(F.col("error").isNotNull(), "error").otherwise(F.col("role")).alias("role"), "x", "y", "z", F.col("feats")[1].cast("double").alias("f1"))


@query("src6_dense_latents", with_fixtures("SELECT DISTINCT 'o' || pair_id AS obj_id, CASE WHEN pair_id % 5 <> 0 THEN '1,2,2' END AS shape, CASE WHEN pair_id % 5 <> 0 THEN pair_id * 4.0::DOUBLE END AS total FROM fx_half", "fx_half"))
def src6_dense(s, d):
    total = F.aggregate("ss", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return containers.dense_latents(_latent_files(s, d)).select("obj_id", F.array_join("shape", ",").alias("shape"), total.alias("total"))
