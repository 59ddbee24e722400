"""Inputs derived from the driver's tables, by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pairloom.session import table

SQL = {
    "fx_edits": """SELECT 'o' || CAST(l_orderkey AS STRING) AS obj_id, lpad(CAST(l_orderkey % 10 AS STRING), 2, '0') AS shard,
       CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) - 1 AS INT) AS edit_idx,
       CASE l_partkey % 9 WHEN 0 THEN 'deletion' WHEN 1 THEN 'modification' WHEN 2 THEN 'scale' WHEN 3 THEN 'material' WHEN 4 THEN 'color' WHEN 5 THEN 'global' WHEN 6 THEN 'deletion' WHEN 7 THEN 'identity' ELSE 'addition' END AS edit_type,
       CAST(l_partkey % 20 AS INT) AS pid1, CAST(l_suppkey % 20 AS INT) AS pid2,
       CASE l_linenumber % 7 WHEN 0 THEN 'Remove the ' || p_name || ' from the base' WHEN 1 THEN 'Add a ' || p_name WHEN 2 THEN 'Replace the ' || p_name WHEN 3 THEN 'Carefully remove the ' || p_name || ' from it' WHEN 4 THEN 'go' WHEN 5 THEN 'Get rid of the ' || p_name ELSE 'Make the ' || p_name || ' taller' END AS prompt,
       CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE p_name END AS target_part_desc, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'new ' || p_name END AS after_desc, l_discount * 10 AS factor
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fx_parts": "SELECT DISTINCT 'o' || CAST(l_orderkey AS STRING) AS obj_id, CAST(l_partkey % 20 AS INT) AS part_id FROM lineitem WHERE l_linenumber % 4 <> 0",
    "fx_stage_events": """SELECT 'u' || CAST(user_id AS STRING) AS obj_id,
       CASE event_id % 3 WHEN 0 THEN 'del_u' WHEN 1 THEN 'mod_u' ELSE 'add_u' END || CAST(user_id AS STRING) || '_00' || CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS STRING) AS edit_id,
       CASE event_type WHEN 'signup' THEN 'gate_a' WHEN 'click' THEN 's4' WHEN 'view' THEN 's5' WHEN 'purchase' THEN 'gate_e' ELSE 'gate_c' END AS stage,
       CASE WHEN event_type IN ('click', 'view') THEN CASE WHEN value < 80 THEN 'done' ELSE 'error' END WHEN event_id % 17 = 0 THEN 'deferred' WHEN value < 60 THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 5 AS INT) END AS best_view, CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value / 500, 4) END AS score, ts, event_id AS seq FROM events""",
    "fx_voxels": """SELECT l_orderkey % 48 AS pair_id, CAST(l_partkey % 32 AS INT) AS x, CAST((l_suppkey * 5 + l_linenumber) % 32 AS INT) AS y, CAST(l_quantity AS INT) % 32 AS z,
       CAST(min(l_suppkey % 8) AS INT) AS part_id, max(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS in_before, max(CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END) AS in_after,
       min(l_quantity) AS f0, min(l_extendedprice) AS f1, min(l_discount) AS f2, min(l_tax) AS f3 FROM lineitem
       GROUP BY l_orderkey % 48, CAST(l_partkey % 32 AS INT), CAST((l_suppkey * 5 + l_linenumber) % 32 AS INT), CAST(l_quantity AS INT) % 32""",
    "fx_judge": """SELECT d.doc_id AS edit_no, CASE d.doc_id % 6 WHEN 0 THEN 'deletion' WHEN 1 THEN 'modification' WHEN 2 THEN 'scale' WHEN 3 THEN 'material' WHEN 4 THEN 'color' ELSE 'global' END AS edit_type,
       l.quality = 1 AS edit_executed, d.n_chars % 4 <> 0 AS correct_region, d.doc_id % 5 <> 0 AS preserve_other, CAST(1 + d.n_chars % 5 AS INT) AS visual_quality, l.toxic = 0 AS artifact_free,
       CAST(1 + d.n_chars % 6 AS INT) AS mesh_quality, CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE CAST(d.doc_id % 4 AS INT) END AS edit_strength FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "fx_plans": """SELECT obj_id, shard, edit_idx, edit_type, CASE WHEN pid1 % 13 = 0 OR (edit_type = 'global' AND pid1 % 3 <> 0) THEN NULL ELSE pid1 END AS pid1, CASE WHEN pid1 % 13 = 0 OR (edit_type = 'global' AND pid1 % 3 <> 0) THEN NULL ELSE pid2 END AS pid2,
       prompt, target_part_desc, after_desc, CASE WHEN pid2 % 4 = 0 THEN ' ' ELSE after_desc END AS new_part_desc, CASE WHEN pid1 % 7 = 6 THEN NULL ELSE pid1 % 7 END AS view_index, factor,
       CASE WHEN pid2 % 5 = 1 THEN NULL ELSE 'wood' END AS target_material, CASE WHEN pid2 % 5 = 2 THEN '' ELSE 'red' END AS target_color, CASE WHEN pid2 % 5 <> 3 THEN 'wax' END AS target_style FROM fx_edits""",
    "fx_gate_a": """SELECT obj_id, edit_idx, CASE (pid1 + edit_idx) % 5 WHEN 0 THEN 'fail' WHEN 1 THEN 'deferred' ELSE 'pass' END AS status,
       CASE WHEN (pid2 + edit_idx) % 6 = 0 THEN NULL ELSE (pid1 + pid2) % 6 END AS best_view FROM fx_edits WHERE (pid1 + pid2) % 11 <> 0""",
    "fx_assets": """SELECT obj_id, edit_id, min(seq) % 5 <> 0 AS has_before, max(seq) % 4 <> 0 AS has_after, count(*) % 6 <> 0 AS has_image,
       max(seq) % 3 <> 0 AS has_latent, CAST(max(seq) % 40 AS INT) AS n_rows, CAST(min(seq) % 40 AS INT) AS n_stored FROM fx_stage_events GROUP BY obj_id, edit_id""",
    "fx_verdicts": """SELECT obj_id, edit_id, stage AS gate, max_by(status, seq) AS status, max(seq) % 3 = 0 AS has_verdict, CASE WHEN max(seq) % 2 = 0 THEN max(seq) % 5 <> 0 END AS rule_pass,
       CASE max(seq) % 4 WHEN 0 THEN 'prompt_too_short' WHEN 2 THEN 'verb_conflict' END AS rule_code, CASE WHEN max(seq) % 7 <> 0 THEN max(seq) % 8 <> 1 END AS vlm_pass,
       CASE WHEN max(seq) % 9 <> 0 THEN 'reason ' || CAST(max(seq) % 50 AS STRING) END AS vlm_reason, CASE WHEN max(seq) % 6 = 0 THEN max(seq) % 12 = 0 END AS legacy_pass
       FROM fx_stage_events WHERE stage IN ('gate_a', 'gate_c', 'gate_e') GROUP BY obj_id, edit_id, stage""",
    "fx_sides": """SELECT pair_id, 0 AS side, x, y, z, part_id, f0 / 50 AS f0, f1 / 100000 AS f1, f2, f3 FROM fx_voxels WHERE in_before = 1 OR pair_id % 4 = 0
       UNION ALL SELECT pair_id, 1 AS side, x, y, z, part_id, f0 / 50 + (x % 4) * (pair_id % 3) / 10 AS f0, f1 / 100000 AS f1, f2, f3 FROM fx_voxels WHERE in_after = 1 OR pair_id % 4 = 0""",
    "fx_uneven": """SELECT * FROM fx_sides WHERE NOT (side = 0 AND pair_id % 9 = 4) AND NOT (side = 1 AND pair_id % 9 = 7)""",
    "fx_half": """SELECT pair_id, CAST(floor(x / 2) AS INT) AS x, CAST(floor(y / 2) AS INT) AS y, CAST(floor(z / 2) AS INT) AS z, max(in_before) AS in_before, max(in_after) AS in_after, min(part_id) AS part_id, min(f0) AS f0
       FROM fx_voxels GROUP BY pair_id, CAST(floor(x / 2) AS INT), CAST(floor(y / 2) AS INT), CAST(floor(z / 2) AS INT)""",
}
_INDEX = re.search(r"CAST\(ROW_NUMBER\(\).*? AS edit_idx", SQL["fx_edits"])[0]
_OBJECT = "'o' || CAST(l_orderkey AS STRING) AS obj_id"
#: What Spark reads for the same rows: an object's are dealt out by its id, once, so that steps that go by objects find them
#: together, and texts are put together afterwards.
_DEALT = {
    "fx_edits": SQL["fx_edits"].replace(_OBJECT, "obj_id").replace(_INDEX, "edit_idx")
    .replace("FROM lineitem JOIN part ON l_partkey = p_partkey", f"FROM (SELECT *, {_INDEX.replace('PARTITION BY l_orderkey', 'PARTITION BY obj_id')} FROM (SELECT *, {_OBJECT} FROM lineitem JOIN part ON l_partkey = p_partkey))"),
    "fx_parts": SQL["fx_parts"].replace("SELECT DISTINCT", "SELECT DISTINCT obj_id, part_id FROM (SELECT /*+ REPARTITION(obj_id) */") + ")",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def fixture(spark: SparkSession, sf_dir: str, name: str, tasks: int | None = None) -> DataFrame:
    """tasks: how many the edits are dealt out into by object, for what is written as it lies; else as many as shuffles have."""
    text = _DEALT.get(name, SQL[name])
    if tasks and name == "fx_edits":
        text = text.replace(f"(SELECT *, {_OBJECT}", f"(SELECT /*+ REPARTITION({tasks}, obj_id) */ *, {_OBJECT}")
    used = [t for t in (*TABLES, *SQL) if re.search(rf"(FROM|JOIN) {t}\b", text)]
    for t in used:
        text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: fixture(spark, sf_dir, t, tasks) if t in SQL else table(spark, sf_dir, t) for t in used})


def _needed(names: tuple[str, ...]) -> set[str]:
    below = {n for name in names for n in SQL if re.search(rf"(FROM|JOIN) {n}\b", SQL[name])}
    return set(names) | (_needed(tuple(below)) if below else set())


def with_fixtures(sql: str, *names: str) -> str:
    """DuckDB SQL that starts with the fixtures' common table expressions."""
    every = [n for n in SQL if n in _needed(names)]
    head = ", ".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in every)
    sql = sql.strip()
    recursive, sql = sql.upper().startswith("WITH RECURSIVE "), re.sub("^WITH RECURSIVE ", "WITH ", sql)
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {head} {sql}"
