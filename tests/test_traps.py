"""Cases by hand where the rules are easy to get wrong."""

import io
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import replies, settings, texts
from pairloom.operators import checks, choice, distance, edits, graph, grid, judging, neighbours, release, rules, state, status
from pairloom.sources import containers, snapshots, states
from pairloom.streaming import progress

EVENTS = "obj_id string, edit_id string, stage string, status string, best_view int, score double, ts timestamp, seq long"


def events(spark, *rows):
    """rows: edit_id, stage, status and, if given, best_view, score, minute."""
    made = [("o", r[0], r[1], r[2], *(list(r[3:5]) + [None] * 2)[:2], (r[5] if len(r) > 5 else i), i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(made, EVENTS.replace("ts timestamp", "m int"))
    return df.withColumn("ts", F.timestamp_seconds(F.col("m") * 60)).select("obj_id", "edit_id", "stage", "status", "best_view", "score", "ts", "seq")


def one(df):
    return df.first()[0]


def value(spark, column, *rows, schema):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(column).collect()]


def test_prompts_are_inverted_verb_by_verb(spark):
    want = {
        "Remove the lid from the pot": "Add the lid to the pot",
        "Removed the lid": "Addd the lid",
        "Delete the box and take away the lid": "Delete the box and add the lid",
        "  get rid of it from a from b ": "Add it to a from b",
        "Please erase the line": "Please add the line",
        "Make it red": "Add back Make it red",
        "   ": "",
        "": "",
        None: None,
    }
    assert value(spark, edits.invert_prompt(F.col("p")), *[(p,) for p in want], schema="p string") == list(want.values())


def test_unknown_prefixes_and_nameless_shards_are_errors(spark):
    assert value(spark, edits.type_of(F.col("i")), ("del_o_000",), (None,), schema="i string") == ["deletion", None]
    assert value(spark, edits.normal_shard(F.col("s")), (" 7 ",), ("123",), schema="s string") == ["07", "123"]
    for column, rows, schema in ((edits.type_of(F.col("i")), [("zzz_o_001",)], "i string"), (edits.normal_shard(F.col("s")), [("  ",)], "s string"), (edits.normal_shard(F.col("s")), [(None,)], "s string")):
        with pytest.raises(Exception, match="prefix|no name"):
            value(spark, column, *rows, schema=schema)


def test_additions_skip_gate_a_and_no_other(spark):
    st = state.latest(events(spark, ("add_o_000", "gate_c", "fail"), ("add_o_001", "s4", "done"), ("mod_o_000", "gate_a", "pass"), ("mod_o_000", "gate_c", "pass"), ("mod_o_000", "s5", "done"), ("mod_o_001", "gate_c", "pass"), ("mod_o_001", "s5", "error"), ("mod_o_002", "gate_c", "pass"), ("mod_o_002", "s5", None)))
    due = lambda *a, **k: {r.edit_id for r in state.needs_stage(st, *a, **k).collect()}
    assert due("s5", "gate_c") == {"mod_o_001"}
    assert due("s5", "gate_a") == {"add_o_000", "add_o_001"}
    assert due("s5", "gate_c", force=True) == {"mod_o_000", "mod_o_001", "mod_o_002"}
    assert due("s4", None) == {"add_o_000", "mod_o_000", "mod_o_001", "mod_o_002"}
    assert state.prerequisites({"gate_2d", "sq1"}) == {"s4": "gate_a", "s5": "gate_c", "s5b": "gate_a", "s6p": "gate_a", "s6b": None}


def test_slots_of_previews(spark):
    """A view of its own, none, one out of range, one of the deletion, none anywhere."""
    rows = [("o", "mod_o_000", 2, None), ("o", "mod_o_001", None, None), ("o", "mod_o_002", 99, 1), ("o", "add_o_003", None, None), ("o", "del_o_003", 1, 3), ("o", "add_o_004", None, 7), ("p", "add_p_005", None, 0)]
    found = {r.edit_id: r.slot for r in choice.preview_slots(spark.createDataFrame(rows, "obj_id string, edit_id string, verdict_view int, legacy_view int")).collect()}
    assert found == {"mod_o_000": 2, "mod_o_001": 4, "mod_o_002": 1, "add_o_003": 1, "del_o_003": 1, "add_o_004": 4, "add_p_005": 0}


def test_scene_errors(spark):
    cases = {'{"scale": 1.5, "offset": [0, 1, 2.5]}': None, None: "missing", '{"offset": [0, 1, 2]}': "scale or offset", '{"scale": 1, "offset": [0, 1]}': "length 3", '{"scale": 0, "offset": [0, 1, 2]}': "positive", '{"scale": "a", "offset": [0, 1, 2]}': "a number", '{"scale": 1, "offset": ["a", 1, 2]}': "numbers"}
    found = value(spark, rules.scene_error(F.col("t")), *[(c,) for c in cases], schema="t string")
    assert all((w is None) == (g is None) and (w is None or w in g) for w, g in zip(cases.values(), found, strict=True))


def test_colour_edits_have_no_checker(spark):
    e = spark.createDataFrame([(1, "color"), (1, "identity")], "pair_id long, edit_type string")
    m = spark.createDataFrame([(1, "voxel_count_close", 1.0, 0.0, 0.0), (1, "feat_change", 0.5, 0.5, 0.5), (1, "identity_valid", 1.0, 1.0, 1.0)], "pair_id long, metric string, value double, lowest double, highest double")
    t = checks.threshold_table(spark)
    found = lambda **k: {(r.edit_type, r.name, r.passed) for r in checks.check_pairs(e, m, t, **k).collect()}
    assert found() == {("color", "unknown_type", False), ("identity", "identity_valid", True)}
    assert found(color_as="material") == {("color", "voxel_count_close", True), ("color", "feat_change", True), ("identity", "identity_valid", True)}
    other = checks.threshold_table(spark, {"material": {"feat_change": (0.6, 2.0)}})
    assert ("color", "feat_change", False) in {(r.edit_type, r.name, r.passed) for r in checks.check_pairs(e, m, other, color_as="material").collect()}


def test_cleaning_case_by_case(spark):
    kinds = {1: "scale", 2: "scale", 3: "scale", 4: "identity", 5: "identity", 6: "scale", 7: "scale", 8: "color", 9: "scale"}
    e = spark.createDataFrame(list(kinds.items()), "pair_id long, edit_type string")
    schema = "pair_id long, place int, name string, value double, passed boolean, weight double"
    fine = lambda i: (i, 0, "a", 0.0, True, 1.0)
    bad = lambda i: [(i, 0, "a", 0.0, False, 1.0), (i, 1, "b", 0.0, True, 3.0)]
    first = spark.createDataFrame([*bad(1), fine(2), *bad(6), fine(7), fine(8), fine(9)], schema)
    originals = spark.createDataFrame([fine(1), fine(2), fine(3), *bad(4), fine(8), *bad(9)], schema)
    second = spark.createDataFrame([(i, kinds[i], 0, "v", 0.0, ok, 1.0) for i, ok in ((1, True), (2, False), (4, True), (8, False), (9, True))], schema.replace("place", "edit_type string, place"))
    found = {r.pair_id: (r.score, r.tier, r.reason) for r in checks.clean_edits(e, first, second, originals).collect()}
    assert found == {
        1: (0.375, "rejected", "Layer1 failed: a"), 2: (0.5, "negative", "Layer2 failed: v"), 3: (0.0, "rejected", "no edited side"),
        4: (0.5, "negative", None), 5: (1.0, "high", None),  # an identity whose original fails, one without an original
        6: (0.375, "rejected", "Layer1 failed: a"), 7: (0.0, "rejected", "no original"),  # without an original, and unsound or sound
        8: (0.5, "negative", "Layer2 failed: v"), 9: (1.0, "high", None),  # only an identity's original is looked at
    }


def test_migrating_twice_changes_nothing(spark):
    verdict = "struct<rule:struct<pass:boolean,code:string>,vlm:struct<pass:boolean,score:double>>"
    fine, bad, none = (None, (True, 0.8)), ((False, "short"), (True, 0.4)), (None, None)
    rows = [
        ("o", "a", 2, {"gate_a": ("fail", None, 7), "s4": ("done", None, 8)}, {"A": fine, "C": bad, "E": none}, True, None),
        ("o", "b", 3, {"gate_e": ("pass", fine, 1)}, None, None, None), ("o", "c", None, None, None, None, None), ("p", "d", 3, {"gate_e": ("pass", fine, 1)}, None, None, "E"),
        ("p", "e", 3, {"gate_e": (None, fine, 1)}, {"E": bad}, None, None), ("q", "f", 3, None, {}, None, None), ("r", "g", 3, None, None, None, None),
    ]
    r = spark.createDataFrame(rows, f"obj_id string, edit_id string, schema_version int, stages map<string,struct<status:string,verdict:{verdict},ts:int>>, gates map<string,{verdict}>, final_pass boolean, fail_gate string")
    plain = lambda v: v if v is None else (v.rule and tuple(v.rule), v.vlm and tuple(v.vlm))
    of = lambda df: {x.edit_id: ({k: (v.status, plain(v.verdict), v.ts) for k, v in x.stages.items()}, x.changed) for x in df.collect()}
    once = status.migrated(r)
    got = of(once)
    assert got == {
        "a": ({"s4": ("done", None, 8), "gate_a": ("fail", fine, 7), "gate_c": ("fail", bad, None)}, True),  # a status that is there stays; an empty verdict goes
        "b": ({"gate_e": ("pass", fine, 1)}, False), "c": ({}, True), "d": ({"gate_e": ("pass", fine, 1)}, True),
        "e": ({"gate_e": ("fail", bad, 1)}, True), "f": ({}, True), "g": ({}, False),
    }
    again = status.migrated(once.drop("changed").withColumn("gates", F.lit(None).cast(r.schema["gates"].dataType)))
    assert of(again) == {k: (v, False) for k, (v, _) in got.items()}
    counts = status.migration_counts(once, spark.createDataFrame([("x",), ("x",)], "obj_id string"))
    assert tuple(counts.first()) == (5, 3, 1, 1)


def test_transition_leaves_what_exclude_names_only_where_it_is_occupied(spark):
    cells = lambda *x: spark.createDataFrame([(1, i, 0, 0) for i in x], "pair_id int, x int, y int, z int")
    found = grid.transition(cells(0, 1), cells(3), cells(0, 1, 2, 4), 3, 16, cells(1, 2, 3))
    assert sorted(r.x for r in found.collect()) == [0, 1, 3, 4]  # 1 is of the region, 3 is preserved, 2 goes
    assert sorted(r.x for r in grid.transition(cells(0), cells(), cells(1, 2, 3), 2, 16).collect()) == [0, 1, 2]


def test_gallery_prompts_and_the_view_that_the_gate_matched(spark):
    state = spark.createDataFrame([(e, g, "pass", v, s) for e, v in (("a", 3), ("b", 9), ("c", None), ("d", 1)) for g, s in (("gate_a", None), ("gate_e", 0.8))], "edit_id string, stage string, status string, best_view int, score double")
    state = state.withColumn("obj_id", F.lit("o")).withColumn("shard", F.lit("0"))
    views = spark.createDataFrame([("a", 3), ("a", 2), ("b", 4), ("b", 2), ("c", 0), ("d", 4)], "edit_id string, view int")
    judged = spark.createDataFrame([("a", "old", "new", 4, "fine"), ("b", "old", "", None, None)], "edit_id string, original string, improved string, visual_quality int, reason string")
    found = {r.edit_id: tuple(r)[3:] for r in release.gallery(state, views, views, 2, 3, judged=judged).collect()}
    assert found == {"a": (3, True, 0.8, 1, "new", "old", 4, "fine"), "b": (2, False, 0.8, 2, "old", "old", None, ""), "c": (0, False, 0.8, 3, "", "", None, "")}


def test_judge_audit_has_what_was_sent(spark):
    work = spark.createDataFrame([(1, "scale", True, "r1"), (2, "color", False, "r2"), (3, "color", True, "r3"), (4, "color", True, "r4")], "edit_id int, edit_type string, has_preview boolean, request string")
    said = spark.createDataFrame([(1, True, 3, "x"), (2, True, 5, "y"), (3, True, 3, "z")], "edit_id int, edit_executed boolean, visual_quality int, reason string").withColumn("correct_region", F.lit(True)).withColumn("preserve_other", F.lit(False))
    found = {r.edit_id: (r.ok, r.thresholds, r.judge.reason, tuple(r.prompt), r.conditions) for r in judging.judge_audit(work, said, "s", 1, {"scale": {"min_visual_quality": 4}, "color": {"require_preserve_other": False}}).collect()}
    assert found == {
        1: (False, {"min_visual_quality": "4", "require_preserve_other": "true"}, "x", ("s", "r1"), []),
        3: (True, {"min_visual_quality": "3", "require_preserve_other": "false"}, "z", ("s", "r3"), []),
    }


def test_masks_are_made_once_for_the_same_parts(spark):
    edits = spark.createDataFrame([("a", 1, [0, 1]), ("b", 1, [1, 0, 1]), ("c", 1, [2]), ("d", 2, [0]), ("e", 1, []), ("f", 1, None), ("g", None, [0])], "edit_id string, pair_id int, pids array<int>")
    cells = spark.createDataFrame([(1, 0, 0, 0, 0), (1, 3, 3, 3, 1), (1, 1, 0, 0, 5)], "pair_id int, x int, y int, z int, part_id int")
    asked = []

    def builder(specs, cells):
        asked.append(specs.count())
        return grid.part_masks(specs, cells, 1, 4)

    made, named = status.masks(edits, cells, builder)
    assert asked == [5] and {r.edit_id: r.built for r in named.collect()} == {"a": True, "b": True} | dict.fromkeys("cdefg", False)
    (mask,) = made.collect()
    assert mask.cells == sorted(x * 16 + y * 4 + z for r in ((0, 1), (2, 3)) for x in r for y in r for z in r)


def test_promotion_takes_deletions_first(spark):
    rows = [("o", "del_o_000", 4, "x", False, True, True), ("o", "add_o_000", 4, "x", False, False, False), ("o", "del_o_001", 4, "x", False, False, True), ("o", "add_o_001", 4, "x", False, False, False), ("o", "mod_o_000", None, "x", True, True, True), ("p", "mod_p_000", 1, None, True, True, True)]
    found = {r.edit_id: r.reason for r in release.promoted(spark.createDataFrame(rows, "obj_id string, edit_id string, view int, source string, has_before boolean, has_after boolean, has_image boolean")).collect()}
    assert found == {"del_o_000": None, "add_o_000": None, "del_o_001": "no after", "add_o_001": "its deletion is not promoted", "mod_o_000": "no view", "mod_p_000": "no asset of the object"}


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_equals_brute_force(spark, k):
    r = random.Random(k)
    spots = lambda n, far: [(g, *(r.choice([r.uniform(0, 3), r.uniform(0, far)]) for _ in range(3))) for g in range(3) for _ in range(n)]
    q, s = spots(12, 90), [p for p in spots(9, 90) if p[0] != 2] + [(2, 50.0, 50.0, 50.0)]
    make = lambda rows: spark.createDataFrame(rows, "pair_id long, x double, y double, z double")
    found = {}
    for x in neighbours.nearest(make(q), make(s), k, 1.0).collect():
        found.setdefault((x.pair_id, x.x, x.y, x.z), []).append((x["rank"], x.d2, tuple(x.s)))
    for p in set(q):
        near = sorted((sum((a - b) ** 2 for a, b in zip(p[1:], o[1:], strict=True)), o[1:]) for o in s if o[0] == p[0])[:k]
        assert [(i + 1, pytest.approx(d), o) for i, (d, o) in enumerate(near)] == sorted(found[p])
    assert neighbours.nearest(make(q), make(s).limit(0), k, 1.0).count() == 0


def test_grid_properties(spark):
    r = random.Random(4)
    cells = spark.createDataFrame(sorted({(p, r.randrange(8), r.randrange(8), r.randrange(8)) for p in range(2) for _ in range(40)}), "pair_id long, x int, y int, z int")
    rows = lambda df: {tuple(x) for x in df.select(*grid.CELL).collect()}
    own = rows(cells)
    assert own <= rows(grid.dilate(cells, 1, 8)) and own <= rows(grid.solid_fill(cells, 8)[0])
    shell = spark.createDataFrame([(0, x, y, z) for x in range(1, 5) for y in range(1, 5) for z in range(1, 5) if {x, y, z} & {1, 4}], "pair_id long, x int, y int, z int")
    filled, report = grid.solid_fill(shell, 8)
    assert filled.count() == 64 and report.first().watertight is (64 > 56 * 1.15)
    assert value(spark, F.struct(*grid.cell_of(F.col("k"), 32)), (5 * 1024 + 6 * 32 + 7,), schema="k long") == [(5, 6, 7)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)], "src long, dst long")
    assert {x.component for x in graph.connected_components(chain).collect()} == {0}


def test_replies(spark):
    cases = [
        ('think {"edit_executed": false} then {"edit_executed": true, "why": "a } brace"} end', True),
        ('```json\n{"edit_executed": false}\n```', False),
        ('<think>{"edit_executed": true}</think> {"edit_executed": false} {"other": 1}', False),
        ('{"other": 1}', None), ("{ never closed", None), ("", None), (None, None), ('{"edit_executed": tru} {"x": {"edit_executed": true}}', None),
    ]
    for text, want in cases:
        got = replies.salvaged(text, "edit_executed")
        assert (json.loads(got)["edit_executed"] if got else None) is want
    assert value(spark, F.get_json_object(replies.salvaged_json(F.col("t")), "$.edit_executed"), *[(t,) for t, _ in cases], schema="t string") == [None if w is None else str(w).lower() for _, w in cases]
    assert replies.first_object('x {"a": {"b": "}"}} {"c": 1}') == '{"a": {"b": "}"}}' and replies.first_object("``` {} ```") == "{}" and replies.first_object("{bad} {}") is None
    deep = "{" * 50_000
    assert replies.objects_in(deep) == []


def test_balanced_objects_by_brute_force():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choices('{}"\\a:1, ', k=r.randrange(30)))
        want, i = [], 0
        while i < len(text):
            end = None
            if text[i] == "{":
                depth, quoted, j = 0, False, i
                while j < len(text):
                    c = text[j]
                    if quoted:
                        j += c == "\\"
                        quoted = c != '"'
                    else:
                        quoted = c == '"'
                        depth += (c == "{") - (c == "}")
                        if depth == 0:
                            end = j
                            break
                    j += 1
                if end is None:
                    break
                want.append(text[i : end + 1])
            i = end + 1 if end is not None else i + 1
        assert replies.objects_in(text) == want, text


def test_thresholds_and_records(spark):
    schema = "edit_type string, edit_executed boolean, visual_quality string, correct_region boolean, preserve_other boolean, artifact_free boolean, mesh_quality int, edit_strength int"
    rows = [("scale", True, "3", True, True, None, 5, None), ("scale", True, "bad", True, True, True, 5, 2), ("color", True, "3", True, None, True, 4, 2), ("color", None, "5", True, True, True, 4, None)]
    over = {"color": {"require_preserve_other": False}}
    assert value(spark, judging.passes(1, over), *rows, schema=schema) == [True, False, True, False]
    assert value(spark, judging.passes(3, over), *rows, schema=schema) == [False, False, True, False]
    assert value(spark, judging.passes(2, over), *rows, schema=schema) == [False, False, True, False]
    assert rules.allowed_types("scale, nonsense") == ("scale",) and len(rules.allowed_types("nonsense")) == 8 == len(rules.allowed_types(None))
    assert settings.merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}, "d": {"e": 1}}) == {"a": {"b": 9, "c": 2}, "d": {"e": 1}}
    assert value(spark, texts.structure(F.col("t")), ("A Red, round (GLOSSY) cup .",), schema="t string") == ["A round cup."]


def test_rosters_are_the_same_each_time(spark):
    objects = spark.range(40).select(F.col("id").alias("obj_id"), F.when(F.col("id") < 10, 3).otherwise(2).alias("n_global"))
    styles = spark.createDataFrame([(c, f"{c}{i}") for c in "ab" for i in range(6)], "category string, style string")
    draw = lambda seed: {tuple(r) for r in choice.roster(objects, styles, 1, seed).collect()}
    first = draw(1)
    assert first == draw(1) != draw(2) and len(first) == 40 * 2 * 2 + 10  # the first ten have a second slot in one category
    assert {o for o, _, _, p in first if p == 3} == set(range(10)) and {c for _, c, _, p in first if p == 3} == {"a", "b"}
    assert len({(o, c, s) for o, c, s, _ in first}) == 170 and len({(c, s) for o, c, s, p in first if p == 1}) > 8


def test_latents_from_containers(spark, tmp_path):
    def save(name, **arrays):
        out = io.BytesIO()
        np.savez(out, **arrays)
        (tmp_path / name).write_bytes(out.getvalue())

    coords = np.arange(12).reshape(4, 3)
    save("a.npz", slat_coords=coords, slat_feats=np.ones((4, 2), np.float32))
    save("b.npz", slat_coords=np.insert(coords, 0, 7, axis=1), slat_feats=np.ones((4, 2), np.float32))
    save("c.npz", slat_coords=coords)
    save("d.npz", slat_coords=coords, slat_feats=np.ones((3, 2), np.float32))
    (tmp_path / "e.npz").write_bytes(b"no container")
    found = containers.latent_cells(containers.files(spark, str(tmp_path / "*.npz"))).withColumn("name", F.regexp_extract("path", r"([a-z])\.npz", 1)).collect()
    cells = {(r.name, r.b, r.x, r.y, r.z, tuple(r.feats)) for r in found if r.error is None}
    assert cells == {(n, b, *map(int, c), (1.0, 1.0)) for n, b in (("a", 0), ("b", 7)) for c in coords}
    assert {r.name for r in found if r.error is not None} == {"c", "d", "e"}


def test_state_and_plan_files(spark, tmp_path):
    (tmp_path / "o1.json").write_text('{"obj_id": "o1", "shard": "00",\n "edits": {"del_o1_000": {"edit_type": "deletion", "stages": {"gate_a": {"status": "pass", "ts": "t"}}}, "odd": {"stages": {}}}}')
    (tmp_path / "o2.json").write_text("not json")
    st = states.read_json(spark, str(tmp_path / "*.json"), states.STATE)
    assert [tuple(r) for r in states.edit_states(st).select("obj_id", "edit_id", "stage", "status").collect()] == [("o1", "del_o1_000", "gate_a", "pass")]
    assert [r.edit_id for r in states.promotable(st).collect()] == ["del_o1_000"] and states.promotable(st, required=("gate_a", "fail")).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        states.promotable(st, ["nothing"])
    assert states.read_json(spark, str(tmp_path / "nowhere" / "*.json"), states.STATE).count() == 0


def test_late_events_on_a_stream(spark, tmp_path):
    """Times out of order, equal times, and a view and a score that only early events have."""
    e = events(spark, ("mod_o_000", "gate_a", "pass", 3, None, 10), ("mod_o_000", "gate_a", "fail", None, 0.5, 12), ("mod_o_000", "gate_a", "late", 2, 0.1, 5), ("mod_o_000", "gate_a", "tie", None, None, 12), ("mod_o_001", "s4", "done", None, None, 1)).coalesce(1).sortWithinPartitions("seq")
    src = tmp_path / "in"
    for i in range(5):
        e.where(F.col("seq") == i).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    progress.follow_state(stream, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination(120)
    rows = lambda df: sorted(map(tuple, df.select("edit_id", "stage", "status", "best_view", "score", "ts").collect()))
    want = rows(state.latest(e))
    assert want[0][2:5] == ("tie", 3, 0.5) and rows(progress.read_state(spark, str(tmp_path / "s"))) == want
    assert snapshots.vacuum(spark, str(tmp_path / "s"), 1) > 0 and rows(progress.read_state(spark, str(tmp_path / "s"))) == want


def test_streams_of_plans_scores_and_manifests(spark, tmp_path):
    parts = spark.createDataFrame([("o", 1)], "obj_id string, part_id int")
    plans = spark.createDataFrame([("o", 0, "deletion", [1], "Remove the lid", "lid", ""), ("o", 1, "deletion", [2], "Add a lid", "lid", "")], "obj_id string, edit_idx int, edit_type string, pids array<int>, prompt string, target_part_desc string, new_part_desc string")
    plans.write.parquet(str(tmp_path / "plans"))
    read = lambda name, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    at = lambda n: str(tmp_path / n)
    progress.gated_plans(read("plans", plans), parts, at("gated"), at("c1")).awaitTermination(120)
    assert {r.edit_idx: r.codes for r in spark.read.parquet(at("gated")).collect()} == {0: [], 1: ["parts_invalid", "verb_conflict"]}
    scores = lambda *rows: spark.createDataFrame([("o", i, int(i[-1]), "high", s) for i, s in rows], "obj_id string, edit_id string, seq int, tier string, score double").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    edits_ = spark.createDataFrame([("o", "mod_0", "modification", None), ("o", "mod_1", "modification", None), ("o", "del_2", "deletion", None), ("o", "add_3", "addition", 2), ("o", "idt_4", "identity", None)], "obj_id string, edit_id string, edit_type string, source_del_seq int")
    for rows, checkpoint in (((("mod_0", 1.0), ("mod_1", 0.5)), "c2"), ((("mod_1", 0.9), ("del_2", 0.1)), "c2"), ((), "c2b")):  # the last time all of it again
        if rows:
            scores(*rows).coalesce(1).write.mode("append").parquet(at("in"))
        progress.score_stream(read("in", scores(("mod_0", 1.0))), edits_, at("out"), at(checkpoint)).awaitTermination(120)
    found = snapshots.read(spark, at("out/scores")).select("edit_id", "score", "tier").collect()
    assert sorted(map(tuple, found)) == [("add_3", 0.1, "high"), ("del_2", 0.1, "high"), ("mod_0", 1.0, "high"), ("mod_1", 0.5, "high")]
    assert [(r.num_edits, r.num_passed) for r in snapshots.read(spark, at("out/objects")).collect()] == [(5, 5)]
    m = spark.createDataFrame([("deletion", "00", "x"), ("scale", "01", "y")], "edit_type string, shard string, obj_id string")
    m.write.parquet(at("m"))
    for _ in range(2):
        progress.append_manifest(read("m", m), at("manifest"), at("c3")).awaitTermination(120)
    assert sorted((r.edit_type, r.obj_id) for r in spark.read.parquet(at("manifest")).collect()) == [("deletion", "x"), ("scale", "y")]


def test_distance_transform_equals_brute_force(spark):
    r = random.Random(8)
    spot = lambda p, n: [(p, r.randrange(-3, 14), r.randrange(9), r.randrange(12)) for _ in range(n)]
    cells, ref = spot(0, 150) + spot(1, 150) + spot(2, 20), spot(0, 3) + spot(1, 40)
    make = lambda rows: spark.createDataFrame([(*x, f"row {i}") for i, x in enumerate(rows)], "pair_id long, x int, y int, z int, note string")
    want = sorted((*c, f"row {i}", min((sum((a - b) ** 2 for a, b in zip(c[1:], o[1:], strict=True)) for o in ref if o[0] == c[0]), default=None)) for i, c in enumerate(cells))
    assert sorted(map(tuple, distance.squared_distances(make(cells), make(ref)).collect())) == want
    assert {x.d2 for x in distance.squared_distances(make(cells), make(ref).limit(0)).collect()} == {None}
    with pytest.raises(ValueError, match="too large"):
        distance.transform(np.array([[0, 0, 0]]), np.array([[10**6, 10**6, 0]]))


def test_blocks_without_contact_decay_from_the_edit(spark):
    """Pair 0 touches in block 0, pair 1 is edited without contact, pair 2 isn't edited."""
    make = lambda *rows: spark.createDataFrame(list(rows), "pair_id long, x int, y int, z int")
    dense = grid.every_cell(make((0, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0)), 4)
    found = {(r.pair_id, r.x, r.y, r.z): r.keep for r in distance.block_keep(dense, make((0, 0, 0, 0)), make((0, 1, 0, 0), (1, 3, 3, 3)), 3.0).collect()}
    assert len(found) == 3 * 64 and {v for (p, *_), v in found.items() if p == 2} == {1.0}
    assert found[0, 1, 0, 0] == 0 and found[0, 0, 0, 0] == 0 and found[0, 3, 0, 0] == pytest.approx(1 - np.exp(-1))
    assert found[1, 3, 3, 3] == 0 and found[1, 3, 3, 0] == pytest.approx(1 - np.exp(-1))


def test_views_out_of_range_are_none(spark):
    st = state.latest(events(spark, ("del_o_000", "gate_a", "pass", 7), ("add_o_000", "gate_a", "pass", -1), ("del_o_001", "gate_a", "pass", 1), ("add_o_001", "gate_a", "pass", 9), ("mod_o_002", "gate_a", "pass", 5), ("mod_o_003", "gate_a", "pass", 0), ("add_o_009", "gate_c", "pass")))
    views = choice.resolved_views(st)
    assert {r.edit_id: r.view for r in views.collect()} == {"del_o_000": 4, "add_o_000": 4, "del_o_001": 1, "add_o_001": 1, "mod_o_002": None, "mod_o_003": 0, "add_o_009": 4}
    e = spark.createDataFrame([("o", "del_o_000", None, "x", False, True, True), ("o", "add_o_000", 4, "x", False, False, False)], "obj_id string, edit_id string, view int, source string, has_before boolean, has_after boolean, has_image boolean")
    assert {r.edit_id: r.reason for r in release.promoted(e).collect()} == {"del_o_000": "no view", "add_o_000": "its deletion is not promoted"}


def test_plans_know_six_types(spark):
    e = spark.createDataFrame([("o", 0, k, [1], "p", "t", "n", "a", 0, 0.5, "m", "c", "s") for k in ("addition", "identity", "scale", None, "Scale")], "obj_id string, edit_idx int, edit_type string, pids array<int>, prompt string, target_part_desc string, new_part_desc string, after_desc string, view_index int, factor double, target_material string, target_color string, target_style string")
    found = {r.edit_type: "bad_type" in r.problems for r in rules.plan_problems(e, spark.createDataFrame([("o", 1)], "obj_id string, part_id int")).collect()}
    assert found == {"addition": True, "identity": True, "scale": False, None: True, "Scale": True}


def test_checks_answer_for_every_object(spark):
    steps = spark.createDataFrame([("a", "s1", "ok", None), ("b", "s1", None, None), ("c", "s1", "run", None), ("d", "s1", "fail", False), ("e", "s2", "ok", None), ("f", "s3", "ok", True)], "obj_id string, step string, status string, validated_before boolean")
    silent = lambda o: o.where("obj_id in ('a', 'd')").select("obj_id", F.lit(True).alias("ok"), F.lit(False).alias("skip"))

    def broken(o):
        raise OSError("no such store")

    found = {r.obj_id: r.status for r in status.checked(steps, {"s1": silent, "s2": broken, "s3": lambda o: o.select("obj_id", "nothing")}).collect()}
    assert found == {"a": "ok", "b": "skip", "c": "skip", "d": "ok", "e": "fail", "f": "fail"}
    none = spark.createDataFrame([], "obj_id string, edit_type string, final_pass boolean, has_gate boolean, only_types array<string>")
    assert [tuple(r) for r in status.gate_coverage(none, steps.where("obj_id = 'a'")).collect()] == [("a", 0, 0, True, True)]
