"""What must not grow with the tables: batches, tasks and comparisons."""

import json
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.operators import neighbours
from pairloom.plans.rules import _mesh_container, _packed
from pairloom.session import spread
from pairloom.sources import containers


def test_containers_are_dealt_out_and_their_members_batched(spark):
    rows = spark.range(400).selectExpr("id as c_custkey").coalesce(1)
    assert spread(rows).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    made = _packed(rows, _mesh_container).collect()
    assert len(made) == 400
    batch = pa.RecordBatch.from_pylist([{"path": r.path, "content": bytes(r.content)} for r in made])
    found = list(containers._listed(iter([batch])))
    assert len(found) == 1 and len(set(found[0].column("path").to_pylist())) == 400
    assert {r["error"] for r in found[0].to_pylist() if r["path"] == "/objects/50.npz"} == {"unreadable"}
    assert {json.dumps(r["shape"]) for r in found[0].to_pylist() if r["key"] == "vd_offset"} == {"[2]", "[3]"}


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_equals_brute_force_in_dense_and_far_places(spark, k):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(0, 1e-3, (700, 3)), rng.normal(0, 1, (40, 3)), [[50, 50, 50]]])
    b = np.concatenate([rng.normal(0, 1e-3, (700, 3)), rng.normal(0, 1, (40, 3)), np.full((70, 3), 0.25)])
    rows = lambda p: [(i % 2, *map(float, v), i) for i, v in enumerate(p)]
    q, s = spark.createDataFrame(rows(a), "pair_id long, x double, y double, z double, n long").drop("n"), spark.createDataFrame(rows(b), "pair_id long, x double, y double, z double, n long")
    found = {}
    for r in sorted(neighbours.nearest(q, s, k, 0.1).collect(), key=lambda r: r["rank"]):
        found.setdefault((r.pair_id, r.x, r.y, r.z), []).append((r.d2, r.s.x, r.s.y, r.s.z, r.s.n))
    assert len(found) == len(a)
    for i, p in enumerate(a):
        d2 = ((p - b) ** 2 @ [1.0, 0, 0]) + ((p - b) ** 2 @ [0, 1.0, 0]) + ((p - b) ** 2 @ [0, 0, 1.0])
        of = [(float(d2[j]), *map(float, v), j) for j, v in enumerate(b) if j % 2 == i % 2]
        assert found[i % 2, *map(float, p)] == sorted(of)[:k]


def test_queries_in_a_dense_bucket_meet_few_sources(spark, monkeypatch):
    """A bucket of the given side holds all sources, yet a query is compared with a small part of them."""
    n, compared = 20_000, spark.sparkContext.accumulator(0)

    def counted(k):
        def through(batches):
            for b in batches:
                compared.add(16 * 16 * sum(b.column("kind").to_pylist()))
            return iter(())

        return through

    points = lambda by: spark.range(n).select(F.lit(1).alias("pair_id"), *[(F.rand(by + i) / 100).alias(a) for i, a in enumerate("xyz")])
    monkeypatch.setattr(neighbours, "_folded", counted)
    neighbours.nearest(points(1), points(4), 1, 0.1).collect()
    assert 0 < compared.value < n * n / 4


def test_copies_of_points_count_each(spark):
    at = lambda *v: spark.createDataFrame([(1, float(x), 0.0, 0.0, n) for n, x in enumerate(v)], "obj long, x double, y double, z double, label int")
    part, body = at(0, 0, 0, 0, 0, 0, 0, 0, 3, 9).drop("label"), at(1, 10)
    assert neighbours.gap_distance(part, body, "obj", 1.0).first().gap == 1.0
    assert neighbours.transferred_labels(part, body, "obj", 1.0).count() == 10
    assert abs(neighbours.contact_centroid(part, body, "obj", 1.0, few=10).first().x - 1.2) < 1e-9


def test_a_micro_batch_is_read_from_many_files(spark):
    from pairloom.plans.streams import _BATCHES, _stream
    from pairloom.session import scratch
    from pairloom.streaming import progress

    rows = spark.range(4000).selectExpr("'scale' as edit_type", "'00' as shard", "id")
    stream, at = _stream(rows), scratch(spark, "manifest")
    query = progress.append_manifest(stream, at, scratch(spark, "checkpoint"))
    query.awaitTermination(120)
    found = spark.read.parquet(at)
    assert found.count() == 4000 and found.select("id").distinct().count() == 4000
    read = [p for p in query.recentProgress if p["numInputRows"]]
    source = read[0]["sources"][0]["description"].removeprefix("FileStreamSource[").removesuffix("]")
    assert len(read) == _BATCHES and len(spark.read.parquet(source).inputFiles()) >= 8 * _BATCHES


def test_followed_state_is_kept_without_python(spark):
    from pairloom.plans.fixtures import fixture
    from pairloom.plans.streams import _stream
    from pairloom.streaming import progress
    from tests.conftest import SF

    changed = progress.changed_states(_stream(fixture(spark, SF, "fx_stage_events")))
    assert "TransformWithState" not in changed._jdf.queryExecution().analyzed().toString()


def test_files_of_states_are_fewer_than_objects(spark):
    from pairloom.plans.fixtures import fixture
    from pairloom.plans.reviews import _state_files
    from tests.conftest import SF

    found, objects = _state_files(spark, SF), fixture(spark, SF, "fx_stage_events").select("obj_id").distinct().count()
    assert found.count() == objects > 4 >= len(found.inputFiles())


def test_lines_of_states_that_are_no_objects_are_left_out(spark, tmp_path):
    from pairloom.sources import states

    whole = '{"obj_id": "a", "shard": "00", "edits": {"del_a_000": {"edit_type": "deletion", "stages": {"s4": {"status": "done"}}}}}'
    (tmp_path / "some.json").write_text("\n".join([whole, "not json", "", '{"shard": "00"}', whole.replace('"a"', '"b"')]) + "\n")
    found = states.edit_states(states.read_json(spark, str(tmp_path), states.STATE, lines=True)).collect()
    assert sorted((r.obj_id, r.edit_id, r.stage, r.status) for r in found) == [("a", "del_a_000", "s4", "done"), ("b", "del_a_000", "s4", "done")]
    assert states.read_json(spark, str(tmp_path / "none"), states.STATE, lines=True).count() == 0
    assert {(r.obj_id, r.edit_type) for r in states.promotable(states.read_json(spark, str(tmp_path), states.STATE, lines=True), ["deletion"], None, ("s4", "done")).collect()} == {("a", "deletion"), ("b", "deletion")}


def _dealt_by(spark, name):
    """What the exchanges of a query deal rows out by, none of its joins being broadcast."""
    from pairloom.plans import registry
    from tests.conftest import SF

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return sorted(re.sub(r"#\d+L?|, \d+$", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))


def test_states_are_dealt_out_once_when_they_are_latest(spark):
    from pairloom.plans.reviews import _states
    from tests.conftest import SF

    plan = _states(spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = sorted(re.sub(r"#\d+L?|, \d+$", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))
    assert dealt == ["obj_id", "obj_id, edit_id, stage"]


def test_rows_of_an_object_are_joined_as_by_a_join(spark):
    from pairloom.operators.edits import of_object

    rows = spark.createDataFrame([("a", 0, "p"), ("a", 0, "q"), ("a", 1, "r"), ("a", None, "s"), ("b", 0, "t"), (None, 0, "u")], "obj_id string, n int, text string")
    found = spark.createDataFrame([("a", 0, 1), ("a", 0, 2), ("a", 2, 3), ("a", None, 4), ("b", 0, None), ("c", 0, 5), (None, 0, 6)], "obj_id string, n int, m int")
    for outer in (True, False):
        got, joined = of_object(rows, found, "n", outer), rows.join(found, ["obj_id", "n"], "left" if outer else "inner")
        assert got.columns == joined.columns and sorted(map(repr, got.collect())) == sorted(map(repr, joined.collect()))


def test_training_records_stay_with_their_objects(spark):
    dealt = _dealt_by(spark, "snk6_training_records")
    assert set(dealt) == {"obj_id", "l_partkey", "p_partkey"} and dealt.count("obj_id") == 2


def test_flat_descriptors_stay_with_their_objects(spark):
    dealt = _dealt_by(spark, "txt13_flat_descriptor")
    assert set(dealt) == {"obj_id", "l_partkey", "p_partkey"} and dealt.count("obj_id") == 3


def test_described_specs_stay_with_their_objects(spark):
    dealt = _dealt_by(spark, "joi2_described_specs")
    assert set(dealt) == {"obj_id", "l_partkey", "p_partkey"} and dealt.count("obj_id") == 3


@pytest.mark.parametrize("name", ["joi2_described_specs", "txt13_flat_descriptor", "flt5_generated_specs"])
def test_specs_and_gate_a_read_lineitem_dealt_out_by_part_once(spark, name):
    from pairloom.plans import registry
    from tests.conftest import SF

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"[+:]- Exchange hashpartitioning\(l_partkey", plan)) == 1 == plan.count("- ReusedExchange")


def test_specs_have_each_row_of_gate_a_that_lets_them_go_on(spark):
    from pairloom.operators.rules import specs

    plan = spark.createDataFrame([("a", n, "scale") for n in range(6)] + [("b", 0, "scale"), (None, 0, "scale")], "obj_id string, edit_idx int, edit_type string")
    said = [("a", 0, "pass", 1), ("a", 0, None, 2), ("a", 0, "fail", 3), ("a", 1, "deferred", 1), ("a", 2, "pass", None), ("a", 3, "odd", 9), ("a", 5, "fail", 1), ("c", 0, "pass", 1), (None, 0, "pass", 1)]
    found = specs(plan, spark.createDataFrame(said, "obj_id string, edit_idx int, status string, best_view int")).collect()
    assert sorted((r.edit_id, r.status or "", r.best_view) for r in found) == [("scl_a_000", "", 2), ("scl_a_000", "pass", 1), ("scl_a_003", "odd", 9)]


def test_files_of_plans_are_compressed_and_bounded(spark, monkeypatch):
    from pairloom.plans import registry, reviews
    from tests.conftest import SF

    monkeypatch.setattr(reviews, "_PLANS_A_FILE", 100)
    found = registry.queries()["src4_5_plan_scan"](spark, SF)
    assert len(found.inputFiles()) >= found.select("obj_id").distinct().count() / 100 and all(f.endswith(".json.gz") for f in found.inputFiles())


def test_rolled_up_edits_stay_with_their_objects(spark):
    dealt = _dealt_by(spark, "joi8_object_roll_up")
    assert set(dealt) == {"obj_id", "l_partkey", "p_partkey"} and dealt.count("obj_id") <= 5


def test_roll_up_is_the_same_with_and_without_objects_of_scores(spark):
    from pairloom.operators.judging import rolled_up

    edits = spark.createDataFrame([("a", "del_a_000", "deletion"), ("a", "idt_a_1", "identity"), ("b", "mod_b_000", "modification")], "obj_id string, edit_id string, edit_type string")
    scores = spark.createDataFrame([("a", "del_a_000", "high", 0.5), ("b", "mod_b_001", "low", 0.25)], "obj_id string, edit_id string, tier string, score double")
    with_own, without = (sorted(rolled_up(edits, s, "obj_id").collect()) for s in (scores, scores.drop("obj_id")))
    assert with_own == without and [(r.obj_id, r.num_edits, r.num_passed) for r in with_own] == [("a", 2, 2), ("b", 1, 0)]


def test_edits_are_read_once_for_each_batch_of_scores(spark):
    from pairloom.plans.streams import _stream
    from pairloom.session import scratch
    from pairloom.sources import snapshots
    from pairloom.streaming import progress

    seen, at = spark.sparkContext.accumulator(0), scratch(spark, "scores")

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    given = spark.range(40).selectExpr("concat('o', id % 8) as obj_id", "concat('del_o', id % 8, '_00', id div 8) as edit_id", "cast(id div 8 as int) as seq")
    every = given.selectExpr("*", "'deletion' as edit_type", "cast(null as int) as source_del_seq")
    scores = _stream(given.selectExpr("*", "timestamp'2024-01-01' as ts", "'high' as tier", "0.5D as score"), 2)
    progress.score_stream(scores, every.mapInArrow(through, every.schema), at, scratch(spark, "checkpoint")).awaitTermination(120)
    found = snapshots.read(spark, f"{at}/objects").collect()
    assert 40 <= seen.value <= 2 * 40 and len(found) == 8 and {(r.num_edits, r.num_passed) for r in found} == {(5, 5)}


def test_meshes_read_their_input_once(spark):
    from pairloom.plans.words import _triangles
    from tests.conftest import SF

    assert not [f for f in _triangles(spark, SF).inputFiles() if "lineitem" in f]


@pytest.mark.parametrize("name", ["str2_gated_plans", "str5_streamed_manifest"])
def test_streamed_plans_are_written_as_they_lie_by_object(spark, monkeypatch, name):
    from pairloom import session
    from pairloom.plans import registry, streams
    from tests.conftest import SF

    monkeypatch.setattr(session, "_STORED", [])
    n = registry.queries()[name](spark, SF).count()
    source, log = (next(p for p in session._STORED if f"/{kind}-" in p) for kind in ("source", "checkpoint"))
    found = spark.read.parquet(source)
    assert found.count() == n and found.select("obj_id", F.input_file_name()).distinct().count() == found.select("obj_id").distinct().count()
    assert len(found.inputFiles()) >= streams._SPLIT * streams._BATCHES // 2
    commits = spark.sparkContext._jvm.java.io.File(f"{log}/commits".removeprefix("file:")).list()
    assert len([c for c in commits if c.isdigit()]) == streams._BATCHES
    assert name != "str2_gated_plans" or found.columns == ["obj_id", "edit_idx", "edit_type", "pids", "prompt", "target_part_desc", "new_part_desc"]


def test_edits_of_so_many_tasks_are_dealt_out_by_object_once(spark):
    from pairloom.plans.rules import _plans
    from tests.conftest import SF

    plan = _plans(spark, SF, 7).repartition(7, "obj_id")._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\(obj_id#\d+, (\d+)\)", plan) == ["7"]
    assert _plans(spark, SF, 7).exceptAll(_plans(spark, SF)).isEmpty() and _plans(spark, SF, 7).count() == _plans(spark, SF).count()


def test_parts_are_made_once_for_all_batches_of_plans(spark, monkeypatch):
    from pairloom.plans import registry, streams
    from pairloom.plans.fixtures import fixture
    from tests.conftest import SF

    seen, parts = spark.sparkContext.accumulator(0), fixture(spark, SF, "fx_parts")

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(streams, "fixture", lambda s, d, name, *more: parts.mapInArrow(through, parts.schema) if name == "fx_parts" else fixture(s, d, name, *more))
    assert registry.queries()["str2_gated_plans"](spark, SF).count() > 0
    assert seen.value == parts.count()


def test_rows_in_buckets_are_joined_as_they_lie(spark, monkeypatch):
    from pairloom import session
    from pairloom.operators.rules import known_parts, rule_codes

    monkeypatch.setattr(session, "_STORED", [])
    monkeypatch.setattr(session, "_TABLES", [])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    parts = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2), (None, 3)], "obj_id string, part_id int")
    plans = spark.createDataFrame([("a", 0, [1]), ("a", 1, [1, 2]), ("b", 0, [2]), ("c", 0, [2]), (None, 0, [3])], "obj_id string, edit_idx int, pids array<int>")
    plans = plans.selectExpr("*", "'deletion' as edit_type", "'Remove the lid' as prompt", "'lid' as target_part_desc", "'' as new_part_desc")
    own = session.bucketed(known_parts(parts), "obj_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rule_codes(plans, own)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1
        rows = sorted(map(repr, found.collect()))
        assert rows == sorted(map(repr, rule_codes(plans, parts).collect()))
        assert sum("parts_invalid" in r for r in rows) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    (name,) = session._TABLES
    session.clear_stored(spark)
    assert not spark.catalog.tableExists(name) and not session._TABLES and not session._STORED
