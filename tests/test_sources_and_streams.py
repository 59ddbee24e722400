import threading
import time

import pytest
from pyspark.sql import functions as F

from pairloom.operators.state import latest
from pairloom.plans.fixtures import fixture
from pairloom.sources import manifest, snapshots
from pairloom.streaming import progress
from tests.conftest import SF


def test_manifest_round_trip(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"edit_id": "a", "n": 1}\n\n  \nnot json\n[1]\n{"edit_id": "b"}\n')
    schema = spark.createDataFrame([], "edit_id string, n int").schema
    good, bad = manifest.read_jsonl(spark, str(tmp_path / "m.jsonl"), schema)
    assert sorted(map(tuple, good.collect()), key=str) == [("a", 1), ("b", None)]
    assert sorted(r.line for r in bad.collect()) == ["[1]", "not json"]

    out = str(tmp_path / "out")
    rows = lambda *r: spark.createDataFrame(list(r), "edit_type string, shard string, obj_id string, v int")
    assert manifest.append(rows(("deletion", "00", "x", 1), ("scale", "00", "y", 2)), out) == 2
    manifest.append(rows(("deletion", "00", "z", 3)), out)
    assert manifest.rewrite(rows(("deletion", "00", "x", 9)), out) == 1
    assert sorted((r.edit_type, r.obj_id, r.v) for r in manifest.read(spark, out).collect()) == [("deletion", "x", 9), ("scale", "y", 2)]
    assert [r.obj_id for r in manifest.read(spark, out, edit_type="sc*").collect()] == ["y"]
    manifest.rewrite(rows(("deletion", "01", "x", 3)), out, whole=True)
    assert [(r.shard, r.v) for r in manifest.read(spark, out).collect()] == [("01", 3)]
    assert sorted(r.v for r in snapshots.read(spark, out, 1).collect()) == [1, 2, 3]
    assert snapshots.vacuum(spark, out, 1) == 3 and [(r.shard, r.v) for r in manifest.read(spark, out).collect()] == [("01", 3)]
    assert manifest.read(spark, str(tmp_path / "none")) is None
    good, bad = manifest.read_jsonl(spark, str(tmp_path / "nowhere.jsonl"), schema)
    assert good.count() == bad.count() == 0


def test_streams_equal_batches(spark, tmp_path):
    events = fixture(spark, SF, "fx_stage_events").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "events")
    events.repartition(3).write.parquet(src)
    stream = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = progress.hourly(stream(), "3650 days")
    counts.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(map(tuple, spark.table("hourly").collect()), key=str) == sorted(map(tuple, progress.hourly(events).collect()), key=str)


def test_readers_never_see_part_of_a_rewrite(spark, tmp_path):
    out, n, stop, seen, failed = str(tmp_path / "m"), 60, threading.Event(), [], []
    rows = lambda v: spark.range(n).select(F.concat(F.lit("t"), F.col("id") % 3).alias("edit_type"), (F.col("id") % 2).cast("string").alias("shard"), F.col("id").cast("string").alias("obj_id"), F.lit(v).alias("v"))
    manifest.rewrite(rows(0), out, whole=True)

    def look():
        try:
            while not stop.is_set():
                r = manifest.read(spark, out).groupBy("v").count().collect()
                seen.append([(x.v, x["count"]) for x in r])
        except Exception as e:  # reported below
            failed.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    for v in range(1, 8):
        manifest.rewrite(rows(v), out, whole=v % 2 == 1)
    stop.set()
    reader.join()
    assert not failed and len(seen) > 3
    assert all(len(x) == 1 and x[0][1] == n for x in seen) and [x[0][0] for x in seen] == sorted(x[0][0] for x in seen)


def test_commits_at_once_and_commits_again(spark, tmp_path):
    out = str(tmp_path / "t")
    row = lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    threads = [threading.Thread(target=lambda v=v: snapshots.commit(row(v), out, ("k",))) for v in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.v for r in snapshots.read(spark, out).collect()) == list(range(6))
    assert [snapshots.commit(row(9), out, ("k",), tag="x") for _ in range(2)] == [1, 0]
    before = snapshots.current

    def overtaken(s, p):  # another writer is faster
        found = before(s, p)
        snapshots.current = before
        snapshots.commit(row(10), out, ("k",))
        return found

    snapshots.current = overtaken
    try:
        with pytest.raises(snapshots.Conflict):
            snapshots.commit(row(11), out, ("k",), "touched")
    finally:
        snapshots.current = before
    assert snapshots.commit(row(12), out, ("k",), "touched") == 1 and [r.v for r in snapshots.read(spark, out).collect()] == [12]


def test_state_over_a_restart(spark, tmp_path):
    """Late and equal events, in an order of their own, one part of them after a restart."""
    events = fixture(spark, SF, "fx_stage_events").withColumn("ts", F.col("ts").cast("timestamp"))
    src, at = str(tmp_path / "events"), str(tmp_path / "state")
    key = lambda df: sorted((r.edit_id, r.stage, str(r.ts), r.status, str(r.best_view), str(r.score)) for r in df.collect())
    stream = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    for part in (events.where("seq % 3 = 2"), events.where("seq % 3 <> 2 or seq % 4 = 0")):
        part.coalesce(1).write.mode("append").parquet(src)
        progress.follow_state(stream(), at, str(tmp_path / "c")).awaitTermination(120)
    assert key(progress.read_state(spark, at)) == key(latest(events))
    n = snapshots.current(spark, at)["version"]
    q = progress.follow_state(stream(), at, str(tmp_path / "other"), ttl=10**7)  # all events again, without what was known
    until = time.time() + 60
    while snapshots.current(spark, at)["version"] < n + 2 and time.time() < until:
        time.sleep(0.5)
    q.stop()
    assert key(progress.read_state(spark, at)) == key(latest(events)) and snapshots.current(spark, at)["version"] == n + 2
