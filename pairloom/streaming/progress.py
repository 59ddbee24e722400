"""Streams: progress in windows, the latest state, gates and scores, by the same expressions as in batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pairloom.sources import snapshots

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Partitions of the tables that streams keep: a batch rewrites those that it has rows in.
BUCKETS = 16


def _windowed(events: DataFrame, late: str, window: Callable[[], Column], *by: str) -> DataFrame:
    at = events.withColumn("ts", F.col("ts").cast("timestamp"))
    at = at.withWatermark("ts", late) if events.isStreaming else at
    counts = at.groupBy(window().alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def hourly(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """hour, stage, status, n. On a stream, an hour is final once events are `late` past its end, and its state goes."""
    return _windowed(events, late, lambda: F.window("ts", "1 hour"), "stage", "status").select(F.col("start").alias("hour"), "stage", "status", "n")


def sliding(events: DataFrame, length: str = "1 hour", step: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """start, end, stage, status, n for windows that overlap: an event counts in all that it lies in."""
    return _windowed(events, late, lambda: F.window("ts", length, step), "stage", "status")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """start, end, obj_id, n: spells of work on an object. A spell ends once nothing happens for the gap; an event right at
    its end starts another. On a stream it is final, and its state goes, once events are `late` past its end."""
    return _windowed(events, late, lambda: F.session_window("ts", gap), "obj_id")


class _Latest(StatefulProcessor):
    """Of one edit's stage: the last write, the last one with a best_view and the last one with a score. Each is kept with
    its time and number, so that the order in which events come doesn't matter."""

    FIELDS = ("status", "best_view", "score")
    NAMES = ("obj_id", "edit_id", "stage", "status_at", "status_seq", "status", "best_view_at", "best_view_seq", "best_view", "score_at", "score_seq", "score")
    STATE = "status_at long, status_seq long, status string, best_view_at long, best_view_seq long, best_view int, score_at long, score_seq long, score double"

    def __init__(self, ttl: int | None) -> None:
        self._ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("latest", self.STATE, self._ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known = list(self._state.get()) if self._state.exists() else [None] * 9
        before = list(known)
        for r in rows:
            for i, f in enumerate(self.FIELDS):
                last = known[3 * i : 3 * i + 2]
                if (f == "status" or r[f] is not None) and (last[0] is None or (r["at"], r.seq) > tuple(last)):
                    known[3 * i : 3 * i + 3] = r["at"], r.seq, r[f]
        if known != before:
            self._state.update(tuple(known))
            yield Row(**dict(zip(self.NAMES, (*key, *known), strict=True)))

    def close(self) -> None:
        pass


def changed_states(events: DataFrame, ttl: int | None = None) -> DataFrame:
    """A stream of events -> a stream of the latest state of those edits and stages that a batch has events of. State is keyed
    by (obj_id, edit_id, stage), kept in RocksDB; with ttl it goes so many milliseconds after its last change, and a batch
    that doesn't change a state gives no row of it."""
    given = events.withColumn("ts", F.col("ts").cast("timestamp")).select("obj_id", "edit_id", "stage", "status", "best_view", "score", F.unix_micros("ts").alias("at"), "seq")
    if ttl is None:
        last = [F.max(F.when(F.lit(f == "status") | F.col(f).isNotNull(), F.struct(F.col("at").alias(f"{f}_at"), F.col("seq").alias(f"{f}_seq"), f))).alias(f"_{f}") for f in _Latest.FIELDS]
        kept = given.groupBy("obj_id", "edit_id", "stage").agg(*last)
        return kept.select("obj_id", "edit_id", "stage", *[f"_{f}.{c}" for f in _Latest.FIELDS for c in (f"{f}_at", f"{f}_seq", f)])
    schema = T.StructType([*given.select("obj_id", "edit_id", "stage").schema.fields, *T._parse_datatype_string(_Latest.STATE).fields])
    return given.groupBy("obj_id", "edit_id", "stage").transformWithState(_Latest(ttl), schema, "Update", "ProcessingTime")


def _merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """One row for each key, each field from whichever has the later one: right for rows that come a second time, and for
    keys whose state has gone meanwhile."""
    every = new if old is None else old.unionByName(new)
    last = [F.max(F.when(F.col(f"{f}_seq").isNotNull(), F.struct(f"{f}_at", f"{f}_seq", f))).alias(f) for f in _Latest.FIELDS]
    kept = every.groupBy("obj_id", "edit_id", "stage").agg(*last)
    return kept.select("obj_id", "edit_id", "stage", *[f"{f}.{c}" for f in _Latest.FIELDS for c in (f"{f}_at", f"{f}_seq", f)])


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def _in_buckets(rows: DataFrame, key: str) -> DataFrame:
    """rows with their bucket, dealt out so that about as many files are written as shuffles have tasks, not that many for
    each bucket."""
    each = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
    return rows.withColumn("bucket", _bucket(key)).repartition("bucket", F.pmod(F.hash(key), F.lit(each)))


def _upsert(spark: SparkSession, rows: DataFrame, path: str, key: str, tag: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
    """Merge rows into a table in snapshots: the buckets that they are in are written anew, in one commit."""
    found = snapshots.current(spark, path)
    if found and tag in found["tags"]:
        return
    touched = rows.select(_bucket(key).alias("bucket")).distinct()
    old = snapshots.read(spark, path)
    old = None if old is None else old.join(touched, "bucket", "left_semi").drop("bucket")
    snapshots.commit(_in_buckets(merge(old, rows), key), path, ("bucket",), "touched", tag)


def _started(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query whose state needs RocksDB; other queries of the session keep what they have."""
    old = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return start()
    finally:
        spark.conf.set(_PROVIDER, old)


def follow_state(events: DataFrame, path: str, checkpoint: str, ttl: int | None = None) -> StreamingQuery:
    """Keep the latest state of each edit and stage from a stream of events, whatever order they come in, as a table in
    snapshots with one row for each: a batch rewrites the buckets that it has events of, and a batch that is run again
    nothing. It ends once it has read what there is; with ttl (see changed_states) it goes on until it is stopped,
    as keys then have to be looked after."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.repartition("edit_id").persist()  # rows that still are in the aggregation's order can't be persisted
        try:
            if not batch.isEmpty():
                _upsert(batch.sparkSession, batch, path, "edit_id", f"{checkpoint} {number}", _merged)
        finally:
            batch.unpersist()

    stream = changed_states(events, ttl).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    stream = stream.trigger(processingTime="1 second") if ttl else stream.trigger(availableNow=True)
    return _started(events.sparkSession, stream.start)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """obj_id, edit_id, stage, status, best_view, score, ts as follow_state has them."""
    return snapshots.read(spark, path).select("obj_id", "edit_id", "stage", "status", "best_view", "score", F.timestamp_micros("status_at").alias("ts"))


def append_manifest(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of records as a manifest partitioned by edit_type and shard. The sink's log names the files of each
    finished batch: Spark's readers see whole batches, each once, however often one is run again."""
    spread = F.pmod(F.xxhash64(*records.columns), F.lit(BUCKETS))  # a type's rows of a shard go to a few tasks, however many there are
    dealt = records.repartition("edit_type", "shard", spread)
    return dealt.writeStream.format("parquet").partitionBy("edit_type", "shard").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def gated_plans(plans: DataFrame, parts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Check each planned edit by rule as soon as its plan arrives: a stream of plans (obj_id, edit_idx, edit_type, pids,
    prompt, target_part_desc, new_part_desc) joined to the parts (obj_id, part_id) of all objects."""
    from pairloom.operators.rules import rule_codes

    return rule_codes(plans, parts).writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_stream(scores: DataFrame, edits: DataFrame, path: str, checkpoint: str, within: str | None = None) -> StreamingQuery:
    """scores: a stream (obj_id, edit_id, seq, ts, tier, score, ...) of judged edits; edits (obj_id, edit_id, edit_type,
    source_del_seq): all edits of the objects. Keeps two tables in snapshots: path/scores with each edit at its first
    score, additions with what they inherit, and path/objects with each object's roll-up.

    An edit that was scored before is known from the scores that are stored, after a restart from a new checkpoint as well:
    nothing is scored twice, and the stream needs no state. within: for streams in about the order of ts; an edit that
    comes again within that time then doesn't even reach a batch. State goes when it is over; so do rows that come later
    than that, as Spark takes them for late. Each batch rolls up the objects that it has scores of."""
    from pairloom.operators.judging import inherited_scores, rolled_up

    def write(batch: DataFrame, number: int) -> None:
        spark, tag = batch.sparkSession, f"{checkpoint} {number}"
        kept = []

        def once_made(df: DataFrame) -> DataFrame:
            kept.append(df.persist())
            return kept[-1]

        try:
            batch = once_made(batch.drop("ts").dropDuplicates(["edit_id"]))
            if batch.isEmpty():
                return
            touched = batch.select("obj_id").distinct()
            mine = once_made(edits.join(touched, "obj_id", "left_semi"))
            known = snapshots.read(spark, f"{path}/scores")
            new = batch if known is None else once_made(batch.join(known.select("edit_id"), "edit_id", "left_anti"))
            fields = [f.name for f in batch.schema.fields if f.name not in ("obj_id", "edit_id", "seq")]
            additions = inherited_scores(mine.where("edit_type = 'addition'").select("obj_id", "edit_id", "source_del_seq"), new.where(F.col("edit_id").startswith("del_")))
            made = additions.join(new.select("edit_id"), "edit_id", "left_anti").select("obj_id", "edit_id", F.lit(None).cast(batch.schema["seq"].dataType).alias("seq"), *fields)
            rows = new.select("obj_id", "edit_id", "seq", *fields).unionByName(made if known is None else made.join(known.select("edit_id"), "edit_id", "left_anti"))
            snapshots.commit(_in_buckets(rows, "obj_id"), f"{path}/scores", ("bucket",), "none", tag)
            every = snapshots.read(spark, f"{path}/scores").join(touched, "obj_id", "left_semi")
            _upsert(spark, once_made(rolled_up(mine, every, "obj_id")), f"{path}/objects", "obj_id", tag, _replaced)
        finally:
            for df in kept:
                df.unpersist()

    once = scores if within is None else scores.withWatermark("ts", within).dropDuplicatesWithinWatermark(["edit_id"])
    return once.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _replaced(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.join(new.select("obj_id"), "obj_id", "left_anti").unionByName(new)


def keep_whole(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of counts as a table in snapshots that every batch replaces by what is counted so far."""

    def write(batch: DataFrame, number: int) -> None:
        snapshots.commit(batch.withColumn("part", F.lit(0)), path, ("part",), "all", f"{checkpoint} {number}")

    return counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
