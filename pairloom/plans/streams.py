"""Queries that write files first and read them back: streams run to their end, and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators import edits, rules, state
from pairloom.plans.core import _LATEST
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.plans.rules import _CODES, _P, _pl, _plans
from pairloom.session import bucketed, scratch, stored
from pairloom.sources import manifest, snapshots
from pairloom.streaming import progress

_BATCHES, _SPLIT = 4, 32


def _stream(df: DataFrame, batches: int = _BATCHES, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows as a stream of a few micro-batches, each of many files, so that no task has a large part of a batch. Rows that
    are dealt out `by` columns into as many tasks already are written as they lie."""
    path = scratch(df.sparkSession, "source")
    df.repartition(batches * _SPLIT, *by).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", _SPLIT).parquet(path)


@query("str1_followed_state", with_fixtures(_LATEST + "SELECT obj_id, edit_id, stage, status, best_view, score FROM latest", "fx_stage_events"))
def str1(s, d):
    """Events come in no order, in several batches."""
    at = scratch(s, "state")
    progress.follow_state(_stream(fixture(s, d, "fx_stage_events")), at, scratch(s, "checkpoint")).awaitTermination()
    return progress.read_state(s, at).drop("ts")


@query("str2_gated_plans", _pl(_P + f"SELECT obj_id, edit_idx, {_CODES} AS codes FROM k"))
def str2(s, d):
    """Plans arrive by object, with the fields that rules go by. Every batch reads the parts."""
    at, asked = scratch(s, "gated"), ("obj_id", "edit_idx", "edit_type", "pids", "prompt", "target_part_desc", "new_part_desc")
    plans = _stream(_plans(s, d, _BATCHES * _SPLIT).select(*asked), by=("obj_id",))
    progress.gated_plans(plans, bucketed(rules.known_parts(fixture(s, d, "fx_parts")), "obj_id"), at, scratch(s, "checkpoint")).awaitTermination()
    return s.read.parquet(at).select("obj_id", "edit_idx", F.array_join("codes", ",").alias("codes"))


_SCORES = """named AS (SELECT DISTINCT obj_id, edit_id, regexp_extract(edit_id, '([0-9]+)$', 1)::INT AS seq FROM fx_stage_events), kinds AS (SELECT *, CASE edit_id[1:3] WHEN 'del' THEN 'deletion' WHEN 'mod' THEN 'modification' ELSE 'addition' END AS edit_type FROM named),
 judged AS (SELECT obj_id, edit_id, seq, CASE (length(edit_id) + seq) % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'negative' END AS tier, (length(edit_id) + seq) / 20 AS score FROM kinds WHERE edit_type <> 'addition' AND seq <> 3),
 scores AS (SELECT obj_id, edit_id, tier, score FROM judged UNION ALL SELECT k.obj_id, k.edit_id, d.tier, d.score FROM kinds k JOIN judged d ON k.edit_type = 'addition' AND starts_with(d.edit_id, 'del_') AND d.obj_id = k.obj_id AND d.seq = (k.seq + 1) % 5)"""


def _score_stream(s, d) -> str:
    """Every edit is judged as often as it has events, in several batches; the stream is stopped and starts again from
    another checkpoint, so that it meets all of them a second time."""
    e = fixture(s, d, "fx_stage_events")
    number = F.regexp_extract("edit_id", "([0-9]+)$", 1).cast("int")
    named = e.select("obj_id", "edit_id", number.alias("seq"), F.col("ts").cast("timestamp").alias("ts"))
    kinds = named.select("obj_id", "edit_id", "seq").distinct().withColumn("edit_type", edits.type_of(F.col("edit_id"))).withColumn("source_del_seq", (F.col("seq") + 1) % 5)
    kinds = stored(kinds)  # each batch reads them
    k = F.length("edit_id") + F.col("seq")
    tier = F.when(k % 4 == 0, "high").when(k % 4 == 1, "medium").when(k % 4 == 2, "low").otherwise("negative")
    judged = named.where("not startswith(edit_id, 'add_') and seq <> 3").select("obj_id", "edit_id", "seq", "ts", tier.alias("tier"), (k / 20).alias("score"))
    at, stream = scratch(s, "scores"), _stream(judged, 2)
    for within in (None, "3650 days"):  # events come in no order
        progress.score_stream(stream, kinds, at, scratch(s, "checkpoint"), within).awaitTermination()
    return at


@query("str3_scored_once", with_fixtures(f"WITH {_SCORES} SELECT obj_id, edit_id, tier, score FROM scores", "fx_stage_events"))
def str3(s, d):
    return snapshots.read(s, f"{_score_stream(s, d)}/scores").select("obj_id", "edit_id", "tier", "score")


@query("str3_rolled_up_objects", with_fixtures(f"WITH {_SCORES} SELECT obj_id, count(*) AS num_edits, count_if(tier IN ('high', 'medium')) AS num_passed, round(sum(coalesce(score, 0)), 6) AS total FROM kinds LEFT JOIN scores USING (obj_id, edit_id) WHERE obj_id IN (SELECT obj_id FROM judged) GROUP BY obj_id", "fx_stage_events"))
def str3_objects(s, d):
    total = F.aggregate("edits", F.lit(0.0), lambda acc, x: acc + x["score"])
    return snapshots.read(s, f"{_score_stream(s, d)}/objects").select("obj_id", "num_edits", "num_passed", F.round(total, 6).alias("total"))


def _counted(s, counts: DataFrame) -> DataFrame:
    at = scratch(s, "counts")
    progress.keep_whole(counts, at, scratch(s, "checkpoint")).awaitTermination()
    return snapshots.read(s, at).drop("part")


_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start", "end")})


@query("str4_sliding_windows", with_fixtures(f"""WITH w AS (SELECT stage, status, time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(15 * k.range) AS start FROM fx_stage_events, range(4) k)
 SELECT {_TIME.format("start")} AS start, {_TIME.format("start + INTERVAL 1 HOUR")} AS end, stage, status, count(*) AS n FROM w GROUP BY ALL""", "fx_stage_events"))
def str4_sliding(s, d):
    return _times(_counted(s, progress.sliding(_stream(fixture(s, d, "fx_stage_events")), late="3650 days")))


@query("str4_session_windows", with_fixtures(f"""WITH g AS (SELECT obj_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY obj_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM fx_stage_events), k AS (SELECT *, sum(fresh) OVER (PARTITION BY obj_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell FROM g)
 SELECT {_TIME.format("min(ts)")} AS start, {_TIME.format("max(ts) + INTERVAL 30 MINUTE")} AS end, obj_id, count(*) AS n FROM k GROUP BY obj_id, spell""", "fx_stage_events"))
def str4_sessions(s, d):
    return _times(_counted(s, progress.sessions(_stream(fixture(s, d, "fx_stage_events")), late="3650 days")))


@query("str5_streamed_manifest", with_fixtures("SELECT edit_type, obj_id, edit_idx FROM fx_edits", "fx_edits"))
def str5(s, d):
    at = scratch(s, "manifest")
    made = fixture(s, d, "fx_edits", _BATCHES * _SPLIT).select("edit_type", "shard", "obj_id", "edit_idx")
    progress.append_manifest(_stream(made, by=("obj_id",)), at, scratch(s, "checkpoint")).awaitTermination()
    return s.read.parquet(at).select("edit_type", "obj_id", "edit_idx")


@query("src3_json_lines", with_fixtures("SELECT obj_id, edit_idx, prompt FROM fx_edits WHERE edit_idx % 3 <> 2", "fx_edits"))
def src3(s, d):
    """A third of the lines is malformed or blank."""
    at, i = scratch(s, "lines"), F.col("edit_idx") % 6
    line = F.when(i == 2, F.lit("not json")).when(i == 5, F.lit("  ")).otherwise(F.to_json(F.struct("obj_id", "edit_idx", "prompt")))
    fixture(s, d, "fx_edits").select(line.alias("value")).write.text(at)
    schema = T.StructType([T.StructField("obj_id", T.StringType()), T.StructField("edit_idx", T.IntegerType()), T.StructField("prompt", T.StringType())])
    return manifest.read_jsonl(s, at, schema)[0]


@query("snk1_2_manifest", with_fixtures("SELECT edit_type, obj_id, edit_idx, CASE WHEN edit_type = 'scale' THEN 2 ELSE 1 END AS version FROM fx_edits", "fx_edits"))
def snk1(s, d):
    """Two appends, then one type's partitions are written anew."""
    at = scratch(s, "manifest")
    e = fixture(s, d, "fx_edits").select("edit_type", "shard", "obj_id", "edit_idx", F.lit(1).alias("version"))
    manifest.append(e.where("edit_idx % 2 = 0"), at)
    manifest.append(e.where("edit_idx % 2 = 1"), at)
    manifest.rewrite(e.where("edit_type = 'scale'").withColumn("version", F.lit(2)), at)
    return manifest.read(s, at).select("edit_type", "obj_id", "edit_idx", "version")


@query("key3_key5_ids", with_fixtures("SELECT DISTINCT edit_id, CASE WHEN starts_with(edit_id, 'del_') THEN 'add_' || substr(edit_id, 5) WHEN starts_with(edit_id, 'add_') THEN 'del_' || substr(edit_id, 5) END AS paired, edit_id[1:3] AS prefix FROM fx_stage_events", "fx_stage_events"))
def key3(s, d):
    ids = state.latest(fixture(s, d, "fx_stage_events")).select("edit_id").distinct()
    return ids.select("edit_id", edits.paired_id(F.col("edit_id")).alias("paired"), edits.prefix_of(edits.type_of(F.col("edit_id"))).alias("prefix"))
