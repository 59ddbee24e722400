"""State and plan files: one JSON file or one line of JSON for each object, as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.edits import PREFIX, type_of

STATE = """obj_id string, shard string, schema_version int, updated string, steps map<string, struct<status: string>>,
 edits map<string, struct<edit_type: string, stages: map<string, struct<status: string, ts: string, reason: string>>>>"""
_EDIT = "struct<edit_type: string, selected_part_ids: array<int>, prompt: string, target_part_desc: string, after_desc: string, view_index: int>"
_PART = "struct<part_id: int, name: string>"
PLAN = f"obj_id string, parsed struct<object: struct<full_desc: string, parts: array<{_PART}>, edits: array<{_EDIT}>>, edits: array<{_EDIT}>>"


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Files of one JSON object each, or, for many objects, of one on each line. What isn't there has no rows, what isn't
    JSON none either: see bad_files for whole files."""
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("multiLine", not lines).json(path).where("obj_id is not null")


def bad_files(spark: SparkSession, path: str) -> DataFrame:
    """path of each file that read_json leaves out: it holds no JSON object, or one without obj_id."""
    if not _there(spark, path):
        return spark.createDataFrame([], "path string")
    whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    kept = F.get_json_object("value", "$.obj_id").isNotNull() & F.try_parse_json("value").isNotNull()
    return whole.where(~F.coalesce(kept, F.lit(False))).select("path")


def edit_states(states: DataFrame) -> DataFrame:
    """shard, obj_id, edit_id, edit_type, stage, status, ts, reason: a row for each stage of each edit."""
    e = states.select("shard", "obj_id", F.explode("edits").alias("edit_id", "e"))
    return e.select("shard", "obj_id", "edit_id", "e.edit_type", F.explode("e.stages").alias("stage", "s")).select("shard", "obj_id", "edit_id", "edit_type", "stage", "s.*")


def promotable(states: DataFrame, types: list[str] | None = None, objects: DataFrame | None = None, required: tuple[str, str] | None = None) -> DataFrame:
    """obj_id, edit_id, edit_type of every edit whose id has a known prefix; of some types (an unknown one is an error), of
    some objects (obj_id), with a stage of some status."""
    if unknown := set(types or ()) - set(PREFIX):
        raise ValueError(f"unknown edit types: {sorted(unknown)}")
    e = states.select("shard", "obj_id", F.explode("edits").alias("edit_id", "e")).where(F.split_part("edit_id", F.lit("_"), F.lit(1)).isin(*PREFIX.values()))
    e = e.withColumn("edit_type", type_of(F.col("edit_id")))
    e = e if types is None else e.where(F.col("edit_type").isin(*types))
    e = e if objects is None else e.join(objects.select("obj_id"), "obj_id", "left_semi")
    e = e if required is None else e.where(F.col("e.stages")[required[0]]["status"] == required[1])
    return e.select("shard", "obj_id", "edit_id", "edit_type")


def planned_edits(plans: DataFrame) -> DataFrame:
    """obj_id, edit_idx and an edit's fields for each edit of each plan, in the plan's order. Edits that a plan has under its
    object count as its own, if it has none."""
    edits = F.coalesce("parsed.edits", "parsed.object.edits")
    return plans.select("obj_id", F.posexplode(edits).alias("edit_idx", "e")).select("obj_id", "edit_idx", "e.*")


def planned_parts(plans: DataFrame) -> DataFrame:
    """obj_id, part_id, name for each part of each plan."""
    return plans.select("obj_id", F.explode("parsed.object.parts").alias("p")).select("obj_id", "p.*")
