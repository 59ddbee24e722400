"""Status of steps by object: flips, progress, pending work, migration of old records, registries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gates of old records and the stages they became; the version that has them as stages.
GATES, VERSION = {"A": "gate_a", "C": "gate_c", "E": "gate_e"}, 3

#: Checks by step: each takes the step's objects and returns obj_id, ok, expected, found, skip. A step without one is
#: accepted as it is.
Check = Callable[[DataFrame], DataFrame]


def gate_status(rule_pass: Column, vlm_pass: Column) -> Column:
    """Status that a gate's payload stands for: it fails if its rule or its judge says so."""
    return F.when(F.coalesce(rule_pass, F.lit(True)) & F.coalesce(vlm_pass, F.lit(True)), "pass").otherwise("fail")


def gate_event(payloads: DataFrame) -> DataFrame:
    """payloads (obj_id, edit_id, gate, rule_pass, vlm_pass, ts, seq) as events for the state's log."""
    return payloads.select("obj_id", "edit_id", F.col("gate").alias("stage"), gate_status(F.col("rule_pass"), F.col("vlm_pass")).alias("status"), "ts", "seq")


def migrated(records: DataFrame) -> DataFrame:
    """records (obj_id, edit_id, schema_version, stages map<stage, struct<status, verdict and any others>>, gates
    map<letter, verdict>, and final_pass, fail_gate, fail_reason as far as they are there) -> obj_id, edit_id,
    schema_version 3, stages, changed. A verdict is a struct with rule and vlm, each a struct with `pass` and any others.

    An old gate's verdict goes to its stage whole, over the one that is there; its status only where the stage has none.
    A verdict that is null, or null in both rule and vlm, is none. gates and the final_ and fail_ columns go. Records of
    version 3 without them are left as they are, so that migrating twice changes nothing."""
    kinds = {c: records.schema[c].dataType for c in ("stages", "gates")}
    old, stages = (F.coalesce(c, F.create_map().cast(kinds[c])) for c in ("gates", "stages"))
    entries = []
    for letter, stage in GATES.items():
        v, now = old[letter], stages[stage]
        made = {"status": F.coalesce(now["status"], gate_status(v["rule"]["pass"], v["vlm"]["pass"])), "verdict": v}
        entry = F.struct(*[made.get(f, now[f]).alias(f) for f in kinds["stages"].valueType.names])
        entries.append(F.struct(F.lit(stage).alias("key"), F.when(v["rule"].isNotNull() | v["vlm"].isNotNull(), entry).otherwise(now).alias("value")))
    made = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    rest = F.map_filter(stages, lambda k, _: ~k.isin(*GATES.values()))
    derived = [F.col(c).isNotNull() for c in ("gates", "final_pass", "fail_gate", "fail_reason") if c in records.columns]
    changed = reduce(Column.__or__, derived, ~F.col("schema_version").eqNullSafe(VERSION))
    return records.select("obj_id", "edit_id", F.lit(VERSION).alias("schema_version"), F.map_concat(rest, made).alias("stages"), changed.alias("changed"))


def migration_counts(done: DataFrame, bad: DataFrame, *keys: str) -> DataFrame:
    """done (keys, obj_id, changed: see migrated()), bad (keys, obj_id: files that can't be read) -> keys, scanned, migrated,
    skipped, bad: numbers of objects. One of which any edit changed is migrated."""
    own = done.groupBy(*keys, "obj_id").agg(F.bool_or("changed").alias("changed"))
    both = own.unionByName(bad.select(*keys, "obj_id").distinct().withColumn("changed", F.lit(None).cast("boolean")))
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("scanned"), n(F.col("changed")).alias("migrated"), n(~F.col("changed")).alias("skipped"), n(F.col("changed").isNull()).alias("bad"))


def flipped(status: Column, validated_before: Column, ok: Column, skip: Column) -> Column:
    """A step's status after a check: what is skipped stays as it ended, a check that fails fails the step, one that passes
    ends it; a failure is only lifted if it came from a check."""
    ended = status.isin("ok", "fail") & status.isNotNull()
    return F.when(skip, F.when(ended, status).otherwise("skip")).when(~ok, "fail").when(~ended | ((status == "fail") & validated_before.eqNullSafe(False)), "ok").otherwise(status)


def checked(steps: DataFrame, validators: dict[str, Check]) -> DataFrame:
    """steps (obj_id, step, status, validated_before) after their checks: each registered check runs on its step's objects.
    An object that a check has no row for, or a null in it, is skipped: it stays as it ended. A check that can't even be
    planned (it raises, or lacks a column) fails its step for all its objects."""
    done = []
    for step, check in validators.items():
        own = steps.where(F.col("step") == step)
        try:
            found = check(own.select("obj_id")).select("obj_id", "ok", "skip")
        except Exception:  # whatever a registered check does wrong
            found = own.select("obj_id", F.lit(False).alias("ok"), F.lit(False).alias("skip"))
        answered = own.join(found, "obj_id", "left")
        silent = F.col("ok").isNull() | F.col("skip").isNull()
        ok, skip = F.coalesce("ok", F.lit(True)), F.when(silent, True).otherwise(F.col("skip"))
        done.append(answered.select("obj_id", "step", flipped(F.col("status"), F.col("validated_before"), ok, skip).alias("status")))
    rest = steps.where(~F.col("step").isin(*validators)).select("obj_id", "step", "status")
    return reduce(DataFrame.unionByName, [*done, rest])


def reason_of(entry_reason: Column, error: Column, missing: Column) -> Column:
    """Why a step failed: its reason, its error, or the first thing missing, its id cut to the prefix."""
    some = lambda c: F.when(c != "", c)
    first = F.get(missing, F.lit(0))
    parts = F.split(first, "/")
    short = F.when(F.size(parts) == 2, F.concat(F.lit("missing "), F.split_part(parts[0], F.lit("_"), F.lit(1)), F.lit("/"), parts[1])).otherwise(F.concat(F.lit("missing "), F.substring(first, 1, 50)))
    return F.coalesce(some(entry_reason), some(error), short)


def progress(objects: DataFrame, entries: DataFrame, steps: list[str], first: str) -> DataFrame:
    """objects (obj_id), entries (obj_id, step, status, n_ok, n_fail, n_skip) -> step, obj_ok, obj_fail, obj_absent, edit_ok,
    edit_fail, edit_skip, not_yet. Objects whose first step is skipped are left out; a step that nobody reached has its
    row too."""
    skipped = entries.where((F.col("step") == first) & (F.col("status") == "skip")).select("obj_id")
    o = objects.select("obj_id").distinct().join(skipped, "obj_id", "left_anti")
    every = o.select("obj_id", F.explode(F.array(*map(F.lit, steps))).alias("step")).join(entries, ["obj_id", "step"], "left")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"edit_{c[2:]}")
    is_ = lambda s: F.count_if(F.coalesce(F.col("status") == s, F.lit(False)))
    rows = every.groupBy("step").agg(is_("ok").alias("obj_ok"), is_("fail").alias("obj_fail"), F.count_if(F.col("status").isNull()).alias("obj_absent"), n("n_ok"), n("n_fail"), n("n_skip"))
    kept = entries.where(F.col("step") == first).agg(F.coalesce(F.sum("n_ok"), F.lit(0)).alias("kept"))
    return rows.crossJoin(F.broadcast(kept)).withColumn("not_yet", F.greatest(F.lit(0), F.col("kept") - F.col("edit_ok") - F.col("edit_fail") - F.col("edit_skip"))).drop("kept")


def progress_totals(objects: DataFrame, entries: DataFrame, first: str, last: str) -> DataFrame:
    """One row over all objects: n_total, n_skipped (their first step is skipped, so progress() leaves them out), kept (edits
    that the first step gave), passed, failed, skipped (edits by the last step)."""
    o = objects.select("obj_id").distinct()
    at = lambda step, c: F.coalesce(F.sum(F.when(F.col("step") == step, F.col(c))), F.lit(0))
    e = entries.join(o, "obj_id", "left_semi")
    n = e.agg(F.countDistinct(F.when((F.col("step") == first) & (F.col("status") == "skip"), F.col("obj_id"))).alias("n_skipped"), at(first, "n_ok").alias("kept"), at(last, "n_ok").alias("passed"), at(last, "n_fail").alias("failed"), at(last, "n_skip").alias("skipped"))
    return o.agg(F.count(F.lit(1)).alias("n_total")).crossJoin(F.broadcast(n))  # a row each


def compared_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs' verdicts (obj_id, edit_id, passed: null where a run didn't judge) -> obj_id, n, a_pass, b_pass,
    pass_to_fail, fail_to_pass over the edits that either judged; what one of them didn't judge didn't pass there."""
    side = lambda run, n: run.groupBy("obj_id", "edit_id").agg(F.max("passed").alias(n))
    j = side(a, "a").join(side(b, "b"), ["obj_id", "edit_id"], "full_outer").where("a is not null or b is not null")
    j = j.select("obj_id", F.coalesce("a", F.lit(False)).alias("a"), F.coalesce("b", F.lit(False)).alias("b"))
    return j.groupBy("obj_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("a").alias("a_pass"), F.count_if("b").alias("b_pass"), F.count_if(F.col("a") & ~F.col("b")).alias("pass_to_fail"), F.count_if(F.col("b") & ~F.col("a")).alias("fail_to_pass"))


def pending_objects(objects: DataFrame, entries: DataFrame, steps: list[str], asked: list[str] | None, gate: str, lacking: DataFrame) -> DataFrame:
    """Objects with work left: a step that is neither ok nor skipped, a gate that an earlier run didn't do for all the types
    asked for, or edits without their output (lacking: obj_id)."""
    every = objects.select("obj_id").distinct().select("obj_id", F.explode(F.array(*map(F.lit, steps))).alias("step")).join(entries.select("obj_id", "step", "status", "only_types"), ["obj_id", "step"], "left")
    only = F.coalesce("only_types", F.array().cast("array<string>"))
    wanted = F.array(*map(F.lit, asked or [])).cast("array<string>")
    open_step = ~F.coalesce(F.col("status").isin("ok", "skip"), F.lit(False))
    part = (F.col("step") == gate) & F.lit(bool(asked)) & (F.size(only) > 0) & (F.size(F.array_except(wanted, only)) > 0)
    return every.where(open_step | part).select("obj_id").union(lacking.join(objects.select("obj_id"), "obj_id", "left_semi").select("obj_id")).distinct()


def gate_coverage(edits: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """edits (obj_id, edit_type, final_pass, has_gate, only_types of the object's run) -> obj_id, expected, found, ok, skip:
    edits that failed before, or of types that the run wasn't for, aren't expected to have the gate. Of objects (obj_id)
    those without edits have their row too: nothing expected, skipped."""
    only = F.coalesce("only_types", F.array().cast("array<string>"))
    due = ((F.size(only) == 0) | F.array_contains(only, F.lower("edit_type"))) & F.coalesce("final_pass", F.lit(True))
    n = edits.groupBy("obj_id").agg(F.count_if(due).alias("expected"), F.count_if(due & F.col("has_gate")).alias("found"))
    if objects is not None:
        n = objects.select("obj_id").distinct().join(n, "obj_id", "left").na.fill(0, ["expected", "found"])
    return n.withColumn("ok", F.col("expected") == F.col("found")).withColumn("skip", F.col("expected") == 0)


def object_manifest(states: DataFrame) -> DataFrame:
    """states (shard, obj_id, step, status, updated) -> shard, obj_id, steps (map), updated; in order."""
    m = states.groupBy("shard", "obj_id").agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("step", "status")))).alias("steps"), F.max("updated").alias("updated"))
    return m.orderBy("shard", "obj_id")


#: A metric: takes the pairs, returns pair_id, value, passed, weight and, if it has any, reason.
Metric = Callable[[DataFrame], DataFrame]


def measured(pairs: DataFrame, metrics: dict[str, Metric]) -> DataFrame:
    """Rows pair_id, name, value, passed, weight, reason: one for each pair and registered metric, whatever the metric does.
    One that can't be planned (it raises, or lacks a column) fails for all pairs, one that says nothing of a pair, or has
    no value or verdict for it, fails for that pair: with value 0, weight 1 and the reason."""
    ids, done = pairs.select("pair_id").distinct(), []
    for name, metric in metrics.items():
        try:
            found = metric(pairs)
            why = F.col("reason") if "reason" in found.columns else F.lit(None)
            found = found.select("pair_id", F.col("value").cast("double").alias("value"), "passed", F.col("weight").cast("double").alias("weight"), why.cast("string").alias("reason"))
        except Exception as e:  # whatever a registered metric does wrong
            found = ids.select("pair_id", *[F.lit(None).cast(t).alias(c) for c, t in (("value", "double"), ("passed", "boolean"), ("weight", "double"))], F.lit(f"error: {type(e).__name__}").alias("reason"))
        lost = F.col("value").isNull() | F.isnan("value") | F.col("passed").isNull()
        done.append(ids.join(found, "pair_id", "left").select("pair_id", F.lit(name).alias("name"), F.when(lost, 0.0).otherwise(F.col("value")).alias("value"), F.when(lost, False).otherwise(F.col("passed")).alias("passed"), F.when(lost, 1.0).otherwise(F.coalesce("weight", F.lit(1.0))).alias("weight"), F.when(lost, F.coalesce("reason", F.lit("no value"))).otherwise(F.col("reason")).alias("reason")))
    return reduce(DataFrame.unionByName, done)


def of_each_pair(measure: Callable[[pd.DataFrame], tuple[float, bool]], weight: float = 1.0) -> Metric:
    """A metric from a Python function of one pair's rows. Where it raises, that pair's row fails and names the error; the
    job goes on."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            value, passed, why = *measure(rows), None
        except Exception as e:  # becomes a row
            value, passed, why = None, None, f"error: {type(e).__name__}"
        return pd.DataFrame({"pair_id": [rows["pair_id"].iloc[0]], "value": [value], "passed": [passed], "weight": [weight], "reason": [why]})

    return lambda pairs: pairs.groupBy("pair_id").applyInPandas(one, f"pair_id {pairs.schema['pair_id'].dataType.simpleString()}, value double, passed boolean, weight double, reason string")


#: A builder of masks: takes specs (spec_id, pair_id, pids) and cells, returns rows with the spec_id of those it has a mask for.
Builder = Callable[[DataFrame, DataFrame], DataFrame]


def masks(edits: DataFrame, cells: DataFrame, builder: Builder) -> tuple[DataFrame, DataFrame]:
    """edits (edit_id, pair_id, pids) -> (what the builder makes of their specs, edits as edit_id, spec_id, built).

    A spec is a pair and a set of parts: edits of the same ones share its mask, which is made and held once. Where the
    builder makes nothing of a spec, its edits are skipped (built is false); a null list of parts is an empty one."""
    parts = F.array_sort(F.array_distinct(F.coalesce("pids", F.array().cast(edits.schema["pids"].dataType))))
    named = edits.select("edit_id", F.struct("pair_id", parts.alias("pids")).alias("spec_id"))
    made = builder(named.select("spec_id").distinct().select("spec_id", "spec_id.*"), cells)
    built = made.select(F.col("spec_id").alias("_of"), F.lit(True).alias("built")).distinct()
    # the null pair is a pair of its own
    j = named.join(built, F.col("spec_id").eqNullSafe(F.col("_of")), "left")
    return made, j.select("edit_id", "spec_id", F.coalesce("built", F.lit(False)).alias("built"))
