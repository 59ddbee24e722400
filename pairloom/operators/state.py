"""Stage state: latest records from an append-only log, gates, funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stages in order; gate stages end in pass or fail, others in done or error.
STAGES = ("gate_a", "s4", "gate_c", "s5", "gate_e")


def latest(events: DataFrame) -> DataFrame:
    """One row for each edit and stage: status and ts of the last write, best_view and score of the last that has one.
    Maxima of structs combine before the shuffle, so a much-written edit costs no more than its map tasks."""
    order = F.struct("ts", "seq")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    return events.groupBy("obj_id", "edit_id", "stage").agg(F.max_by("status", order).alias("status"), last("best_view"), last("score"), F.max("ts").alias("ts"))


def stage_funnel(state: DataFrame) -> DataFrame:
    """stage, stage_no, pass_done, fail, error, eligible, pending; stages without edits have zeros. One pass: each edit
    becomes a row of its stages' statuses, and those are counted."""
    wide = state.groupBy("obj_id", "edit_id").agg(*[F.max(F.when(F.col("stage") == s, F.col("status"))).alias(s) for s in STAGES])
    n = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    rows = []
    for i, s in enumerate(STAGES):
        done, fail, error = n(F.col(s).isin("pass", "done")), n(F.col(s) == "fail"), F.lit(0).cast("long") if s.startswith("gate") else n(F.col(s) == "error")
        eligible = done + fail + error
        pending = F.count(F.lit(1)) - eligible if i == 0 else F.lit(0).cast("long")
        rows.append(F.struct(F.lit(s).alias("stage"), F.lit(i).alias("stage_no"), done.alias("pass_done"), fail.alias("fail"), error.alias("error"), eligible.alias("eligible"), pending.alias("pending")))
    return wide.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def gates(state: DataFrame) -> DataFrame:
    """One row for each edit: status of each gate, final_pass (a gate that is missing passes), the first that fails."""
    wide = state.groupBy("obj_id", "edit_id").pivot("stage", ["gate_a", "gate_c", "gate_e"]).agg(F.first("status"))
    failed = F.coalesce(*[F.when(F.col(g) == "fail", F.lit(g)) for g in ("gate_a", "gate_c", "gate_e")])
    return wide.withColumn("fail_gate", failed).withColumn("final_pass", failed.isNull())


def not_passed(gate: str, name: str) -> Column:
    """What a gate says other than pass, as gate_X='fail', or gate_X=None where it says nothing; null if it passes."""
    return F.when(~F.col(gate).eqNullSafe("pass"), F.concat(F.lit(f"gate_{name}="), F.coalesce(F.concat(F.lit("'"), F.col(gate), F.lit("'")), F.lit("None"))))


def accept_generated(wide: DataFrame) -> DataFrame:
    """Strict acceptance: gate A and then gate E must say pass; reason names the first that doesn't."""
    reason = F.coalesce(not_passed("gate_a", "A"), not_passed("gate_e", "E"))
    return wide.withColumn("reason", reason).withColumn("accepted", reason.isNull())


def needs_stage(state: DataFrame, stage: str, prerequisite: str | None, force: bool = False) -> DataFrame:
    """Edits that are to go through a stage: the gate before it has passed, and the stage has no record or an error,
    unless forced. Additions need no gate A, as they undo a deletion that had it; any other gate holds for them, too."""
    own, gate = F.col("stage") == stage, F.col("stage") == (prerequisite or "")
    wide = state.groupBy("obj_id", "edit_id").agg(F.max(own).alias("seen"), F.max(F.when(own, F.col("status"))).alias("own"), F.max(F.when(gate, F.col("status"))).alias("gate"))
    open_gate = F.lit(True) if prerequisite is None else F.col("gate").eqNullSafe("pass")
    open_gate = open_gate | F.col("edit_id").startswith("add_") if prerequisite == "gate_a" else open_gate
    due = F.lit(True) if force else ~F.col("seen") | F.col("own").eqNullSafe("error")
    return wide.where(open_gate & due).select("obj_id", "edit_id")


def prerequisites(active: set[str]) -> dict[str, str | None]:
    """The gate that must have passed before each step, from the steps that are switched on."""
    # fixed values: the steps that make a gate active (by either name), and the gates of each step in order of preference
    on = {"gate_a": {"gate_text_align", "sq1"}, "gate_c": {"gate_2d", "sq2"}, "gate_e": {"gate_quality", "sq3"}}
    needs = {"s4": ("gate_a",), "s5": ("gate_c", "gate_a"), "s5b": ("gate_a",), "s6p": ("gate_a",), "s6b": ("gate_e",)}
    return {step: next((g for g in gates if on[g] & active), None) for step, gates in needs.items()}


def verdict_view(verdicts: DataFrame) -> DataFrame:
    """verdicts (obj_id, edit_id, gate, status, has_verdict, rule_pass, rule_code, vlm_pass, vlm_reason, legacy_pass) ->
    obj_id, edit_id, a, c, e (whether each gate passes; one that is missing does), fail_gate, fail_reason, final_pass.

    A gate's payload is its verdict, else its status if that is pass or fail, else what an old record says. The reason
    is that of the first gate that fails: the rule's code, else 80 characters of the judge's reason."""
    own = F.col("has_verdict") & (F.col("rule_pass").isNotNull() | F.col("vlm_pass").isNotNull())
    said = F.col("status").isin("pass", "fail")
    v = verdicts.select("obj_id", "edit_id", "gate", F.when(own, F.col("rule_pass")).alias("r"), F.when(own, F.col("vlm_pass")).when(said, F.col("status") == "pass").otherwise(F.col("legacy_pass")).alias("v"), "rule_code", F.when(own, F.col("vlm_reason")).when(said, F.lit("from_stage_status")).alias("why"))
    reason = F.when(~F.col("r"), F.coalesce("rule_code", F.lit("rule_fail"))).when(~F.col("v"), F.substring(F.coalesce("why", F.lit("vlm_fail")), 1, 80))
    v = v.withColumn("reason", reason)
    of = lambda g: F.max(F.when(F.col("gate") == g, F.col("reason")))
    wide = v.groupBy("obj_id", "edit_id").agg(of("gate_a").alias("ra"), of("gate_c").alias("rc"), of("gate_e").alias("re"))
    first = F.coalesce(*[F.when(F.col(f"r{g}").isNotNull(), F.lit(g.upper())) for g in "ace"])
    return wide.select("obj_id", "edit_id", *[F.col(f"r{g}").isNull().alias(g) for g in "ace"], first.alias("fail_gate"), F.coalesce("ra", "rc", "re").alias("fail_reason"), first.isNull().alias("final_pass"))


def gate_summary(state: DataFrame) -> DataFrame:
    """One row for each edit: status, ts and score of each gate, and final_pass."""
    gates_ = ("gate_a", "gate_c", "gate_e")
    pick = lambda g, c: F.max(F.when(F.col("stage") == g, F.col(c))).alias(f"{g}_{c}")
    wide = state.groupBy("obj_id", "edit_id").agg(*[pick(g, c) for g in gates_ for c in ("status", "ts", "score")])
    failed = [F.col(f"{g}_status").eqNullSafe("fail") for g in gates_]
    return wide.withColumn("final_pass", ~(failed[0] | failed[1] | failed[2]))
