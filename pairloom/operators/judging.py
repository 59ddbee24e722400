"""Judge thresholds, scores, tiers, records and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.edits import of_object

# Thresholds by version of the rule, before overrides by type.
DEFAULTS = {
    1: {"min_visual_quality": 3, "require_preserve_other": True},
    2: {"min_mesh_quality": 4, "min_edit_strength": 2, "min_visual_quality": 2, "require_preserve_other": True},
    3: {"min_visual_quality": 3, "require_preserve_other": True},
}
# Weights of the composite score, and what a judgement says that was never made.
WEIGHTS = {"edit_executed": 0.3, "correct_region": 0.2, "preserve_other": 0.2, "visual_quality": 0.2, "artifact_free": 0.1}
NO_RESPONSE, EVALUATION_ERROR = "VLM returned no valid response", "Evaluation error"
# Why gate E fails what its judge never saw, or gave no answer to.
UNSEEN, UNANSWERED = "missing_previews", "vlm_no_response"


def _is(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _whole(c: str) -> Column:
    """A score as a whole number; 0 if it isn't one."""
    return F.coalesce(F.col(c).try_cast("int"), F.lit(0))


def passes(version: int, overrides: dict[str, dict] | None = None) -> Column:
    """Whether a judgement passes, by version of the rule. overrides: edit type -> thresholds that replace the defaults."""

    def limit(name: str) -> Column:
        out = F.lit(DEFAULTS[version][name])
        for kind, own in (overrides or {}).items():
            out = F.when(F.col("edit_type") == kind, F.lit(own[name])).otherwise(out) if name in own else out
        return out

    common = (_whole("visual_quality") >= limit("min_visual_quality")) & _is("correct_region") & (_is("preserve_other") | ~limit("require_preserve_other"))
    if version == 2:
        strength = F.when(F.col("edit_strength").isNull(), F.when(_is("edit_executed"), 1).otherwise(0)).otherwise(_whole("edit_strength"))
        return (_whole("mesh_quality") >= limit("min_mesh_quality")) & (strength >= limit("min_edit_strength")) & common
    return _is("edit_executed") & common & _is("artifact_free") if version == 3 else _is("edit_executed") & common


def composite() -> Column:
    """Weighted score of a judgement, rounded half to even."""
    one = lambda c: F.lit(WEIGHTS[c]) * F.when(_is(c), 1.0).otherwise(0.0)
    quality = WEIGHTS["visual_quality"] * (F.greatest(F.lit(0), F.col("visual_quality") - 1) / 4)
    return F.bround(one("edit_executed") + one("correct_region") + one("preserve_other") + quality + one("artifact_free"), 4)


def tier(score: Column, passed: Column) -> Column:
    return F.when(~passed, "negative").when(score >= 0.8, "high").when(score >= 0.6, "medium").when(score >= 0.4, "low").otherwise("negative")


def judge_tier(score: Column, reason: Column) -> Column:
    """Tier of a judgement by what it says: rejected where there was none, negative where the edit failed, then by how
    clean and good it is."""
    none = (score == 0) & ~_is("edit_executed") & F.coalesce(reason.startswith(EVALUATION_ERROR) | (reason == NO_RESPONSE), F.lit(False))
    clean, vq = _is("preserve_other") & _is("artifact_free"), F.coalesce("visual_quality", F.lit(0))
    return F.when(none, "rejected").when(~_is("edit_executed") | ~_is("correct_region"), "negative").when(clean & (vq >= 4), "high").when(clean & (vq >= 3), "medium").when(vq >= 2, "low").otherwise("negative")


# What an addition has of its deletion besides tier and score, and what it is where the deletion lacks it.
INHERITED = {"edit_executed": False, "correct_region": False, "preserve_other": False, "visual_quality": 0, "artifact_free": False}


def inherited_scores(additions: DataFrame, scores: DataFrame) -> DataFrame:
    """additions (obj_id, edit_id, source_del_seq), scores (obj_id, edit_id, seq, tier, score, and what INHERITED names, as
    far as it is there) of deletions -> obj_id, edit_id, tier, score, INHERITED, source, reason: an addition has its
    deletion's score and judgement; without one it has no row."""
    rest = [F.coalesce(F.col(c) if c in scores.columns else F.lit(None), F.lit(v)).alias(c) for c, v in INHERITED.items()]
    label, score = F.coalesce("tier", F.lit("rejected")).alias("tier"), F.coalesce("score", F.lit(0.0)).alias("score")
    own = scores.select("obj_id", F.col("seq").alias("source_del_seq"), label, score, *rest, F.col("edit_id").alias("source"))
    return of_object(additions, own, "source_del_seq", outer=False).select("obj_id", "edit_id", "tier", "score", *INHERITED, "source", F.concat(F.lit("Inherited from "), "source").alias("reason"))


def rolled_up(manifest: DataFrame, scores: DataFrame, *keys: str) -> DataFrame:
    """manifest (keys, edit_id, edit_type), scores (edit_id, tier, score) -> keys, num_edits, num_passed, edits: identities
    are high, what isn't scored is rejected. An object's edits are few; if both sides have obj_id, they stay together."""
    own = ["obj_id"] if {"obj_id"} <= {*manifest.columns} & {*scores.columns} else []
    found = scores.select(*own, "edit_id", "tier", "score")
    j = of_object(manifest, found, "edit_id") if own else manifest.join(found, "edit_id", "left")
    same = F.col("edit_type") == "identity"
    label = F.when(same, "high").otherwise(F.coalesce("tier", F.lit("rejected")))
    e = F.struct("edit_id", label.alias("tier"), F.when(same, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"))
    return j.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_edits"), F.count_if(label.isin("high", "medium")).alias("num_passed"), F.sort_array(F.collect_list(e)).alias("edits"))


def judge_work(specs: DataFrame, records: DataFrame, done: DataFrame, asked: list[str] | None = None, force: bool = False) -> DataFrame:
    """specs (obj_id, edit_id, edit_type), records (obj_id, status, only_types) of earlier runs, done (edit_id) -> the edits
    that gate E has to judge.

    An object is left out if its record is ok and was of all types, or of all those that are asked for. Deletions are
    never judged, nor what has its verdict, unless forced."""
    wanted = F.array(*map(F.lit, asked or [])).cast("array<string>")
    only = F.coalesce("only_types", F.array().cast("array<string>"))
    covered = (F.col("status") == "ok") & ((F.size(only) == 0) | (F.lit(bool(asked)) & (F.size(F.array_except(wanted, only)) == 0)))
    work = specs if force else specs.join(records.where(covered).select("obj_id"), "obj_id", "left_anti").join(done.select("edit_id"), "edit_id", "left_anti")
    work = work.where(F.col("edit_type") != "deletion")
    return work if asked is None else work.where(F.col("edit_type").isin(*asked))


def judge_records(work: DataFrame, judged: DataFrame, passed: Column) -> DataFrame:
    """work (edit_id, edit_type, has_preview), judged (edit_id and a judgement) -> edit_id, ok, score, reason: fails with a
    fixed reason where there is nothing to look at or no answer. passed: see passes()."""
    j = work.join(judged.withColumn("_answered", F.lit(True)), "edit_id", "left")
    seen, answered = F.coalesce("has_preview", F.lit(False)), F.col("_answered").isNotNull()
    why = F.when(~seen, UNSEEN).when(~answered, UNANSWERED).otherwise(F.coalesce("reason", F.lit("")))
    return j.select("edit_id", "edit_type", (seen & answered & passed).alias("ok"), F.when(seen & answered, F.bround(_whole("visual_quality") / 5, 2)).otherwise(0.0).alias("score"), why.alias("reason"))


def thresholds(version: int, overrides: dict[str, dict] | None = None) -> Column:
    """The thresholds that passes() holds a judgement of an edit_type against, as a map of their names."""

    def of(own: dict) -> Column:
        pairs = [F.lit(x) for name, v in {**DEFAULTS[version], **own}.items() for x in (name, str(v).lower())]
        return F.create_map(*pairs)

    out = of({})
    for kind, own in (overrides or {}).items():
        out = F.when(F.col("edit_type") == kind, of(own)).otherwise(out)
    return out


def judge_audit(work: DataFrame, judged: DataFrame, system: str, version: int = 1, overrides: dict | None = None) -> DataFrame:
    """work (edit_id, edit_type, has_preview, request: see texts.judge_request; conditions array<string>, if there), judged
    (edit_id and a judgement) -> edit_id, edit_type, ok, judge_version, conditions, thresholds, judge (all that judged has),
    prompt (system, user): a row for each edit that was seen and judged, with what the judge was sent."""
    answer = judged.select("edit_id", *[c for c in judged.columns if c not in work.columns], F.struct(*[c for c in judged.columns if c != "edit_id"]).alias("judge"))
    j = work.where("has_preview").join(answer, "edit_id")
    shown = F.coalesce("conditions", F.array().cast("array<string>")) if "conditions" in work.columns else F.array().cast("array<string>")
    return j.select(
        "edit_id", "edit_type", passes(version, overrides).alias("ok"), F.lit(f"v{version}").alias("judge_version"), shown.alias("conditions"),
        thresholds(version, overrides).alias("thresholds"), "judge", F.struct(F.lit(system).alias("system"), F.col("request").alias("user")).alias("prompt"),
    )


def refined_prompts(records: DataFrame, judged: DataFrame) -> DataFrame:
    """records of judge_records(), judged (edit_id, prompt, improved_prompt, and improved_after_desc, prompt_quality as far as
    they are there) -> edit_id, original, improved, improved_after, prompt_quality, judge_pass, for_addition,
    after_for_addition: the texts that replace an addition's, if the judge has better ones. What the judge never saw has no
    row."""
    there = lambda c: F.col(c) if c in judged.columns else F.lit(None)
    said = judged.select("edit_id", "prompt", F.coalesce("improved_prompt", F.lit("")).alias("improved"), F.coalesce(there("improved_after_desc").cast("string"), F.lit("")).alias("improved_after"), there("prompt_quality").cast("int").alias("prompt_quality"))
    j = records.where(F.col("reason") != UNSEEN).join(said, "edit_id")
    better = (F.col("edit_type") == "addition") & (F.col("improved") != "")
    after = F.when(better & (F.col("improved_after") != ""), F.col("improved_after"))
    return j.select("edit_id", F.col("prompt").alias("original"), "improved", "improved_after", "prompt_quality", F.col("ok").alias("judge_pass"), F.when(better, F.col("improved")).alias("for_addition"), after.alias("after_for_addition"))


def gate_two(edits: DataFrame, judged: DataFrame, overrides: dict | None = None) -> DataFrame:
    """edits (edit_id, edit_type, gate_a_failed, has_preview), judged -> records of the gate on 2-D edits: those that gate A
    failed or that have no input are left out."""
    work = edits.where(~F.coalesce("gate_a_failed", F.lit(False)) & F.coalesce("has_preview", F.lit(False)))
    return judge_records(work, judged, passes(1, overrides))


def gate_one(edits: DataFrame) -> DataFrame:
    """edits (edit_id, codes, most_px, has_overview, best, reply: see replies.alignment, answered) -> edit_id, ok, score,
    reason, best_view.

    Rules come first, then whether any view shows the parts, then the judge. Without an overview there is nothing to
    judge and the edit passes."""
    shown = F.array(F.col("best"), *map(F.lit, range(4)))
    view = F.coalesce(F.when(F.col("reply.best_view").between(0, 4), F.get(shown, F.col("reply.best_view"))), F.lit(0))
    # fixed values: the reasons
    ok = F.when(F.size("codes") > 0, False).when(~F.col("has_overview"), True).when(F.col("most_px") <= 0, False).when(F.col("reply").isNull(), False).otherwise(F.col("reply.aligned"))
    why = F.when(F.size("codes") > 0, F.get("codes", F.lit(0))).when(~F.col("has_overview"), "no_overview_auto_pass").when(F.col("most_px") <= 0, "zero_visible_pixels").when(F.col("reply").isNull(), "vlm_error").otherwise(F.coalesce("reply.reason", F.lit("")))
    judged = (F.size("codes") == 0) & F.col("has_overview") & (F.col("most_px") > 0) & F.col("reply").isNotNull()
    return edits.select("edit_id", ok.alias("ok"), F.when(ok, 1.0).otherwise(0.0).alias("score"), why.alias("reason"), F.when(judged, view).alias("best_view"))
