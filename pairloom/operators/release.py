"""Release: instructions, promotion of edits to the dataset, export rows and the work that is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.edits import GENERATED, invert_prompt, of_object, paired_id, prefix_of, type_of
from pairloom.operators.rules import VIEWS

# The version of a release record, and the prefixes of edits that own no 'before' of their object.
SCHEMA_VERSION, BORROWING = 3, ("del_", "add_")


def _filled(c: str) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))


def instruction() -> Column:
    """What an edit's instruction says, from its plan's columns: prompt, object_desc, target_part_desc; new_parts_desc for
    modifications only; after_desc for generated edits and params where there are any. As JSON (to_json) what is null is
    left out."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    new = F.when(F.col("edit_type") == "modification", F.coalesce(_filled("new_parts_desc"), _filled("target_part_desc"), F.lit("")))
    after = F.when(F.col("edit_type").isin(*GENERATED), _filled("after_desc"))
    params = F.when(F.size(F.coalesce("params", F.create_map().cast("map<string,string>"))) > 0, F.col("params"))
    return F.struct(text("prompt"), text("object_desc"), text("target_part_desc"), new.alias("new_parts_desc"), after.alias("after_desc"), params.alias("edit_params"), F.lit(None).cast("boolean").alias("synthesized"))


def instructions(named: DataFrame) -> DataFrame:
    """Plans with ids -> obj_id, edit_id, instruction, with an addition for each deletion that has none: its prompt is the
    deletion's, inverted."""
    own = named.select("obj_id", "edit_id", instruction().alias("instruction"))
    null = lambda t: F.lit(None).cast(t)
    i = F.col("instruction")
    made = F.struct(invert_prompt(i["prompt"]).alias("prompt"), i["object_desc"].alias("object_desc"), i["target_part_desc"].alias("target_part_desc"), null("string").alias("new_parts_desc"), null("string").alias("after_desc"), null("map<string,string>").alias("edit_params"), F.lit(True).alias("synthesized"))
    additions = own.where(F.col("edit_id").startswith("del_")).select("obj_id", paired_id(F.col("edit_id")).alias("edit_id"), made.alias("instruction"))
    return own.union(additions.join(own.select("edit_id"), "edit_id", "left_anti").select("obj_id", "edit_id", "instruction"))


def backfilled_additions(deletions: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """deletions (obj_id, edit_id, prompt, pids) -> the addition that undoes each: obj_id, edit_id, prompt, pids,
    source_del_id, rationale. Those that exist (edit_id) are left out, unless forced."""
    made = deletions.select("obj_id", paired_id(F.col("edit_id")).alias("edit_id"), invert_prompt(F.col("prompt")).alias("prompt"), "pids", F.col("edit_id").alias("source_del_id"), F.concat(F.lit("inverse of "), "edit_id").alias("rationale"))
    return made if force else made.join(existing.select("edit_id"), "edit_id", "left_anti").select(made.columns)


def object_assets(assets: DataFrame) -> DataFrame:
    """assets (obj_id, edit_id, has_before, has_latent) -> obj_id, source: the edit whose 'before' stands for the object in
    all its edits (the first that has one, deletions and additions aside), else 'latent' if the object has one, else null."""
    own = F.col("has_before") & ~F.substring("edit_id", 1, 4).isin(*BORROWING)
    found = assets.groupBy("obj_id").agg(F.min(F.when(own, F.col("edit_id"))).alias("edit"), F.max("has_latent").alias("latent"))
    return found.select("obj_id", F.coalesce("edit", F.when(F.col("latent"), "latent")).alias("source"))


def after_sides(assets: DataFrame) -> DataFrame:
    """obj_id, edit_id, after_of, reason: the edit whose 'after' each edit is compared with (an addition's is its
    deletion's), or why there is none."""
    own = assets.select("obj_id", "edit_id", F.when(F.col("edit_id").startswith("add_"), paired_id(F.col("edit_id"))).otherwise(F.col("edit_id")).alias("of"))
    have = assets.where("has_after").select(F.col("edit_id").alias("of"), F.lit(True).alias("found"))
    joined = own.join(have, "of", "left")
    found = F.col("found").isNotNull()
    missing = F.when(F.col("edit_id").startswith("add_"), F.concat(F.lit("no after of "), "of")).otherwise(F.lit("no after"))
    return joined.select("obj_id", "edit_id", F.when(found, F.col("of")).alias("after_of"), F.when(~found, missing).alias("reason"))


def promoted(edits: DataFrame) -> DataFrame:
    """edits (obj_id, edit_id, view, source: the object's asset, has_before, has_after, has_image) -> with edit_type, ok,
    reason.

    Deletions need their after, generated edits a before and an after, additions the deletion that they undo in the
    dataset, with its image; all of them need the object's asset and a view that is one (see choice.resolved_views, which
    gives deletions and additions a default)."""
    e = edits.withColumn("edit_type", type_of(F.col("edit_id")))
    common = F.when(F.col("source").isNull(), "no asset of the object")
    viewless = F.when(~F.coalesce(F.col("view").between(0, VIEWS - 1), F.lit(False)), "no view")
    deletion = F.coalesce(F.when(~F.col("has_after"), "no after"), common, viewless)
    generated = F.coalesce(F.when(~F.col("has_before"), "no before"), F.when(~F.col("has_after"), "no after"), common, viewless)
    first = e.withColumn("reason", F.when(F.col("edit_type") == "deletion", deletion).when(F.col("edit_type") != "addition", generated))
    pair = Window.partitionBy("obj_id", F.substring("edit_id", 5, 1 << 20))
    partner = F.max(F.when((F.col("edit_type") == "deletion") & F.col("reason").isNull(), F.col("has_image"))).over(pair)
    addition = F.coalesce(F.when(F.col("_partner").isNull(), "its deletion is not promoted"), common, F.when(~F.col("_partner"), "no image of its deletion"), viewless)
    out = first.withColumn("_partner", partner).withColumn("reason", F.when(F.col("edit_type") == "addition", addition).otherwise(F.col("reason")))
    return out.drop("_partner").withColumn("ok", F.col("reason").isNull())


def base_records(promoted_edits: DataFrame, instructions_: DataFrame, quality: DataFrame, source: str = "objects", version: str = "v3") -> DataFrame:
    """Release records of the edits that are promoted: ids, schema_version, instruction, view, quality, lineage. An edit
    without an instruction has an empty one."""
    own = promoted_edits.where("ok").select("obj_id", "edit_id", "edit_type", "view")
    own = own.join(instructions_.select("edit_id", "instruction"), "edit_id", "left").join(quality.drop("obj_id"), "edit_id", "left")
    return own.select("obj_id", "edit_id", "edit_type", F.lit(SCHEMA_VERSION).alias("schema_version"), "instruction", F.struct(F.col("view").alias("best_view_index")).alias("views"), F.struct("final_pass", "alignment", "quality").alias("quality"), F.struct(F.lit(version).alias("pipeline_version"), F.lit(source).alias("source_dataset")).alias("lineage"))


def training_records(edits: DataFrame, quality: DataFrame, root: str = "") -> DataFrame:
    """edits (edit_id, edit_type, obj_id, shard, prompt, pids, object_desc, target_part_desc, new_part_desc, after_desc),
    quality (edit_id, tier, score, checks map<string, boolean>, and best obj_id too: then rows stay with their objects) -> a flat record of 17 fields for each edit, and the paths
    of its two meshes. Parts of deletions and modifications are removed ones, those of additions and modifications added
    ones. What isn't known is empty: '', 0.0, no list entries; only the donor of a swap is null."""
    c, text = F.col, lambda name: F.coalesce(F.col(name), F.lit(""))
    none = F.array().cast("array<int>")
    parts = lambda *kinds: F.when(c("edit_type").isin(*kinds), F.coalesce("pids", none)).otherwise(none)
    mesh = lambda side: F.concat(F.lit(f"{root}meshes/"), c("edit_id"), F.lit(f"_{side}.ply"))
    fields = {
        "edit_id": c("edit_id"), "edit_type": c("edit_type"), "instruction": text("prompt"), "instruction_variants": F.array().cast("array<string>"), "source_obj_id": c("obj_id"), "source_shard": text("shard"), "donor_obj_id": F.lit(None).cast("string"),
        "removed_part_ids": parts("deletion", "modification"), "added_part_ids": parts("addition", "modification"), "old_part_label": text("target_part_desc"), "new_part_label": text("new_part_desc"), "object_desc": text("object_desc"), "edit_prompt": text("prompt"), "after_desc": text("after_desc"),
        "quality_tier": text("tier"), "quality_score": F.coalesce("score", F.lit(0.0)), "quality_checks": F.coalesce("checks", F.create_map().cast("map<string,boolean>")), "before_mesh": mesh("before"), "after_mesh": mesh("after"),
    }
    own = quality.select(*[c for c in ("obj_id",) if c in quality.columns], "edit_id", "tier", "score", "checks")
    found = of_object(edits, own, "edit_id") if "obj_id" in own.columns else edits.join(own, "edit_id", "left")
    return found.select(*[v.alias(k) for k, v in fields.items()])


def manifest_lines(records: DataFrame) -> DataFrame:
    """edit_type, shard, obj_id, edit_id, line: each record as a line of JSON, without what is null."""
    return records.select("edit_type", "obj_id", "edit_id", F.to_json(F.struct(*records.columns)).alias("line"))


def promotion_log(promoted_edits: DataFrame, at: Column, version: str = "v3") -> DataFrame:
    """What is kept out of released records: when an edit was promoted and by what."""
    return promoted_edits.where("ok").select("edit_id", "edit_type", at.alias("promoted_at"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(version).alias("pipeline_version"))


def addition_instructions(additions: DataFrame, own: DataFrame, deletions: DataFrame) -> DataFrame:
    """additions (edit_id) -> edit_id, prompt: its own record's (edit_id, prompt), else its deletion's, inverted."""
    a = additions.select("edit_id").join(own.select("edit_id", _filled("prompt").alias("own")), "edit_id", "left")
    d = deletions.select(paired_id(F.col("edit_id")).alias("edit_id"), invert_prompt(F.col("prompt")).alias("inverse"))
    return a.join(d, "edit_id", "left").select("edit_id", F.coalesce("own", "inverse", F.lit("")).alias("prompt"))


def mirrored(deletions: DataFrame) -> DataFrame:
    """deletions (obj_id, edit_id, prompt, pids, full, reduced) -> each with the addition that mirrors it: sides swapped,
    parts the same."""
    same = [F.col(c) for c in ("obj_id", "pids")]
    kept = deletions.select(*same, "edit_id", "prompt", F.col("full").alias("before"), F.col("reduced").alias("after"))
    return kept.union(deletions.select(*same, paired_id(F.col("edit_id")), invert_prompt(F.col("prompt")), F.col("reduced"), F.col("full")))


def surviving_cells(cells: DataFrame, selected: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """cells (key, part_id, ...), selected (key, pids) -> (the cells of the other parts, key and rejected: whether nothing
    is left)."""
    joined = cells.join(selected.select(key, "pids"), key)
    gone = F.array_contains("pids", F.col("part_id"))
    left = joined.groupBy(key).agg(F.count_if(~gone).alias("n_left")).withColumn("rejected", F.col("n_left") == 0)
    return joined.where(~gone).drop("pids"), left


def merged_results(manifest: DataFrame, results: DataFrame, least: float) -> DataFrame:
    """manifest rows with the score of their result (edit_id, score), if it is enough; best first."""
    return manifest.join(results.where(F.col("score") >= least).select("edit_id", "score"), "edit_id").orderBy(F.desc("score"), "edit_id")


def gallery(state: DataFrame, before: DataFrame, after: DataFrame, requested: int, per_shard: int, views: int = 5, judged: DataFrame | None = None) -> DataFrame:
    """Edits that gate E passes, with the first view that both sides are rendered from (obj_id, edit_id, view): the one
    their gate matched, the requested one, then the rest in order; at most per_shard of a shard -> shard, obj_id, edit_id,
    view, matched (it is the gate's), score, nth. With judged (edit_id, original, improved, visual_quality, reason) also
    prompt (the improved one, else the original), original, visual_quality and description; texts that aren't there are
    empty."""
    best_view = F.max(F.when(F.col("stage") == "gate_a", F.col("best_view")))
    passed = state.groupBy("obj_id", "shard", "edit_id").agg(F.max(F.when(F.col("stage") == "gate_e", F.col("status"))).alias("e"), F.when(best_view.between(0, views - 1), best_view).alias("own"), F.max(F.when(F.col("stage") == "gate_e", F.col("score"))).alias("score"))
    order = F.array_distinct(F.array_compact(F.array(F.col("own"), F.lit(requested), *[F.lit(v) for v in range(views)])))
    wanted = passed.where("e = 'pass'").select("obj_id", "shard", "edit_id", "own", "score", F.posexplode(order).alias("place", "view"))
    keys = ["edit_id", "view"]
    shown = wanted.join(before.select(*keys).distinct(), keys, "left_semi").join(after.select(*keys).distinct(), keys, "left_semi")
    best = shown.groupBy("shard", "obj_id", "edit_id").agg(F.min_by("view", "place").alias("view"), F.max("own").alias("own"), F.max("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("shard").orderBy("edit_id"))
    best = best.withColumn("nth", nth).where(F.col("nth") <= per_shard)
    best = best.select("shard", "obj_id", "edit_id", "view", F.coalesce(F.col("view") == F.col("own"), F.lit(False)).alias("matched"), "score", "nth")
    if judged is None:
        return best
    said = judged.groupBy("edit_id").agg(F.max_by(F.struct("original", "improved", "visual_quality", "reason"), F.struct("improved", "original", "visual_quality", "reason")).alias("j"))
    text = lambda *c: F.coalesce(*map(_filled, c), F.lit(""))
    return best.join(said, "edit_id", "left").select(*best.columns, text("j.improved", "j.original").alias("prompt"), text("j.original").alias("original"), "j.visual_quality", text("j.reason").alias("description"))


def repaste_list(assets: DataFrame, passed: DataFrame, done: DataFrame) -> DataFrame:
    """assets (edit_id, has_latent, n_rows, n_stored), passed (edit_id, view) of gate E, done (edit_id) -> edit_id, view,
    error: what is to be pasted again; rows that don't match in number are an error."""
    due = assets.where("has_latent").join(passed.where(F.col("view").isNotNull()), "edit_id").join(done.select("edit_id"), "edit_id", "left_anti")
    return due.select("edit_id", "view", F.when(F.col("n_rows") != F.col("n_stored"), F.concat(F.lit("rows differ: "), "n_rows", F.lit(", "), "n_stored")).alias("error"))


def repaste_rows(pasted: DataFrame, prompts: DataFrame) -> DataFrame:
    """pasted (edit_id, tokens, preserved) with the refined prompt, else the original one, else ''."""
    return pasted.join(prompts, "edit_id", "left").select("edit_id", "tokens", "preserved", F.coalesce(_filled("improved"), _filled("original"), F.lit("")).alias("prompt"))


def pending_pairs(deletions: DataFrame, listing: DataFrame, files: tuple[str, ...], force: bool = False) -> DataFrame:
    """deletions (obj_id, edit_id), listing (edit_id, file, size) -> objects that have a deletion of which some file, its
    own or its addition's, isn't there or empty (any deletion, if forced)."""
    both = F.explode(F.array(F.col("edit_id"), paired_id(F.col("edit_id")))).alias("edit_id")
    need = deletions.select("obj_id", both).select("obj_id", "edit_id", F.explode(F.array(*map(F.lit, files))).alias("file"))
    full = listing.where("size > 0").select("edit_id", "file").distinct()
    return (need if force else need.join(full, ["edit_id", "file"], "left_anti")).select("obj_id").distinct()


def lacking_prerequisite(specs: DataFrame, passed: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Objects with a generated edit (obj_id, edit_id) that the gate passes (edit_id), and no artefact (obj_id)."""
    due = specs.join(passed.select("edit_id"), "edit_id", "left_semi").select("obj_id").distinct()
    return due.join(artefacts.select("obj_id"), "obj_id", "left_anti")


def product_coverage(edits: DataFrame, templates: tuple[str, ...], listing: DataFrame) -> DataFrame:
    """edits (obj_id, edit_id), templates of the files that each needs -> obj_id, expected, found, missing (the first
    ten), ok."""
    need = edits.select("obj_id", "edit_id", F.explode(F.array(*map(F.lit, templates))).alias("file"))
    there = listing.where("size > 0").select("edit_id", "file").distinct().withColumn("_there", F.lit(True))
    j = need.join(there, ["edit_id", "file"], "left")
    lacks = F.when(F.col("_there").isNull(), F.concat("edit_id", F.lit("/"), "file"))
    r = j.groupBy("obj_id").agg(F.count(F.lit(1)).alias("expected"), F.count("_there").alias("found"), F.slice(F.sort_array(F.collect_set(lacks)), 1, 10).alias("missing"))
    return r.withColumn("ok", F.col("expected") == F.col("found"))


def mask_rows(edits: DataFrame, regions: DataFrame, least: int, per_type: int, total: int, only: DataFrame | None = None) -> DataFrame:
    """edits (edit_id, edit_type, n_parts) that get a mask: with parts, not global, of a list if there is one, with enough
    cells in their region (edit_id, n_cells); the first of each type, then the first of all."""
    e = edits.where((F.col("edit_type") != "global") & (F.col("n_parts") > 0)).join(regions, "edit_id").where(F.col("n_cells") >= least)
    e = e if only is None else e.join(only.select("edit_id"), "edit_id", "left_semi")
    nth = F.row_number().over(Window.partitionBy("edit_type").orderBy("edit_id"))
    return e.withColumn("_nth", nth).where(F.col("_nth") <= per_type).drop("_nth").orderBy("edit_id").limit(total)


def resolved_objects(*listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Objects that any listing (obj_id) names, in order; the first `limit` of them."""
    every = reduce(DataFrame.union, [x.select("obj_id") for x in listings]).distinct().orderBy("obj_id")
    return every if limit is None else every.limit(limit)


def object_index(images: DataFrame, meshes: DataFrame) -> DataFrame:
    """Objects (shard, obj_id) that have both an image and a mesh file."""
    return images.select("shard", "obj_id").distinct().join(meshes.select("shard", "obj_id").distinct(), ["shard", "obj_id"])


def pair_records(edits: DataFrame) -> DataFrame:
    """Flat records of training pairs: ids, instruction and where the two sides are."""
    at = lambda side: F.concat_ws("/", F.lit("pairs"), "edit_type", "shard", "obj_id", "edit_id", F.lit(side))
    return edits.select("edit_id", "edit_type", "obj_id", "shard", F.coalesce("prompt", F.lit("")).alias("prompt"), F.coalesce("target_part_desc", F.lit("")).alias("before_desc"), F.coalesce("after_desc", F.lit("")).alias("after_desc"), at("before.npz").alias("before_path"), at("after.npz").alias("after_path"))


def layout_path() -> Column:
    """type/shard/object/edit; a type that isn't known is an error."""
    known = F.when(prefix_of(F.col("edit_type")).isNotNull(), F.col("edit_type"))
    return F.concat_ws("/", known, "shard", "obj_id", "edit_id")
