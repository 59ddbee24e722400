"""Rules for planned edits and their inputs: codes, validation, specs, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.edits import GENERATED, PREFIX, assign_ids, of_object

# The types that a plan can ask for.
PLANNED = ("deletion", "modification", "scale", "material", "color", "global")
# Types that need parts, those that need a description of what they change; verbs (looked for anywhere in the
# prompt, also within words) that add, that only remove, and that replace.
PART_TYPES, DESCRIBED = ("deletion", "modification", "scale", "material", "color"), ("modification", "scale", "material", "color")
ADDS, REMOVES, REPLACES = ("add ", "insert ", "attach ", "put "), ("remove", "delete", "erase", "strip", "eliminate"), ("replace", "swap", "change", "modify", "convert")
# Shortest prompt, views, the range of a scale's factor, the share of the quota that has to be valid, the
# parts an object may have, statuses of gate A that keep an edit from going on.
SHORTEST, VIEWS, FACTORS, SHARE, MOST_PARTS, HELD = 8, 5, (0.3, 0.85), 0.7, 16, ("fail", "deferred")
# The parameter that each type's edits must name.
PARAMETER = {"modification": "new_part_desc", "material": "target_material", "color": "target_color", "global": "target_style"}


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit(""))) == ""


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def _codes(**conditions: Column) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()])).cast("array<string>")


def known_parts(parts: DataFrame) -> DataFrame:
    """parts (obj_id, part_id) -> obj_id, known: the ids of each object's parts (an object has few)."""
    return parts.groupBy("obj_id").agg(F.collect_set("part_id").alias("known"))


def _with_known(edits: DataFrame, parts: DataFrame) -> DataFrame:
    """edits with known: the ids of their object's parts, which parts can have listed already (see known_parts)."""
    known = (parts if "known" in parts.columns else known_parts(parts)).select(F.col("obj_id").alias("_obj"), "known")
    joined = edits.join(known, F.col("obj_id") == F.col("_obj"), "left").drop("_obj")
    return joined.withColumn("known", F.coalesce("known", F.array().cast("array<int>")))


def rule_codes(edits: DataFrame, parts: DataFrame) -> DataFrame:
    """edits (obj_id, edit_idx, edit_type, pids, prompt, target_part_desc, new_part_desc) with codes: the rules that each
    breaks. edits can be a stream."""
    e, low = _with_known(edits, parts), F.lower(F.trim(F.coalesce("prompt", F.lit(""))))
    needs, none = F.col("edit_type").isin(*PART_TYPES), F.size(F.coalesce("pids", F.array().cast("array<int>"))) == 0
    conflict = F.when(F.col("edit_type") == "deletion", _any_of(low, ADDS)).when(F.col("edit_type").isin(*GENERATED), _any_of(low, REMOVES) & ~_any_of(low, REPLACES))
    codes = _codes(
        prompt_too_short=F.length(low) < SHORTEST, parts_missing=needs & none, parts_invalid=needs & ~none & (F.size(F.array_except("pids", "known")) > 0),
        new_desc_missing=(F.col("edit_type") == "modification") & _blank("new_part_desc"), target_desc_missing=F.col("edit_type").isin(*DESCRIBED) & _blank("target_part_desc"), verb_conflict=conflict)
    return e.withColumn("codes", codes).drop("known")


def plan_problems(edits: DataFrame, parts: DataFrame) -> DataFrame:
    """edits (as for rule_codes, with after_desc, view_index, factor, target_material, target_color, target_style) with
    problems: what keeps each from being valid."""
    e = _with_known(edits, parts)
    kind, none = F.col("edit_type"), F.size("pids") == 0
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    named = {f"no_{c}": (kind == k) & empty(c) for k, c in PARAMETER.items()}
    return e.withColumn("problems", _codes(
        bad_type=~F.coalesce(kind.isin(*PLANNED), F.lit(False)), bad_parts=F.size(F.array_except("pids", "known")) > 0, parts_of_global=(kind == "global") & ~none, no_parts=(kind != "global") & none,
        bad_view=~F.col("view_index").between(0, VIEWS - 1), no_after_desc=(kind != "deletion") & empty("after_desc"), bad_factor=(kind == "scale") & ~F.coalesce(F.col("factor").between(*FACTORS), F.lit(False)), **named)).drop("known")


def plan_report(problems: DataFrame, quotas: DataFrame | None = None) -> DataFrame:
    """edits with problems, quotas (obj_id, quota) -> obj_id, n_edits, n_kept, n_repeated, ok. A plan is good if 70 % of its
    quota (of its edits, without one) are valid, and one at least. Repeated edits are counted and stay."""
    valid = F.size("problems") == 0
    nth = F.row_number().over(Window.partitionBy("obj_id", "edit_type", F.array_sort("pids"), valid).orderBy("edit_idx"))
    e = problems.withColumn("_again", valid & (F.col("edit_type") != "global") & (nth > 1))
    n = e.groupBy("obj_id").agg(F.count(F.lit(1)).alias("n_edits"), F.count_if(F.size("problems") == 0).alias("n_kept"), F.count_if("_again").alias("n_repeated"))
    n = n.withColumn("quota", F.col("n_edits")) if quotas is None else n.join(quotas, "obj_id", "left").withColumn("quota", F.coalesce("quota", "n_edits"))
    return n.select("obj_id", "n_edits", "n_kept", "n_repeated", (F.col("n_kept") >= F.greatest(F.lit(1), F.floor(F.col("quota") * SHARE + 1e-9))).alias("ok"))


def allowed_types(listed: str | None) -> tuple[str, ...]:
    """The known types among a comma-separated list; all of them if none is."""
    asked = {t.strip().lower() for t in (listed or "").split(",")}
    return tuple(t for t in PREFIX if t in asked) or tuple(PREFIX)


def specs(edits: DataFrame, gate_a: DataFrame, types: tuple[str, ...] = GENERATED, allowed: str | None = None) -> DataFrame:
    """Edits (with their ids) of some types that gate A (obj_id, edit_idx, status, best_view) lets go on: not failed or put
    off, and with a view. Ids are given before anything is left out, so they don't depend on it."""
    kept = [t for t in types if t in allowed_types(allowed)]
    open_gate = gate_a.where(~F.coalesce(F.col("status").isin(*HELD), F.lit(False)) & F.col("best_view").isNotNull())
    return of_object(assign_ids(edits).where(F.col("edit_type").isin(*kept)), open_gate, "edit_idx", outer=False)


def described(spec: DataFrame, parts: DataFrame) -> DataFrame:
    """specs with labels (names of their parts, '' for one that isn't known), new_parts_desc (the first of its own
    description, the text after and the text before that isn't empty) and view. A view out of range is an error."""
    names = parts.groupBy("obj_id").agg(F.map_from_entries(F.collect_list(F.struct("part_id", "name"))).alias("_names"))
    s = spec.join(names, "obj_id", "left")
    labels = F.transform("pids", lambda p: F.coalesce(F.col("_names")[p], F.lit("")))
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    view = F.when(F.col("best_view").between(0, VIEWS - 1), F.col("best_view")).otherwise(F.raise_error(F.concat(F.lit("no valid view: "), "edit_id")).cast("int"))
    return s.withColumn("labels", labels).withColumn("new_parts_desc", F.coalesce(some("new_part_desc"), some("after_desc"), some("target_part_desc"), F.lit(""))).withColumn("view", view).drop("_names")


def flat_descriptor(spec: DataFrame) -> DataFrame:
    """described specs under the names that older readers know: first part and label, -1 and '' where there is none."""
    empty = F.lit("")
    return spec.select(
        "edit_id", "edit_type", "obj_id", "shard", F.col("pids").alias("remove_part_ids"), F.col("labels").alias("remove_labels"), F.coalesce(F.get("pids", F.lit(0)), F.lit(-1)).alias("old_part_id"),
        F.coalesce(F.get("labels", F.lit(0)), empty).alias("old_label"), F.col("prompt").alias("edit_prompt"), F.col("new_parts_desc").alias("after_desc"), F.coalesce("target_part_desc", empty).alias("before_part_desc"),
        F.col("new_parts_desc").alias("after_part_desc"), F.col("view").alias("best_view"), *[empty.alias(c) for c in ("before_desc", "source_del_id", "mod_type")])


def visible_parts(pixels: DataFrame, least: int = 1) -> DataFrame:
    """pixels (obj_id, part_id, view, px) -> obj_id, n_visible, n_dropped, skip: parts that some view shows, and why an
    object is left out, if it is."""
    best = pixels.groupBy("obj_id", "part_id").agg(F.max("px").alias("px"))
    n = best.groupBy("obj_id").agg(F.count_if(F.col("px") >= least).alias("n_visible"), F.count_if(F.col("px") < least).alias("n_dropped"))
    return n.withColumn("skip", F.when(F.col("n_visible") + F.col("n_dropped") > MOST_PARTS, "too_many_parts").when(F.col("n_visible") == 0, "none_visible"))


def missing_inputs(objects: DataFrame, **listings: DataFrame) -> DataFrame:
    """objects (obj_id), listings (obj_id each) -> obj_id, missing (names of the listings that lack it), complete."""
    out = objects.select("obj_id").distinct()
    for name, found in listings.items():
        out = out.join(found.select("obj_id").distinct().withColumn(f"_{name}", F.lit(True)), "obj_id", "left")
    missing = F.array_compact(F.array(*[F.when(F.col(f"_{n}").isNull(), F.lit(n)) for n in sorted(listings)])).cast("array<string>")
    return out.select("obj_id", missing.alias("missing")).withColumn("complete", F.size("missing") == 0)


# Members that a container must have, those that are only asked for, those that must be JSON with a key.
REQUIRED, ASKED, KEYED = ("full.glb", "part_captions.json", "vd_scale"), ("anno_info.json",), {"part_captions.json": "parts"}


def container_report(contents: DataFrame) -> DataFrame:
    """contents (obj_id, member, n_bytes, json) -> obj_id, errors, warnings, verdict: members that are missing, empty or
    not the JSON they should be are errors, those only asked for are warnings."""
    has = lambda m: F.count_if(F.col("member") == m) > 0
    empty = [F.max(F.when((F.col("member") == m) & (F.col("n_bytes") <= 0), F.lit(f"empty {m}"))) for m in REQUIRED]
    wrong = [F.max(F.when((F.col("member") == m) & (F.col("n_bytes") > 0) & F.get_json_object("json", f"$.{k}").isNull(), F.lit(f"{m} lacks {k}"))) for m, k in KEYED.items()]
    absent = [F.when(~has(m), F.lit(f"missing {m}")) for m in REQUIRED]
    r = contents.groupBy("obj_id").agg(F.array_compact(F.array(*absent, *empty, *wrong)).alias("errors"), F.array_compact(F.array(*[F.when(~has(m), F.lit(f"missing {m}")) for m in ASKED])).alias("warnings"))
    return r.withColumn("verdict", F.when(F.size("errors") > 0, "FAIL").when(F.size("warnings") > 0, "WARN").otherwise("PASS"))


# Members that a mesh container must have (one of the first two; parts by their pattern; a shape for numbers)
# and the keys of its JSON; the same for one of images.
WHOLE, PARTS, KEYS = ("full.glb", "full.ply"), r"^part_\d+\.glb$", {"anno_info.json": ("bboxes", "ordered_faceid", "ordered_face_label"), "split_mesh.json": ("part_id_to_name", "valid_clusters")}
SHAPES, PICTURES = {"vd_scale": [1], "vd_offset": [3]}, r"^\d{3}\.(png|webp)$"


def content_report(contents: DataFrame, images: bool = False) -> DataFrame:
    """contents (see containers.contents) of mesh containers, or of those of images -> path, errors, warnings, verdict. A
    member that is missing, empty, of the wrong shape or not the JSON it should be is an error; parts and views that are
    empty, and captions or transforms that are missing, are warnings."""
    c = F.col
    has = lambda k: F.count_if(c("key") == k) > 0
    of = lambda k, what: F.max(F.when(c("key") == k, what))
    like = lambda pattern: c("key").rlike(pattern)
    said = lambda ok, text: F.when(ok, F.lit(text))

    def keyed(member: str) -> list[Column]:
        bad = F.max(F.when((c("key") == member) & c("error").isNotNull(), F.concat(F.lit(f"{member}: "), "error")))
        return [said(~has(member), f"missing {member}"), bad, *[said(of(member, c("json_keys").isNotNull() & ~F.array_contains("json_keys", k)), f"{member} lacks {k}") for k in KEYS[member]]]

    unreadable = F.max(F.when(c("key").isNull(), c("error")))
    if images:
        errors = [*keyed("split_mesh.json"), said(of("split_mesh.json", F.array_contains("json_empty", "valid_clusters")), "no valid_clusters"), said(F.count_if(like(PICTURES)) == 0, "no views")]
        warnings = [said(~has("transforms.json"), "missing transforms.json"), said(F.count_if(like(PICTURES) & (c("nbytes") == 0)) > 0, "empty views")]
    else:
        first = F.when(has(WHOLE[0]), of(WHOLE[0], c("nbytes"))).otherwise(of(WHOLE[1], c("nbytes")))
        shaped = [x for k, shape in SHAPES.items() for x in (said(~has(k), f"missing {k}"), said(of(k, ~c("shape").eqNullSafe(F.lit(shape))), f"{k} isn't of shape {shape}"))]
        captions = "part_captions.json"
        errors = [said(~has(WHOLE[0]) & ~has(WHOLE[1]), "missing full mesh"), said(first == 0, "empty full mesh"), said(F.count_if(like(PARTS)) == 0, "no parts"), *keyed("anno_info.json"), F.max(F.when((c("key") == captions) & c("error").isNotNull(), F.concat(F.lit(f"{captions}: "), "error"))), *shaped, said(of("vd_scale", c("shape").eqNullSafe(F.lit([1])) & (c("number") <= 0)), "vd_scale isn't positive")]
        warnings = [said(F.count_if(like(PARTS) & (c("nbytes") == 0)) > 0, "empty parts"), said(~has(captions), f"missing {captions}"), said(of(captions, F.size("json_keys") == 0), f"empty {captions}")]
    listed = lambda those: F.array_compact(F.array(*those)).cast("array<string>")
    r = contents.groupBy("path").agg(F.when(unreadable.isNotNull(), F.array(unreadable)).otherwise(listed(errors)).alias("errors"), F.when(unreadable.isNotNull(), F.array().cast("array<string>")).otherwise(listed(warnings)).alias("warnings"))
    return r.withColumn("verdict", F.when(F.size("errors") > 0, "FAIL").when(F.size("warnings") > 0, "WARN").otherwise("PASS"))


def batch_totals(reports: DataFrame) -> DataFrame:
    """Objects by verdict."""
    return reports.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def scene_error(transforms: Column) -> Column:
    """What is wrong with a scene's transforms.json; null if nothing is. Its scale and offset must be there, the offset be
    three numbers and the scale positive."""
    scale, offset = F.get_json_object(transforms, "$.scale"), F.get_json_object(transforms, "$.offset")
    numbers = F.from_json(offset, "array<string>")
    number = lambda c: c.try_cast("double")
    return (
        F.when(transforms.isNull(), "transforms.json is missing").when(scale.isNull() | offset.isNull(), "scale or offset is missing")
        .when(numbers.isNull() | F.exists(numbers, lambda v: number(v).isNull()), "offset isn't numbers").when(F.size(numbers) != 3, "offset isn't of length 3")
        .when(number(scale).isNull(), "scale isn't a number").when(number(scale) <= 0, "scale isn't positive")
    )
