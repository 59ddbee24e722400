"""Texts of edits: names, word lists, prompt slots, requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of a description that tell how a thing looks, and what shape it has.
APPEARANCE = [
    "red", "blue", "green", "black", "white", "silver", "gold", "golden", "pink", "brown", "grey", "gray", "purple", "orange", "yellow", "beige",
    "bronze", "copper", "chrome", "ivory", "crimson", "burgundy", "teal", "navy", "maroon", "cream", "tan", "dark", "light", "bright", "pale",
    "deep", "vibrant", "matte", "glossy", "shiny", "polished", "brushed", "frosted", "translucent", "transparent", "opaque", "iridescent",
    "textured", "smooth", "rough", "ridged", "ribbed", "grooved", "knurled", "woven", "striped", "checkered", "patterned", "plain", "solid",
    "metallic", "wooden", "plastic", "rubber", "leather", "fabric", "ceramic", "glass", "steel", "iron", "aluminum", "titanium", "marble", "stone",
    "concrete", "brick", "velvet", "silk", "linen", "cotton", "denim", "suede", "fur", "feathered", "rustic", "aged", "weathered", "worn", "faded",
    "tarnished", "corroded", "oxidized",
]
STRUCTURE = [
    "round", "rounded", "circular", "spherical", "cylindrical", "conical", "rectangular", "square", "triangular", "hexagonal", "octagonal", "curved",
    "angular", "pointed", "blunt", "flat", "concave", "convex", "tapered", "flared", "bulbous", "elongated", "stubby", "slender", "wide", "narrow",
    "thick", "thin", "tall", "short", "long", "large", "small", "tiny", "massive", "compact", "slim", "bulky", "streamlined", "aerodynamic", "boxy",
    "blocky", "dome-shaped", "wedge-shaped", "bell-shaped", "teardrop", "oval", "oblong",
]
_MARKS = ".,;:!?()[]\"'"


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_words(text: Column, words: list[str]) -> Column:
    """The text without some words (in any case, marks around them aside); white space single, none before , and ."""
    tokens = F.filter(F.split(_collapsed(text), " "), lambda t: ~F.array_contains(F.array(*map(F.lit, words)), F.lower(F.btrim(t, F.lit(_MARKS)))))
    return F.trim(F.replace(F.replace(F.array_join(tokens, " "), F.lit(" ,"), F.lit(",")), F.lit(" ."), F.lit(".")))


def structure(text: Column) -> Column:
    """A description without words of appearance."""
    return without_words(text, APPEARANCE)


def appearance(text: Column) -> Column:
    """A description without words of structure."""
    return without_words(text, STRUCTURE)


def part_label(captions: Column) -> Column:
    """The first caption that isn't blank, white space single; null without any."""
    return F.get(F.filter(F.transform(captions, _collapsed), lambda c: c != ""), F.lit(0))


# The patterns of articles, of a raw caption's number and of what it names.
_ARTICLES, _NUMBER, _NAMED = r"(?i)^(?:a |an |the )+", r"\._[0-9]+\s*$", r"(?i)(?:of the|of a|of an)\s+(.+)$"


def part_name(captions: Column, raw: Column, part_id: Column) -> Column:
    """A part's name: its first caption without articles and full stops; else what its raw caption says after 'of the', 'of
    a' or 'of an' (or all of it) without a number at its end; else part_<id>."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"\.+$", ""), _ARTICLES, ""))
    some = lambda c: F.when(c != "", c)
    tail = F.regexp_replace(F.trim(F.regexp_replace(raw, _NUMBER, "")), r"\.+$", "")
    after = F.regexp_extract(tail, _NAMED, 1)
    return F.coalesce(some(plain(F.get(captions, F.lit(0)))), some(plain(F.when(after != "", after).otherwise(tail))), F.concat(F.lit("part_"), part_id.cast("string")))


def _or(*columns: Column) -> Column:
    """The first that isn't empty."""
    return F.coalesce(*[F.when(c != "", c) for c in columns], F.lit(""))


def prompt_slots(effective: Column) -> list[Column]:
    """Slots of the prompts for an edit, from its columns edit_type, prompt, object_desc, target_part_desc, new_parts_desc
    and the stage fields object_desc_s1/2, after_desc_s1/2, new_parts_desc_s1/2. A part's edit that is carried out on the
    whole object takes the object's description everywhere."""
    c = lambda name: F.coalesce(F.col(name), F.lit(""))
    lifted = (effective == "Global") & ~F.lower("edit_type").eqNullSafe("global")
    whole = c("object_desc")
    after = F.when(lifted, whole).otherwise(_or(c("new_parts_desc"), whole))
    before_part = F.when(lifted, whole).otherwise(c("target_part_desc"))
    after_part = F.when(lifted, whole).otherwise(_or(c("new_parts_desc"), c("target_part_desc")))
    staged = lambda name, text, how: F.when(lifted, how(text)).otherwise(_or(c(name), how(text)))
    slots = {
        "edit_prompt": c("prompt"), "effective_type": effective, "raw_edit_type": F.col("edit_type"), "target_part": after_part, "ori_cpl": whole, "new_cpl": after,
        "ori_s1_cpl": staged("object_desc_s1", whole, structure), "new_s1_cpl": staged("after_desc_s1", after, structure), "ori_s2_cpl": staged("object_desc_s2", whole, appearance), "new_s2_cpl": staged("after_desc_s2", after, appearance),
        "ori_s1_part": structure(before_part), "ori_s2_part": appearance(before_part), "new_part": after_part,
        "new_s1_part": staged("new_parts_desc_s1", after_part, structure), "new_s2_part": staged("new_parts_desc_s2", after_part, appearance),
    }
    return [v.alias(k) for k, v in slots.items()]


def judge_request() -> Column:
    """What a judge is told of an edit: a line for each of its columns edit_type, object_desc, prompt, label,
    target_part_desc, and for the parameter of its type."""
    # fixed values: the lines' wording
    kind, text = F.lower("edit_type"), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = lambda name, c, quote='"': F.when(text(c) != "", F.concat(F.lit(f"{name}: {quote}"), text(c), F.lit(quote)))
    extra = (
        F.when(kind == "modification", line("Expected shape after", "new_part_desc")).when(kind == "scale", line("Scale factor (shrink)", "factor", "")).when(kind == "material", line("Expected material/finish", "target_material"))
        .when(kind == "color", line("Expected colour", "target_color")).when(kind == "global", line("Expected style", "target_style"))
    )
    always = [F.concat(F.lit("edit_type: "), kind), F.concat(F.lit("Object: "), text("object_desc")), F.concat(F.lit('Edit instruction: "'), text("prompt"), F.lit('"')), F.concat(F.lit("Target part: "), text("label"))]
    return F.concat_ws("\n", *always, line("Target part description (before)", "target_part_desc"), extra)


def filled(templates: dict[str, str], edit_type: Column, **slots: Column) -> Column:
    """The template of an edit's type ('' for any other type) with {name} replaced by what the slot of that name holds."""
    out = F.lit(templates.get("", ""))
    for kind, template in templates.items():
        out = F.when(edit_type == kind, F.lit(template)).otherwise(out) if kind else out
    for name, value in slots.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out
