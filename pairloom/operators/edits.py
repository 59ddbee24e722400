"""Edit ids, rules and quotas: projections and windows over edit plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Id prefixes by edit type, the types made by an image model, and those that need parts.
PREFIX = {"deletion": "del", "addition": "add", "modification": "mod", "scale": "scl", "material": "mat", "color": "clr", "global": "glb", "identity": "idt"}
GENERATED = ("modification", "scale", "material", "color", "global")
# Verbs that ask for a removal, in the order in which they are looked for, and verbs that ask for more.
REMOVE_VERBS = ("get rid of", "take away", "delete", "remove", "strip", "erase")


def prefix_of(edit_type: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv])
    return F.coalesce(known[edit_type], F.raise_error(F.concat(F.lit("unknown edit type: "), edit_type)))


def type_of(edit_id: Column) -> Column:
    """The type that the id's prefix names; an unknown prefix is an error."""
    known = F.create_map(*[F.lit(x) for k, v in PREFIX.items() for x in (v, k)])
    return F.when(edit_id.isNull(), F.lit(None)).otherwise(F.coalesce(known[F.split_part(edit_id, F.lit("_"), F.lit(1))], F.raise_error(F.concat(F.lit("unknown prefix of an edit id: "), edit_id))))


def paired_id(edit_id: Column) -> Column:
    """The inverse edit's id: del_X for add_X and the other way round, else null."""
    rest = F.substr(edit_id, F.lit(5))
    return F.when(edit_id.startswith("del_"), F.concat(F.lit("add_"), rest)).when(edit_id.startswith("add_"), F.concat(F.lit("del_"), rest))


def normal_shard(s: Column) -> Column:
    """Two digits at least; longer ones are kept. None at all is an error."""
    s = F.trim(s)
    return F.when(F.coalesce(s, F.lit("")) == "", F.raise_error(F.lit("a shard has no name"))).when(F.length(s) < 2, F.lpad(s, 2, "0")).otherwise(s)


def assign_ids(edits: DataFrame) -> DataFrame:
    """edit_id by two counters in array order: one for all generated types, one for deletions. Other types take none."""
    upto = Window.partitionBy("obj_id").orderBy("edit_idx").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.when(F.col("edit_type") == "deletion", "d").when(F.col("edit_type").isin(*GENERATED), "g")
    e = edits.withColumn("kind", kind).where("kind is not null")
    seq = F.when(F.col("kind") == "d", F.sum(F.when(F.col("kind") == "d", 1)).over(upto)).otherwise(F.sum(F.when(F.col("kind") == "g", 1)).over(upto)) - 1
    return e.withColumn("seq", seq.cast("int")).withColumn("edit_id", F.format_string("%s_%s_%03d", prefix_of(F.col("edit_type")), "obj_id", "seq")).drop("kind")


def quota(n: Column, white: Column | None = None) -> dict[str, Column]:
    """Edits planned for an object of n parts; a white one has no material or colour to change."""
    clamp = lambda x: F.greatest(F.lit(1), F.least(F.lit(8), F.ceil(x))).cast("int")
    few = F.when(n < 8, 1).otherwise(2)
    looks = few if white is None else F.when(white, 0).otherwise(few)
    # fixed values: the divisors, bounds and counts of the plan
    return {"q_deletion": clamp(n / 2.5), "q_modification": clamp(n / 2), "q_scale": few, "q_material": looks, "q_color": looks, "q_global": F.lit(2)}


def halved(q: dict[str, Column]) -> dict[str, Column]:
    return {k: F.greatest(F.lit(1 if k in ("q_deletion", "q_modification") else 0), F.floor(v / 2)).cast("int") for k, v in q.items()}


def invert_prompt(p: Column) -> Column:
    """The instruction that undoes a deletion. Verbs are taken in order, each as the start of the prompt (also of its
    first word only) or else as a word within it; a prompt without any is added back. A null stays null."""
    p = F.btrim(p, F.lit(" \t\n\r\f\v"))
    low = F.lower(p)
    out = F.concat(F.lit("Add back "), p)
    for v in reversed(REMOVE_VERBS):
        at = F.locate(f" {v} ", low)
        within = F.concat(F.substr(p, F.lit(1), at), F.lit("add"), F.substr(p, at + len(v) + 1))
        out = F.when(low.startswith(v), F.concat(F.lit("Add"), F.substr(p, F.lit(len(v) + 1)))).when(at > 0, within).otherwise(out)
    at = F.locate(" from ", out)
    out = F.when(at > 0, F.concat(F.substr(out, F.lit(1), at - 1), F.lit(" to "), F.substr(out, at + 6))).otherwise(out)
    return F.when(p == "", p).otherwise(out)


def repeated_edits(edits: DataFrame) -> DataFrame:
    """Second and later edits of one type on the same parts of an object; they are warned of and stay. Where edits have
    a column `valid`, only valid ones are looked at."""
    edits = edits.where("valid") if "valid" in edits.columns else edits
    w = Window.partitionBy("obj_id", "edit_type", F.array_sort(F.array("pid1", "pid2"))).orderBy("edit_idx")
    return edits.where("edit_type <> 'global'").withColumn("nth", F.row_number().over(w)).where("nth > 1")


def invalid_parts(edits: DataFrame, parts: DataFrame) -> DataFrame:
    """n_invalid: part ids of each edit that its object doesn't have."""
    known = parts.groupBy("obj_id").agg(F.collect_set("part_id").alias("known"))
    joined = edits.join(known, "obj_id", "left")
    return joined.withColumn("n_invalid", F.size(F.array_except(F.array("pid1", "pid2"), F.coalesce("known", F.array().cast("array<int>"))))).drop("known")


def of_object(rows: DataFrame, found: DataFrame, key: str, outer: bool = True) -> DataFrame:
    """rows with the fields of `found` that has their obj_id and key: a join, left or inner, for what has few rows of an
    object. These come as one list, so that rows that lie together by obj_id needn't be dealt out by the key as well."""
    fields = [c for c in found.columns if c not in ("obj_id", key)]
    own = found.groupBy("obj_id").agg(F.collect_list(F.struct(F.col(key).alias("_key"), *fields)).alias("_own"))
    j = rows.join(own, "obj_id", "left" if outer else "inner")
    each = F.filter("_own", lambda o: o["_key"] == F.col(key))
    return j.select(*rows.columns, F.inline_outer(each) if outer else F.inline(each)).drop("_key")
