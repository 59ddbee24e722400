"""Choosing: views, majorities, caps, reasons, acceptance, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.state import not_passed

# The view taken where none is known, the number of views, voxels a side may have, cells to a side of a
# latent grid, tiers from best to worst, and how each type of edit is carried out (any other as Modification).
DEFAULT_VIEW, VIEWS, MAX_VOXELS, LATENT_SIDE = 4, 5, 32768, 64
TIERS = ("high", "medium", "low", "negative", "rejected")
EXECUTED_AS = {"modification": "Modification", "scale": "Modification", "material": "TextureOnly", "color": "TextureOnly", "global": "TextureOnly", "deletion": "Deletion", "addition": "Addition"}


def best_of(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """For each key the value of greatest weight, of equal ones the least value. The maximum combines before the
    shuffle. Null weights count as least."""
    best = F.max_by(value, F.struct(F.col(weight), (-F.col(value)).alias("least_first")))
    return rows.groupBy(*keys).agg(best.alias(value), F.max(weight).alias(weight))


def best_view(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """pixels (keys, view, px) -> the view that shows most, ties to the lowest; 0 if no view shows anything."""
    found = best_of(pixels, keys, "view", "px")
    return found.withColumn("view", F.when(F.coalesce("px", F.lit(0)) > 0, F.col("view")).otherwise(0))


def majority(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """For each key its most frequent label, ties to the lowest."""
    return best_of(rows.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n")), keys, label, "n")


def capped(rows: DataFrame, groups: list[str], order: list[str], per_group: int, total: int) -> DataFrame:
    """The first rows of each group, then the first of all, in order. Spark cuts groups before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= per_group).drop("_place").orderBy(*order).limit(total)


def top_reasons(failures: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """The n most frequent values of reason, in all or for each of by; ties in order of the reason."""
    counts = failures.where("reason is not null").groupBy(*(by or []), "reason").agg(F.count(F.lit(1)).alias("n"))
    if not by:
        return counts.orderBy(F.desc("n"), "reason").limit(n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "reason"))
    return counts.withColumn("place", place).where(F.col("place") <= n)


def accept_deletions(wide: DataFrame) -> DataFrame:
    """Strict acceptance of deletions: gate A must say pass; else reason tells what it said."""
    reason = not_passed("gate_a", "A")
    return wide.where(F.col("edit_id").startswith("del_")).withColumn("reason", reason).withColumn("accepted", reason.isNull())


def voxel_counts(voxels: DataFrame, most: int = MAX_VOXELS) -> DataFrame:
    """Voxels of a pair before and after, and whether both are within the budget."""
    n = voxels.groupBy("pair_id").agg(F.sum("in_before").alias("n_before"), F.sum("in_after").alias("n_after"))
    return n.withColumn("kept", F.greatest("n_before", "n_after") <= most)


def latent_report(cells: DataFrame, key: str, side: int = LATENT_SIDE) -> DataFrame:
    """For each table of cells its row count and the first error: a coordinate out of range or a missing feature; and a
    warning where cells (with a column b) are of another batch than 0."""
    low, high = F.min(F.least("x", "y", "z")), F.max(F.greatest("x", "y", "z"))
    missing = F.count_if(F.col("f0").isNull() | F.col("f1").isNull() | F.col("f2").isNull() | F.col("f3").isNull())
    error = F.when((low < 0) | (high >= side), "coords out of range").when(missing > 0, "features missing")
    batch = F.max(F.col("b") != 0) if "b" in cells.columns else F.lit(False)
    return cells.groupBy(key).agg(F.count(F.lit(1)).alias("n"), error.alias("error"), F.when(batch, "batch isn't 0").alias("warning"))


def within_tier(tier: Column, worst: str) -> Column:
    """Whether a tier is the worst that is kept, or better; an unknown one counts as rejected."""
    rank = F.coalesce(*[F.when(tier == t, F.lit(i)) for i, t in enumerate(TIERS)], F.lit(len(TIERS) - 1))
    return rank <= TIERS.index(worst)


def executed_as(edit_type: Column) -> Column:
    return F.coalesce(*[F.when(edit_type == k, F.lit(v)) for k, v in EXECUTED_AS.items()], F.lit("Modification"))


def _of_deletion(column: str) -> Column:
    """What the deletion that an addition undoes has in a column; null for other edits. Both ids end alike."""
    pair = Window.partitionBy("obj_id", F.substring("edit_id", 5, 1 << 20))
    return F.when(F.col("edit_id").startswith("add_"), F.max(F.when(F.col("edit_id").startswith("del_"), F.col(column))).over(pair))


def _in_range(c: str) -> Column:
    """A view, null where it is out of range: one rule for all that looks for a view."""
    return F.when(F.col(c).between(0, VIEWS - 1), F.col(c))


def resolved_views(state: DataFrame) -> DataFrame:
    """View of each edit: its own, for additions else that of the paired deletion, for both these else the default. A view
    out of range counts as none, its own as well as the deletion's; a generated edit without one has a null view, and is
    rejected."""
    edits = state.groupBy("obj_id", "edit_id").agg(F.max(F.when(F.col("stage") == "gate_a", _in_range("best_view"))).alias("own"))
    default = F.when(F.col("edit_id").startswith("add_") | F.col("edit_id").startswith("del_"), DEFAULT_VIEW)
    return edits.select("obj_id", "edit_id", F.coalesce("own", _of_deletion("own"), default).alias("view"))


def preview_slots(verdicts: DataFrame) -> DataFrame:
    """verdicts (obj_id, edit_id, verdict_view, legacy_view) -> obj_id, edit_id, slot: the view that the stage's verdict
    names, else the old record's, for an addition else its deletion's, else the default. One out of range counts as none."""
    own = verdicts.select("obj_id", "edit_id", F.coalesce(_in_range("verdict_view"), _in_range("legacy_view")).alias("own"))
    return own.select("obj_id", "edit_id", F.coalesce("own", _of_deletion("own"), F.lit(DEFAULT_VIEW)).alias("slot"))


def quality_block(state: DataFrame) -> DataFrame:
    """final_pass; alignment: score of gate A (for an addition without one that of its deletion); quality: score of gate
    E. As JSON (to_json) the columns that are null are left out."""
    of = lambda g, c: F.max(F.when(F.col("stage") == g, F.col(c)))
    edits = state.groupBy("obj_id", "edit_id").agg(of("gate_a", "score").alias("own"), of("gate_e", "score").alias("quality"), (F.count_if(F.col("stage").isin("gate_a", "gate_c", "gate_e") & (F.col("status") == "fail")) == 0).alias("final_pass"))
    return edits.select("obj_id", "edit_id", "final_pass", F.coalesce("own", _of_deletion("own")).alias("alignment"), "quality")


def colourful_fraction(pixels: DataFrame, key: str, view: str, least_pixels: int = 50, saturation: int = 40, white_below: float = 0.05) -> DataFrame:
    """Share of saturated pixels over the views that show enough; 0 where no view does. A low share marks a white model.
    Fixed values: 50 pixels to a view, a saturation of over 40, a share below 0.05."""
    views = pixels.groupBy(key, view).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("s") > saturation).alias("vivid"))
    enough = F.col("n") >= least_pixels
    share = F.coalesce(F.sum(F.when(enough, F.col("vivid"))) / F.sum(F.when(enough, F.col("n"))), F.lit(0.0))
    return views.groupBy(key).agg(share.alias("fraction")).withColumn("white", F.col("fraction") < white_below)


def with_gate(edits: DataFrame, state: DataFrame, gate: str) -> DataFrame:
    """Every planned edit with the view and status of a gate's latest record, null where it has none."""
    return edits.join(state.where(F.col("stage") == gate).select("edit_id", "best_view", "status"), "edit_id", "left")


def gate_record(state: DataFrame, gate: str) -> DataFrame:
    """The same where the plan is every edit that the state knows: one pass over it."""
    of = lambda c: F.max(F.when(F.col("stage") == gate, F.col(c))).alias(c)
    return state.groupBy("obj_id", "edit_id").agg(of("best_view"), of("status"))


def unscored(edits: DataFrame, scores: DataFrame) -> DataFrame:
    """Edits whose last line among scores (edit_id, score, line_no), if any, has no score."""
    last = scores.groupBy("edit_id").agg(F.max_by("score", "line_no").alias("score"))
    return edits.join(last.where("score is not null"), "edit_id", "left_anti")


def merged_manifests(manifests: list[DataFrame], order: list[str]) -> DataFrame:
    """Manifests of one layout as one, each edit once (the first manifest that has it), in order."""
    numbered = [m.withColumn("_from", F.lit(i)) for i, m in enumerate(manifests)]
    every = numbered[0]
    for m in numbered[1:]:
        every = every.unionByName(m)
    first = every.groupBy("edit_id").agg(F.min_by(F.struct(*manifests[0].columns), "_from").alias("row"))
    return first.select("row.*").orderBy(*order)


def view_of_parts(objects: DataFrame, masks: DataFrame, key: str, parts: tuple[int, ...], preference: tuple[int, ...]) -> DataFrame:
    """objects (key), masks (key, view, part, px) -> key, view that shows most of the parts, ties and none at all to the
    first view there is; the first preference where there are no masks."""
    px = masks.groupBy(key, "view").agg(F.sum(F.when(F.col("part").isin(*parts), F.col("px")).otherwise(0)).alias("px"))
    best = best_of(px, [key], "view", "px").select(key, "view")
    return objects.select(key).distinct().join(best, key, "left").select(key, F.coalesce("view", F.lit(preference[0])).cast("int").alias("view"))


def gate_columns(pixels: DataFrame, key: str, column: Column) -> DataFrame:
    """pixels (key, view, px) -> key, best, error, view: a judge sees the view that shows most and the views 0 to 3, and
    names a column; one out of range counts as view 0. An object that no view shows fails."""
    best = best_of(pixels, [key], "view", "px")
    shown = F.array(F.col("view").cast("int"), *map(F.lit, range(4)))
    view = F.when(column.between(0, 4), F.get(shown, column)).otherwise(0)
    return best.select(key, F.col("view").cast("int").alias("best"), F.when(F.col("px") <= 0, "zero_visible_pixels").alias("error"), view.alias("view"))


#: Orders of the pool of styles: objects are dealt among them.
ORDERS = 1024


def roster(objects: DataFrame, styles: DataFrame, slots: int, seed: int) -> DataFrame:
    """objects (obj_id, n_global: how many edits it asks for), styles (category, style) -> obj_id, category, style, place:
    for each object slots + 1 styles of each category, in an order that the seed fixes. An object that asks for more edits
    than there are categories has one more slot in one of them.

    The pool is ranked once for each of 1024 orders, not for each object: what objects are joined with has at most
    slots + 2 rows for an order and category. Objects of one order have the same styles."""
    order, place = F.pmod(F.xxhash64("obj_id", F.lit(seed)), F.lit(ORDERS)), F.row_number().over(Window.partitionBy("ord", "category").orderBy(F.xxhash64("ord", "category", "style", F.lit(seed)), "style"))
    categories = styles.select("category").distinct().select("category", F.row_number().over(Window.orderBy("category")).alias("nth"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n_categories"))
    pool = styles.join(F.broadcast(categories), "category").withColumn("ord", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))).withColumn("place", place).where(F.col("place") <= slots + 2)
    extra = F.pmod(F.xxhash64("obj_id", F.lit(seed), F.lit("extra")), F.col("n_categories")) + 1 == F.col("nth")
    asked = objects.select("obj_id", "n_global", order.cast("int").alias("ord")).join(pool, "ord")
    more = ((F.coalesce("n_global", F.lit(0)) > F.col("n_categories")) & extra).cast("int")
    return asked.where(F.col("place") <= slots + 1 + more).select("obj_id", "category", "style", "place")
