"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.text import whole
from pairloom.session import stored

#: Share of the largest possible entropy that the mix should have; times that a source may be repeated at most;
#: tokens in a block of the training order; rows of a source that one task puts in order.
EVENNESS, REPEATS, BLOCK_TOKENS, RUN_ROWS = 0.98, 4.0, 262_144, 512
_GRID = 64


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def exponent(sources: DataFrame, budget: float, evenness: float = EVENNESS, repeats: float = REPEATS) -> float:
    """The exponent in [0, 1] for sources (total), rounded up to six digits.

    Entropy of the normalised share^a falls as a grows, and so does the largest repetition (weight * budget / tokens):
    the largest a whose entropy reaches evenness * log(sources) is looked for, but if some source would then be repeated
    more than `repeats` times, the least a that keeps within it, or 1 where none does. Bisection, with 64 parts to a
    step: each step is one aggregate over the sources, and what comes back is 65 rows.
    """
    total = sources.agg(F.sum("total"), F.count(F.lit(1))).first()
    if not total[1]:
        return 1.0

    def search(ok) -> float:
        """Least a in [0, 1], on the grid, for which ok(a's row) no longer changes; ok is monotone, True at the low end."""
        low, high = 0.0, 1.0
        for _ in range(4):
            grid = F.transform(F.sequence(F.lit(0), F.lit(_GRID)), lambda i: F.lit(low) + F.lit(high - low) * i / _GRID)
            share = F.col("total") / F.lit(float(total[0]))
            at = sources.select(share.alias("p"), "total", F.posexplode(grid).alias("i", "a")).select("i", "a", "p", "total", F.pow("p", "a").alias("x"))
            rows = at.groupBy("i", "a").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.log("p")).alias("l"), F.max(F.col("x") * budget / F.col("total")).alias("most")).orderBy("i").collect()
            k = sum(bool(ok(r)) for r in rows)
            if k == 0:
                return rows[0]["a"]
            if k == len(rows):
                return rows[-1]["a"]
            low, high = rows[k - 1]["a"], rows[k]["a"]
        return high

    import math

    aim = evenness * math.log(total[1])
    entropy = lambda r: math.log(r["s"]) - r["a"] * r["l"] / r["s"]
    for_entropy = search(lambda r: entropy(r) >= aim)
    for_repeats = search(lambda r: r["most"] / r["s"] > repeats)
    return math.ceil(max(for_entropy, for_repeats) * 1e6 - 1e-6) / 1e6


def _place(*parts: object) -> Column:
    """A number below 2^40 from the first hex digits of an MD5: the keyed order of a permutation."""
    key = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 10), 16, 10).cast("long")


def mix(docs: DataFrame, budget: int | None = None, evenness: float = EVENNESS, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """docs (doc_id, text, source) -> block, position, doc_id, source, epoch, n_tokens, weight.

    Weights are token shares to the power of an exponent (see exponent()), normalised. A source's budget is
    floor(weight * budget) tokens (budget: as many tokens as the corpus has, if not given). It is met by keyed random
    permutations of the source: as many whole epochs as fit, then the start of one more, up to the document that
    crosses the budget. The order of training is one of blocks of about block_tokens tokens: a source's tokens are dealt
    evenly over all blocks, so that each block has the weights' proportions, and a block is permuted in itself.

    A permutation is ordered by hash in two steps, so that no task orders a whole source: runs of about 512 rows by
    their hash's leading bits are summed up, then rows are placed within their run. A null source is a source of its
    own. Documents without tokens are in no mix. Rows that share a doc_id are each used; with equal tokens they are
    alike. An empty table gives no rows; other columns are ignored.
    """
    d = stored(docs.select("doc_id", "source", tokens(whole()).alias("n_tokens")).where("n_tokens > 0"))
    sources = stored(d.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("n")))
    total = sources.agg(F.sum("total")).first()[0] or 0
    budget = total if budget is None else budget
    a = exponent(sources, float(budget), evenness, repeats)
    norm = sources.agg(F.sum(F.pow(F.col("total") / F.lit(float(total or 1)), F.lit(a)))).first()[0] or 1.0
    weight = F.pow(F.col("total") / F.lit(float(total or 1)), F.lit(a)) / F.lit(norm)
    plan = sources.select(F.col("source").alias("of"), "total", weight.alias("weight"), F.floor(weight * F.lit(float(budget)) + F.lit(1e-6)).alias("due"), F.greatest(F.ceil(F.log2(F.col("n") / RUN_ROWS)), F.lit(0)).cast("int").alias("bits"))
    plan = plan.where("due > 0").withColumn("epochs", F.ceil(F.col("due") / F.col("total")).cast("int"))

    # the table of sources has a row for each source: AQE broadcasts it where it is small and splits a large source where not
    rows = d.join(plan, d["source"].eqNullSafe(plan["of"])).drop("of")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch")).withColumn("at", _place(F.lit(str(seed)), "epoch", "doc_id"))
    rows = rows.withColumn("run", F.expr("shiftright(at, 40 - bits)"))
    sums = rows.groupBy("source", "epoch", "run").agg(F.sum("n_tokens").alias("in_run"))
    before = sums.withColumn("before", F.sum("in_run").over(Window.partitionBy("source", "epoch").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("run").alias("r"), F.coalesce("before", F.lit(0)).alias("before"))
    in_run = F.sum("n_tokens").over(Window.partitionBy("source", "epoch", "run").orderBy("at", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.join(before, rows["source"].eqNullSafe(before["s"]) & (rows["epoch"] == before["e"]) & (rows["run"] == before["r"]))
    placed = placed.withColumn("start", F.col("before") + F.coalesce(in_run, F.lit(0)) + F.col("epoch") * F.col("total")).where("start < due")
    blocks = max(1, -(-budget // block_tokens))
    block = F.least(F.floor(F.col("start") / (F.col("due") / F.lit(float(blocks)))), F.lit(blocks - 1)).cast("long")
    placed = placed.withColumn("block", block).withColumn("shuffle", _place(F.lit(f"{seed}b"), "block", "epoch", "doc_id"))
    position = F.row_number().over(Window.partitionBy("block").orderBy("shuffle", "doc_id", "epoch", "n_tokens", "source"))
    return placed.select("block", position.cast("long").alias("position"), "doc_id", "source", F.col("epoch").cast("long").alias("epoch"), "n_tokens", F.round("weight", 6).alias("weight"))
