"""Benchmark decontamination: which documents hold a benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import SHINGLE, SIMILAR, let, once, shingles, whole
from pairloom.session import stored

#: Sketch rows (about 40 bytes each), item ids or shingles of all items (8 bytes each) up to which each of these is sent to
#: every executor; above, it is shuffled.
BROADCAST_ROWS = 200_000
#: Items, about, that a text is verified for at a time.
TESTS = 64


def _sketches(sets: DataFrame) -> DataFrame:
    """of, need, least_hits, h: the MinHash sketch of each set of shingles (its k least hashes) as rows.

    Sets are partitioned by size, each partition [2^p, 2^(p+1)) with a k of its own: twice the shingles that a document
    may miss of the partition's largest, and one. What a document must hold of a sketch follows from what it may miss of
    the set: least_hits."""
    part = F.floor(F.log2("n_item")).cast("int")
    largest = F.pow(F.lit(2.0), part + 1) - 1
    length = F.least(F.col("n_item"), 2 * F.floor(largest * F.col("slack") + F.lit(1e-9)).cast("int") + 1)
    sized = sets.withColumn("k", length).withColumn("least_hits", F.col("k") - (F.col("n_item") - F.col("need")))
    return sized.select("of", "need", "least_hits", F.explode(F.slice(F.array_sort("shingles"), F.lit(1), F.col("k"))).alias("h"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = SIMILAR, n: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> doc_id, item_id, n_shared, n_item, containment.

    One row for each pair where the document holds at least `threshold` of the item's distinct n-word shingles,
    wherever in the document they stand.

    Containment MinHash: the item is sketched by its least hashes and the document isn't sketched at all, as the
    signature of a 20,000-shingle document says nothing about 20 of them. The share of an item's sketch among the
    document's shingles estimates the containment without bias at any ratio of sizes. Items are partitioned by size, with
    a sketch length for each partition (see _sketches); only documents that have enough shingles for an item probe it. A
    document that holds ceil(threshold * q) of q shingles misses q - ceil(threshold * q) at most, so it has at least the
    sketch length less that many hits: pairs with fewer are no candidates, and no pair is missed. Candidates are verified
    by the exact shingle intersection.

    Items of equal shingles are searched for once. Items of fewer than n words and null or empty texts hold no shingles
    and match nothing. Rows that share a doc_id (null included) are reported once, with the best of them; of repeated
    item_ids each text is matched, the best is kept. Empty tables give no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", F.xxhash64(whole()).alias("raw"), whole().alias("text"))
    named = items.select("item_id", F.array_sort(shingles(whole(), n)).alias("shingles")).where(F.size("shingles") > 0)
    named = stored(named.withColumn("of", F.struct(F.xxhash64("shingles").alias("x"), F.hash("shingles").alias("y"))))
    need = F.ceil(F.size("shingles") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    sets = named.groupBy("of").agg(F.first("shingles").alias("shingles")).select("of", "shingles", F.size("shingles").alias("n_item"), need.alias("need"), F.lit(1.0 - threshold).alias("slack"))
    sketch = _sketches(sets)
    sent = lambda df, n: F.broadcast(df) if n <= broadcast_rows else df
    n_shingles = sets.agg(F.sum("n_item")).first()[0] or 0
    probe = rows.select("doc_id", "raw", once("s", shingles(F.col("text"), n))).select("doc_id", "raw", F.size("s").alias("x"), F.explode("s").alias("h"))
    hits = probe.join(sent(sketch, sketch.count()), "h").where("x >= need").groupBy("doc_id", "raw", "of").agg(F.countDistinct("h").alias("hits"), F.min("least_hits").alias("least_hits"))
    found = stored(hits.where("hits >= least_hits").select("doc_id", "raw", "of"))

    # a text is read again with some of its tests at a time, however many it has
    tests = found.join(sent(sets, n_shingles), "of").select("doc_id", "raw", F.struct("of", "shingles", "n_item", "need").alias("test"))
    many = found.groupBy("doc_id", "raw").agg(F.ceil(F.count(F.lit(1)) / TESTS).cast("int").alias("turns"))
    tests = tests.join(many, tests["doc_id"].eqNullSafe(many["doc_id"]) & (tests["raw"] == many["raw"])).select(tests["doc_id"].alias("at"), tests["raw"].alias("at_raw"), "test", F.pmod(F.xxhash64("test.of"), "turns").alias("turn"))
    tests = tests.groupBy("at", "at_raw", "turn").agg(F.collect_list("test").alias("tests"))
    shared = lambda s: F.transform("tests", lambda t: F.struct(t["of"].alias("of"), F.size(F.array_intersect(s, t["shingles"])).alias("n_shared"), t["n_item"].alias("n_item"), t["need"].alias("need")))
    held = rows.join(tests, rows["doc_id"].eqNullSafe(tests["at"]) & (rows["raw"] == tests["at_raw"])).select("doc_id", F.explode(let(shingles(F.col("text"), n), shared)).alias("r"))
    held = held.select("doc_id", "r.*").where("n_shared >= need").join(sent(named.select("of", "item_id"), named.count()), "of")
    best = held.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_shared", "b.n_item", F.round(F.col("b.n_shared") / F.col("b.n_item"), 6).alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = SIMILAR, n: int = SHINGLE) -> DataFrame:
    """docs without those that hold an item; all columns stay."""
    leaked = contained_items(docs, items, threshold, n).select(F.col("doc_id").alias("_leaked")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"))
    return rows.join(leaked, rows["_doc"].eqNullSafe(leaked["_leaked"]), "left_anti").select("row.*")
