"""MinHash near-dedup: weighted signatures, bands, verified multiset overlap, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.text import SHINGLE, SIMILAR, salted, whole, words
from pairloom.operators.graph import connected_components
from pairloom.session import stored

#: Registers of a signature, and those in a band. Two sets of bands, each over all registers, make 64 bands: of pairs at
#: a similarity of 0.8 they miss about one in 10^5, at 0.85 one in 10^8.
REGISTERS, ROWS = 256, 8
#: Pairs of one text from which its multiset is dealt over several tasks; rows (32 bytes each) to be read again up to which
#: their ids are sent to every executor.
BUSY, BROADCAST_IDS = 64, 250_000
#: Shingles in a block of the comparison between classes; what a text counts for at least, which bounds a block's texts
#: (about 512); distinct shingles compared at a time.
BLOCK, LEAST, COLUMNS = 1 << 18, 512, 2048
_U = np.uint64


def _stir(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def bag(word_hashes: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and how often each is in it. A text of fewer than n words is one shingle."""
    w = word_hashes.view(_U)
    if not len(w):
        return np.empty(0, _U), np.empty(0, np.int64)
    k = min(n, len(w))
    s = np.full(len(w) - k + 1, _U(k))
    for i in range(k):
        s = (s + w[i : i + len(s)]) * _U(0x9E3779B97F4A7C15)
        s ^= s >> _U(29)
    return np.unique(_stir(s), return_counts=True)


def bag_minhash(keys: np.ndarray, weights: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """BagMinHash signature (float64[m]) of a multiset: the share of registers that two have in common is an unbiased
    estimate of their weighted Jaccard similarity.

    Each key has a Poisson process over time and weight; register i holds the time of the first point dealt to it whose
    weight lies below the key's. Weights are discretised to whole numbers and split up in a hierarchy of intervals
    [0,1), [1,2), [2,4), [4,8)...: an interval's process is drawn from a seed of its own, so keys of equal intervals have
    equal points whatever their weights, and only intervals that reach below the weight are drawn. Points come in order
    of time, and a process ends once it is later than every register: most of them after a point or two.
    """
    out = np.full(m, np.inf)
    if not len(keys):
        return out
    levels = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64), 0)
    which = np.repeat(np.arange(len(keys)), levels + 1)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels + 1) - levels - 1, levels + 1)
    seed = _stir(keys[which] + _U(0xD1342543DE82EF95) * (level.astype(_U) + _U(1)))
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.where(level > 0, low, 1)
    room = np.minimum(weights[which] - low, width)
    time, drawn = np.zeros(len(seed)), 0
    need = int(1.5 * m * np.log(m))
    while len(seed):
        k = int(np.clip(need // len(seed), 1, 64))
        step = np.arange(drawn, drawn + k, dtype=_U) * _U(0x9E3779B97F4A7C15)
        r = _stir(seed[:, None] + step)
        gap = -np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
        gap[:, 0] += time
        at = np.add.accumulate(gap, axis=1)  # one sum after another: the same points at the same times in any batch
        r = _stir(r ^ _U(0xA0761D6478BD642F))
        ok = ((r >> _U(32)).astype(np.int64) * width[:, None] >> 32) < room[:, None]
        np.minimum.at(out, (r & _U(m - 1)).astype(np.int64)[ok], at[ok])
        drawn += k
        on = at[:, -1] < out.max()
        seed, time, width, room = seed[on], at[on, -1], width[on], room[on]
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A key for each band: its number and its registers. The second set takes registers a stride apart."""
    bits = signature.view(_U)
    both = np.concatenate([bits.reshape(-1, ROWS), bits.reshape(ROWS, -1).T])
    key = np.arange(len(both), dtype=_U)
    for i in range(ROWS):
        key = _stir((key + both[:, i]) * _U(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield values[a:b]


def _word_hashes() -> Column:
    return F.transform(words(whole()), lambda w: F.xxhash64(w))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [bag_minhash(*bag(h)) if len(h) else None for h in _lists(b.column("h"))]
        made = [np.empty(0, np.int64) if f is None else bands(f) for f in found]
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("raw"), b.column("key"), pa.array(made, pa.list_(pa.int64()))], ["doc", "raw", "key", "bands"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A multiset as a set: the i-th copy of a shingle is an element of its own."""
    for b in batches:
        b = b.filter(pc.equal(b.column("of"), b.column("x")))  # two texts of one hash
        made = []
        for h in _lists(b.column("h")):
            keys, n = bag(h)
            copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            made.append(_stir(np.repeat(keys, n) + copy.astype(_U) * _U(0xD1342543DE82EF95)).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(made, pa.list_(pa.int64()))], ["id", "bag"])


def _links(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b), those whose multisets overlap by the threshold: the sum of the lesser counts over that of the
    greater ones. b is a leader that may be in very many pairs: its multiset is sent to as many tasks as they need."""
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BUSY).cast("int").alias("parts"))
    led = bags.select(F.col("id").alias("b"), F.col("bag").alias("right")).join(parts, "b").select("b", "right", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    busy = parts.where("parts > 1")
    dealt = pairs.join(busy, "b", "left").select("a", "b", F.coalesce(F.pmod(F.hash("a"), F.col("parts")), F.lit(0)).alias("part"))
    both = dealt.join(led, ["b", "part"]).join(bags.select(F.col("id").alias("a"), F.col("bag").alias("left")), "a")
    common = F.size(F.array_intersect("left", "right"))
    least, most = F.least(F.size("left"), F.size("right")), F.greatest(F.size("left"), F.size("right"))
    enough = lambda n: n >= F.lit(threshold) * (F.size("left") + F.size("right") - n) - F.lit(1e-9)
    return both.where((least >= F.lit(threshold) * most - F.lit(1e-9)) & enough(common)).select("a", "b")


def _first_pairs(near: DataFrame) -> DataFrame:
    """Each text with the leader that it meets in most of its buckets."""
    votes = near.where("id <> lead").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("id").agg(F.max(F.struct("n", "lead"))["lead"].alias("b")).select(F.col("id").alias("a"), "b")


def _overlaps(bags: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each bag of left has in common with each of right, some distinct elements at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    _, element, n = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    shared = n > 1
    row, element = row[shared[element]], (np.cumsum(shared) - 1)[element[shared[element]]]
    order = np.argsort(element, kind="stable")
    row, element = row[order], element[order]
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(element, [first, first + COLUMNS])
        has = np.zeros((len(bags), COLUMNS), np.float32)
        has[row[a:b], element[a:b] - first] = 1
        out += has[left] @ has[right].T
    return out


def _forest(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Of a pair of blocks (or one), links between classes of the one and of the other: no more than join them up."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        bags = list(_lists(t.column("bag").chunk(0)))
        side, size = t.column("side").to_numpy(), np.array([len(b) for b in bags], np.float32)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        names, of = np.unique(t.column("component").to_numpy(), return_inverse=True)
        common = _overlaps(bags, left, right)
        linked = common >= threshold * (size[left][:, None] + size[right] - common) - 1e-6
        x, y = np.nonzero(linked & (of[left][:, None] != of[right]))
        parent, made = list(range(len(names))), []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        for i, j in np.unique(np.stack([of[left[x]], of[right[y]]], axis=1), axis=0).tolist():
            if (p := root(i)) != (q := root(j)):
                parent[p] = q
                made.append((names[i], names[j]))
        return pa.table({"src": pa.array([m[0] for m in made], pa.int64()), "dst": pa.array([m[1] for m in made], pa.int64())})

    return run


def _links_between(near: DataFrame, groups: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Links (src, dst) between classes of groups (id, component) that meet in a bucket.

    Texts of contested buckets fall into families, the connected components of meeting one another. Within a family all
    classes are compared: its texts are dealt into blocks of bounded size, and a task compares two blocks. A class that
    fills blocks of its own is not compared with itself.
    """
    at = near.join(groups, "id")
    contested = at.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("bucket")
    meet = stored(at.join(contested, "bucket").select("id", "lead", "component"))
    family = connected_components(meet.select("id", "lead").distinct(), "id", "lead").withColumnRenamed("component", "family")
    weight = F.greatest(F.size("bag"), F.lit(LEAST)).cast("long")
    members = stored(groups.join(family, "id").join(bags, "id").select("id", "family", "component", weight.alias("weight"), "bag"))

    blocks_of = lambda w: F.ceil(w / BLOCK).cast("int")
    classes = members.groupBy("family", "component").agg(F.sum("weight").alias("w"))
    rest = classes.where(F.col("w") < BLOCK).groupBy("family").agg(F.sum("w").alias("rest"))
    classes = salted(classes, rest, "family", F.col("component"), how="left").select("family", "component", (F.col("w") >= BLOCK).alias("big"), F.when(F.col("w") >= BLOCK, blocks_of(F.col("w"))).otherwise(blocks_of(F.col("rest"))).alias("parts"))
    own = F.when(F.col("big"), F.col("component")).otherwise(F.lit(0)).cast("long")
    block = F.struct("big", own.alias("own"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("k"))
    placed = members.join(classes, ["family", "component"]).select("family", "component", block.alias("block"), "bag")
    blocks = members.select("id", "family", "component").join(classes, ["family", "component"]).select("family", block.alias("block")).distinct()
    x, y = blocks.withColumnRenamed("block", "x"), blocks.withColumnRenamed("block", "y")
    pairs = x.join(y, "family").where("x <= y and not (x.big and y.big and x.own = y.own)")
    both = F.array(F.struct(F.col("x").alias("block"), F.lit(0).alias("side")), F.struct(F.col("y").alias("block"), F.lit(1).alias("side")))
    one = F.array(F.struct(F.col("x").alias("block"), F.lit(2).alias("side")))
    sides = pairs.select("family", "x", "y", F.explode(F.when(F.col("x") == F.col("y"), one).otherwise(both)).alias("s")).select("family", "x", "y", "s.*")
    dealt = placed.join(sides, ["family", "block"]).select("family", "x", "y", "side", "component", "bag")
    return dealt.groupBy("family", "x", "y").applyInArrow(_forest(threshold), "src bigint, dst bigint")


def _linked_classes(near: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(id, component) of the texts in near (id, bucket, lead)."""
    links = stored(_links(_first_pairs(near), bags, threshold))
    known = connected_components(links, "a", "b")
    groups = stored(near.select("id").distinct().join(known, "id", "left").select("id", F.coalesce("component", "id").alias("component")))
    joined = connected_components(stored(_links_between(near, groups, bags, threshold)))
    joined = joined.select(F.col("id").alias("component"), F.col("component").alias("to"))
    return groups.join(joined, "component", "left").select("id", F.coalesce("to", "component").alias("component"))


def _key() -> Column:
    """Tells texts apart by their words."""
    return F.struct(F.xxhash64("h").alias("x"), F.hash("h").alias("y"), F.size("h").alias("n"))


def _row(docs: DataFrame) -> list[Column]:
    """What a row of docs is found again by: its doc_id and a hash of its text."""
    return [docs["doc_id"].alias("doc"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("raw")]


def _first_row(*columns: str) -> Column:
    """The row of least doc_id, those without one last."""
    return F.min(F.struct(F.col("doc").isNull().alias("none"), *columns))


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc, raw, key) for each row of docs, and (key, head, copies, component) for each distinct text: its first row,
    how many rows have it, and the class that it is in."""
    rows = docs.select(*_row(docs), whole().alias("text"))
    hashed = lambda texts: texts.withColumn("h", _word_hashes())
    keyed = hashed(rows).select("doc", "raw", _key().alias("key"), "h")
    fields = [T.StructField(f.name, f.dataType) for f in keyed.schema if f.name != "h"]
    signed = stored(keyed.mapInArrow(_signed, T.StructType([*fields, T.StructField("bands", T.ArrayType(T.LongType()))])))
    # texts get numbers, which stay as they are once they are stored: from here on a text is its number
    heads = signed.groupBy("key").agg(_first_row("doc", "raw").alias("head"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    heads = stored(heads.withColumn("id", F.monotonically_increasing_id()))
    meets = heads.select("id", F.explode("bands").alias("bucket"))
    lead = meets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id"), F.col("id")))["id"].alias("lead")).where("n > 1")
    near = stored(meets.join(lead, "bucket").select("id", "bucket", "lead"))

    def bags_of(wanted: DataFrame) -> DataFrame:
        """The multisets of some texts, each from its first row; the rows to read go to every executor as long as they
        are few."""
        of = wanted.join(heads, "id").select("id", F.col("head.doc").alias("doc"), F.col("head.raw").alias("raw"), F.col("key.x").alias("of"))
        of = F.broadcast(of) if wanted.count() <= BROADCAST_IDS else of
        found = rows.join(of, rows["doc"].eqNullSafe(of["doc"]) & (rows["raw"] == of["raw"])).select("id", "of", "text")
        again = hashed(found).select("id", "of", F.xxhash64("h").alias("x"), "h")
        return again.mapInArrow(_elements, "id bigint, bag array<bigint>").groupBy("id").agg(F.min("bag").alias("bag"))

    bags = stored(bags_of(stored(near.select("id").distinct())))
    groups = _linked_classes(near, bags, threshold)
    texts = heads.select("id", "key", "head", "copies").join(groups, "id", "left")
    return signed.select("doc", "raw", "key"), texts.select("key", "head", "copies", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """docs (doc_id, text) -> doc_id, class_id, class_size: one row for each row of docs; class_id is the least doc_id of
    the class, class_size the number of its rows.

    Texts are multisets of five-word shingles (lower-cased words; punctuation is none). Two are linked if their weighted
    Jaccard similarity is at least the threshold; a class is a connected component of links.

    1. Texts of equal words are one class from the start; only one of them goes on, under a number of its own. 2.
    BagMinHash signatures are cut into bands; those that share a band meet in a bucket. Every bucket has a leader, the
    least of one ranking of all texts. 3. Each text is verified against the leader that it meets most often: a group of
    n copies costs n pairs, not n^2. 4. Components over the verified links. 5. Where different classes still meet in a
    bucket, they are compared in full, in blocks of bounded size, and components are joined. Every pair is verified on
    whole multisets, and no pair that meets in a bucket is left out.

    Texts without words (null, empty, punctuation only) are equal to each other: one class. A text of fewer than five
    words is one shingle. Classes are of texts, not of ids: a row without doc_id is in the class of its text, whose
    class_id is null only if no row of it has one; rows that share a doc_id are each in the class of their own text.
    Repeated rows stay. Empty tables give none; other columns are ignored.
    """
    rows, texts = _classes(docs, threshold)
    texts = stored(texts)
    of = texts.groupBy("component").agg(F.min("head.doc").alias("class_id"), F.sum("copies").alias("class_size"))
    found = texts.join(of, "component").select("key", "class_id", "class_size")
    return rows.join(found, "key").select(F.col("doc").alias("doc_id"), "class_id", "class_size")


def drop_near_duplicates(docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """docs with exactly one row of each class (see near_duplicates): one of least doc_id, a row without doc_id only
    where the class has none with one. All columns stay. Of rows that are alike in doc_id and text any one stays."""
    _, texts = _classes(docs, threshold)
    kept = texts.groupBy("component").agg(F.min("head").alias("head")).select(F.col("head.doc").alias("_kept"), F.col("head.raw").alias("_of"))
    doc, raw = _row(docs)
    rows = docs.select(F.struct("*").alias("row"), doc.alias("_doc"), raw.alias("_raw"))
    found = rows.join(kept, rows["_doc"].eqNullSafe(kept["_kept"]) & (rows["_raw"] == kept["_of"]), "left_semi")
    nth = F.row_number().over(Window.partitionBy("_doc", "_raw").orderBy(F.lit(1)))
    return found.withColumn("_nth", nth).where("_nth = 1").select("row.*")
