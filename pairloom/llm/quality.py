"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow import add_columns

#: Labelled rows that are fitted on, at most: those of the least hash of doc_id.
MAX_ROWS = 20_000
REJECT_BELOW = 0.3
FEATURES = ("log_bytes", "word_length", "upper", "digits", "symbols", "bangs", "pipes", "stops", "commas", "spaces", "newlines", "not_ascii", "distinct_words", "top_word", "distinct_lines", "end_marks")
_CLASS = np.zeros((256, 10))
for _k, _chars in enumerate((range(65, 91), range(48, 58), b"#$%&*@^~<>{}[]_=+/\\", b"!", b"|", b".", b",", b" \t", b"\n", range(128, 256))):
    _CLASS[list(_chars), _k] = 1


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each whole text; a null is an empty text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, t in enumerate(texts.to_pylist()):
        if not t:
            continue
        raw = t.encode("utf-8", "replace")
        n = len(raw)
        words, lines = t.split(), t.split("\n")
        m = max(1, len(words))
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS / n
        ends = sum(not w[-1].isalnum() for w in words)
        out[i] = (np.log1p(n), n / m, *share, len(counts) / m, max(counts.values(), default=0) / m, len(set(lines)) / len(lines), ends / m)
    return out


@dataclass(frozen=True)
class Additive:
    """Cut points and a table of log-odds for each feature, the same for pairs on coarser cuts, and the intercept."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (c, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += t[np.searchsorted(c, x[:, f], side="right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"), np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-z))


def _cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, reg: float = 1.0, least: float = 2.0) -> tuple[float, int]:
    """Best gain and place of one cut through a histogram of gradients; 0 if none is good enough."""
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(cg):
        return 0.0, 0
    tg, th = g.sum(), h.sum()
    gain = cg**2 / (ch + reg) + (tg - cg) ** 2 / (th - ch + reg) - tg**2 / (th + reg)
    gain[(ch < least) | (th - ch < least)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, by bin, of a tree of at most 2^depth leaves over one feature's bins."""
    gain, k = _split(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1.0))
    return np.concatenate([_shallow_tree(g[:k], h[:k], depth - 1), _shallow_tree(g[k:], h[k:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values, by cell, of a tree over two features: one cut of the first, then one of the second on
    either side."""
    _, k = _split(g.sum(1), h.sum(1))
    out, total = np.zeros_like(g), 0.0
    for part in (slice(0, k), slice(k, None)):
        pg, ph = g[part].sum(0), h[part].sum(0)
        if not len(g[part]):
            continue
        gain, j = _split(pg, ph)
        total += gain
        for q in (slice(0, j), slice(j, None)):
            out[part, q] = pg[q].sum() / (ph[q].sum() + 1.0)
    return total, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 32, pair_bins: int = 8, n_pairs: int = 6) -> Additive:
    """Cyclic boosting: each round fits one shallow tree to each feature in turn, on the gradient that the others left,
    and adds it to the feature's table. Then the pairs whose two-way tree gains most on what is left are boosted alike.
    Without rows of both classes the score is a constant: the (smoothed) share of label 1, 0.5 without rows."""
    mean = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(mean / (1 - mean)))
    n = x.shape[1]
    cuts = [_cut_points(x[:, f], bins) if len(x) else np.array([]) for f in range(n)]
    coarse = [_cut_points(x[:, f], pair_bins) if len(x) else np.array([]) for f in range(n)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    if len(np.unique(y)) < 2:
        return Additive(intercept, cuts, tables, [], coarse, [])
    at = [np.searchsorted(cuts[f], x[:, f], side="right") for f in range(n)]
    z = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(n):
            g, h = slopes()
            tree = rate * _shallow_tree(np.bincount(at[f], g, len(tables[f])), np.bincount(at[f], h, len(tables[f])))
            tables[f] += tree
            z += tree[at[f]]
    low = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(n)]
    shape = [len(c) + 1 for c in coarse]
    grid = lambda a, b, v: np.bincount(low[a] * shape[b] + low[b], v, shape[a] * shape[b]).reshape(shape[a], shape[b])
    g, h = slopes()
    gains = sorted(((-_quadrants(grid(a, b, g), grid(a, b, h))[0], (a, b)) for a in range(n) for b in range(n) if a < b))
    pairs = [p for _, p in gains[:n_pairs]]
    pair_tables = [np.zeros((shape[a], shape[b])) for a, b in pairs]
    for _ in range(rounds // 3):
        for i, (a, b) in enumerate(pairs):
            g, h = slopes()
            tree = rate * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            pair_tables[i] += tree
            z += tree[low[a], low[b]]
    for t in tables:  # a table is centred, so that it reads as the feature's own effect
        intercept += float(t.mean())
        t -= t.mean()
    return Additive(intercept, cuts, tables, pairs, coarse, pair_tables)


def _remainder(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string")) % 5


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Additive:
    """Fit on labels (doc_id, quality 0/1) of rows whose crc32(doc_id) mod 5 isn't 0, on at most max_rows of them: that
    sample is what reaches the driver, as numbers. Null labels and ids aren't learned from; of a repeated doc_id every
    row is. Only text goes into a feature."""
    usable = labels.where("quality is not null and doc_id is not null").where(_remainder() != 0).select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("y"))
    sample = usable.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("id", "y", "text")
    made = add_columns(rows, [("x", T.ArrayType(T.DoubleType()))], lambda b: [pa.array(list(features(b.column("text"))), pa.list_(pa.float64()))]).drop("text")
    got = made.orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """docs with score double, 0 to 1, higher where label 1 is likelier: the whole text's features, looked up in the
    model's tables. Every row gets one; a null text is scored as an empty one. Other columns pass through."""
    return add_columns(docs, [("score", T.DoubleType())], lambda b: [pa.array(model.score(features(b.column("text"))))])
