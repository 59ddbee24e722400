"""Whitening of embeddings: principal components of the distinct quantised vectors, at unit variance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import stored

#: Steps of the grid in a unit, and components that are returned.
STEPS, COMPONENTS = 256, 4


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def vectors_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows' numbers and their vectors as a matrix, for each length of vector in the batch."""
    ends = column.offsets.to_numpy()
    flat, size = column.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, flat[ends[at][:, None] + np.arange(n)]


def _second_moments(means: dict[int, np.ndarray]):
    """Of each batch, the weighted product of its centred vectors with themselves; one partial matrix a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            w = b.column("w").to_numpy().astype(np.float64)
            for at, x in vectors_of(b.column("x")):
                c = x.astype(np.float64) - means[x.shape[1]]
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + (c * w[at][:, None]).T @ c
        for d, m in total.items():
            for first in range(d):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d - first, v), k) for v, k in ((d, pa.int32()), (first, pa.int32()))] + [pa.array(np.arange(first, d), pa.int32()), pa.array(m[first, first:])], ["d", "i", "j", "v"])

    return run


def _projected(models: dict[int, tuple[np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list = [None] * b.num_rows
            for at, x in vectors_of(b.column("x")):
                mean, axes = models[x.shape[1]]
                for i, row in zip(at.tolist(), ((x.astype(np.float64) - mean) @ axes).tolist(), strict=True):
                    made[i] = row
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("x", "w")), pa.array(made, pa.list_(pa.float64()))], ["x", "w", "z"])

    return run


def whiten(rows: DataFrame, vector: str = "embedding", multiplicity: bool = False, components: int = COMPONENTS) -> DataFrame:
    """rows -> its rows with a usable vector, all columns, and
    x array<long> (floor(256 c) of each entry), n long (the fit's weight: how many distinct x, or with multiplicity how
    many rows), deviation long (sum over dimensions of (n x - S)^2 with S the weighted sum), z array<double> (whitened
    components by falling eigenvalue), explained array<double> (each one's share of the trace), identity_error double
    (largest absolute entry of the covariance of z in the fit, minus the identity). Columns of these names are replaced.

    1. Equal x are one row with a count, combined before the shuffle. 2. Sums S, exactly. 3. Covariance with divisor n,
    centred before multiplying: a matrix product a batch, one partial matrix a task, added up by Spark. 4. Eigenvectors
    of that matrix on the driver, which sees dimension^2 numbers and no rows. 5. Each distinct x is projected once and
    joined back to the rows that have it.

    Rows whose vector is null or holds null or non-finite entries go. Vectors of different lengths are fits of their own;
    an empty vector has no components: empty z. Fewer dimensions than components: fewer components. Where there is no
    variance along a component, z and explained are 0, which identity_error then shows as 1; sums or deviations beyond a
    long are null. Repeated rows stay, an empty table stays empty.
    """
    kept = rows.where(usable(vector))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS) + F.lit(0).cast("long"))
    kept = kept.withColumn("x", x).drop("n", "deviation", "z", "explained", "identity_error")
    weight = F.count(F.lit(1)) if multiplicity else F.max(F.lit(1).cast("long"))
    distinct = stored(kept.groupBy("x").agg(weight.alias("w")))
    entries = distinct.select(F.size("x").alias("d"), "w", F.posexplode("x").alias("i", "c"))
    wide = "decimal(38,0)"
    sums = entries.groupBy("d", "i").agg(F.sum("w").alias("n"), F.sum((F.col("c").cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)")).cast(wide)).alias("s")).collect()
    n = {r["d"]: r["n"] for r in sums}
    total = {d: [0] * d for d in n}
    for r in sums:
        total[r["d"]][r["i"]] = int(r["s"])
    means = {d: np.array([s // n[d] + (s % n[d]) / n[d] for s in total[d]]) for d in n}

    found = distinct.where(F.size("x") > 0).mapInArrow(_second_moments(means), "d int, i int, j int, v double")
    models, explained = {}, {}
    cov = {d: np.zeros((d, d)) for d in n}
    for r in found.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect():
        cov[r["d"]][r["i"], r["j"]] = cov[r["d"]][r["j"], r["i"]] = r["v"] / n[r["d"]]
    for d, v in cov.items():
        e, axes = np.linalg.eigh(v)
        first = np.argsort(-e, kind="stable")[:components]
        e, axes = e[first], axes[:, first]
        trace = np.trace(v)
        some = e > 1e-13 * max(trace, 1e-300) * d
        models[d] = (means[d], np.where(some, axes / np.sqrt(np.where(some, e, 1.0)), 0.0))
        explained[d] = np.where(some, e / (trace or 1.0), 0.0).tolist()
    models[0] = (np.zeros(0), np.zeros((0, 0)))

    whitened = stored(distinct.mapInArrow(_projected(models), "x array<bigint>, w bigint, z array<double>"))
    error = _identity_error(whitened)
    spark, lengths = rows.sparkSession, sorted(n) or [0]
    table = [(d, n.get(d, 0), [s if abs(s) < 2**63 else None for s in total.get(d, [])], explained.get(d, []), error.get(d)) for d in {*lengths, 0}]
    fits = F.broadcast(spark.createDataFrame(table, "d int, n long, s array<long>, explained array<double>, identity_error double"))  # one row for each length
    term = F.zip_with("x", "s", lambda a, s: F.try_subtract(F.try_multiply(F.col("n"), a), s))
    deviation = F.aggregate(F.transform(term, lambda t: F.try_multiply(t, t)), F.lit(0).cast("long"), F.try_add)
    fitted = whitened.select("x", "z", F.size("x").alias("d")).join(fits, "d").select("x", "n", deviation.alias("deviation"), "z", "explained", "identity_error")
    return kept.join(fitted, "x").select(*[c for c in kept.columns if c != "x"], "x", "n", "deviation", "z", "explained", "identity_error")


def _identity_error(whitened: DataFrame) -> dict[int, float]:
    """By length of vector; a weighted mean first, then centred products."""
    d = F.size("x").alias("d")
    z = whitened.select(d, "w", F.posexplode("z").alias("i", "z"))
    means = {(r["d"], r["i"]): r["m"] for r in z.groupBy("d", "i").agg((F.sum(F.col("w") * F.col("z")) / F.sum("w")).alias("m")).collect()}
    widths = {n: 1 + max(i for m, i in means if m == n) for n, _ in means}
    error: dict[int, float] = {}
    for n, k in widths.items():
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        centred = lambda i: F.col("z")[i] - F.lit(means[n, i])  # noqa: B023, E731
        sums = [(F.sum(F.col("w") * centred(i) * centred(j)) / F.sum("w")).alias(f"{i}_{j}") for i, j in pairs]
        r = whitened.where(F.size("x") == n).agg(*sums).first()
        error[n] = max(abs(r[f"{i}_{j}"] - (i == j)) for i, j in pairs)
    return error
