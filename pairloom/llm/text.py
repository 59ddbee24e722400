"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: anything but letters and digits.
NON_WORD = r"[^\p{L}\p{N}]+"
#: Words in a shingle, and the similarity from which texts count as near duplicates.
SHINGLE = 5
SIMILAR = 0.8


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once a row, also where a lambda inside names it many times."""
    return F.transform(F.array(value), then)[0]


def once(name: str, value: Column) -> Column:
    """value as a column of its own, computed once a row: conditions on it aren't moved below it and computed again."""
    return F.explode(F.array(value)).alias(name)


def whole(col: str = "text") -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """Lower-cased words in order; no words: an empty array."""
    return F.array_remove(F.split(F.lower(text), NON_WORD), "")


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """Distinct 64-bit hashes of all runs of n words; fewer than n words: an empty array."""

    def runs(ws: Column) -> Column:
        at = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.slice(ws, i, n))))

    return let(words(text), runs)


def same(left: DataFrame, right: DataFrame, key: str) -> Column:
    """Null-safe equality on a key that both sides have."""
    return left[key].eqNullSafe(right[key])


def salted(rows: DataFrame, few: DataFrame, key: str, by: Column, salts: int = 16, how: str = "inner") -> DataFrame:
    """rows join few on key, where few has each key once and rows may have one key in a third of them: few is repeated
    for every salt, rows are dealt over the salts."""
    few = few.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return rows.withColumn("_salt", F.pmod(F.hash(by), F.lit(salts))).join(few, [key, "_salt"], how).drop("_salt")
