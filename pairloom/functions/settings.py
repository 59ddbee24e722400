"""Settings: nested thresholds, merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merged(base: dict, override: dict | None) -> dict:
    """base with override's values, level by level."""
    out = dict(base)
    for k, v in (override or {}).items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def as_table(spark: SparkSession, settings: dict[str, dict[str, float]]) -> DataFrame:
    """kind, name, value: settings of two levels as a table of literals."""
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), F.lit(float(v)).alias("value")) for k, level in settings.items() for n, v in level.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))
