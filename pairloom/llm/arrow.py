"""Running vectorised Python over batches of documents inside Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def add_columns(docs: DataFrame, fields: list[tuple[str, T.DataType]], compute: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """docs with the columns that compute() makes of a batch; columns of the same names are replaced in place, new ones
    come last. Batches are bounded in rows and bytes by the session's Arrow settings."""
    new = dict(fields)
    schema = T.StructType([T.StructField(f.name, new.get(f.name, f.dataType)) for f in docs.schema] + [T.StructField(n, t) for n, t in fields if n not in docs.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = dict(zip(new, compute(batch), strict=True))
            names = [*batch.schema.names, *[n for n in new if n not in batch.schema.names]]
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n) if n in batch.schema.names else None) for n in names], names)

    return docs.mapInArrow(run, schema)
