"""Chat formatting: logged snapshots of one growing conversation collapse to the longest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.session import stored


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation the hash after every turn, which covers the hash before it, the role and the text. Lengths
    go in, too: no two fields run into each other, and a null isn't an empty string."""
    for b in batches:
        made = []
        for turns in b.column("turns").to_pylist():
            h, out = b"", []
            for t in turns:
                step = hashlib.blake2b(h, digest_size=16)
                for field in (t["role"], t["text"]):
                    raw = None if field is None else field.encode("utf-8", "replace")
                    step.update(b"-" if raw is None else b"%d:" % len(raw))
                    step.update(raw or b"")
                out.append(h := step.digest())
            made.append(out)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.list_(pa.binary()))], [*b.schema.names, "h"])


def _render(turns: Column) -> Column:
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    one = lambda t: F.concat(F.lit("<|im_start|>"), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), clean(t["text"]), F.lit("<|im_end|>\n"))
    return F.array_join(F.transform(turns, one), "")


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text; more columns are ignored) -> conv_id, n_turns, n_copies, prefix_hash, rendered.

    A chat service logs a conversation again after each turn, so the log holds every prefix of it. Each conversation
    gets a rolling hash: the hash after a turn covers the hash before it, the role and the text. Conversations of equal
    full hash are copies: the least conv_id stands for them, n_copies counts them. One whose full hash is the hash of a
    proper prefix of another goes (left anti join); what is left is maximal and gets rendered.

    Turns are ordered by turn, role, text, nulls first; a turn logged twice with the same role and text counts once, and
    two texts of one turn both stay. The turn number itself isn't hashed, only the order. A null conv_id is one
    conversation like any other; a null role renders as "unknown", a null text as an empty one, yet neither hashes as
    that. A conversation of any number of turns takes time in proportion; it is one row, as its rendered form is. No rows
    give no rows. A text that holds the chat markers has them broken up when rendered.
    """
    by_conv = turns.groupBy("conv_id").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    schema = T.StructType([*by_conv.schema, T.StructField("h", T.ArrayType(T.BinaryType()))])
    hashed = by_conv.mapInArrow(_rolling, schema).withColumn("full", F.element_at("h", -1))
    hashed = stored(hashed)  # grouped once; what follows reads the columns that it needs
    # copies first, so that a conversation logged a million times is one row from here on
    heads = hashed.groupBy("full").agg(F.count(F.lit(1)).alias("n_copies"), F.min("conv_id").alias("head"), F.max(F.col("conv_id").isNull()).alias("has_null"))
    heads = heads.withColumn("head", F.when(~F.col("has_null"), F.col("head")))
    kept = hashed.join(heads.select("head", "n_copies"), F.col("conv_id").eqNullSafe(F.col("head"))).drop("head")
    proper = kept.select(F.explode(F.slice("h", F.lit(1), F.size("h") - 1)).alias("full")).distinct()
    return kept.join(proper, "full", "left_anti").select("conv_id", F.size("turns").alias("n_turns"), "n_copies", F.hex("full").alias("prefix_hash"), _render(F.col("turns")).alias("rendered"))
