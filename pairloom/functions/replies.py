"""Replies of models: JSON found in free text, and what it has to say."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a model's fences and thoughts look like.
_FENCE = re.compile(r"```(?:json)?\s*\n?(.*?)\n?```", re.DOTALL)
_THINK = re.compile(r"`think`.*?`</think>`|<think>.*?</think>", re.DOTALL | re.IGNORECASE)


_MARK = re.compile(r'[{}"\\]')


def objects_in(text: str) -> list[str]:
    """Balanced {...} of a text from left to right, none within another; braces within strings don't count. One scan, which
    stops at braces, quotes and backslashes only: a brace that is never closed ends it."""
    found, start, depth, quoted, escaped = [], -1, 0, False, -1
    for m in _MARK.finditer(text):
        i, c = m.start(), m[0]
        if quoted:
            if i == escaped:
                continue
            escaped, quoted = (i + 1, True) if c == "\\" else (escaped, c != '"')
        elif c == "{":
            start, depth = (i, 1) if not depth else (start, depth + 1)
        elif depth and c == '"':
            quoted = True
        elif depth and c == "}":
            depth -= 1
            if not depth:
                found.append(text[start : i + 1])
    return found


def _object(blob: str, key: str | None) -> str | None:
    try:
        made = json.loads(blob)
    except ValueError:
        return None
    return json.dumps(made) if isinstance(made, dict) and (key is None or key in made) else None


def salvaged(text: str | None, key: str | None) -> str | None:
    """The last JSON object of a reply that has the key: of the whole text, of what is fenced, or of a part of it."""
    content = _THINK.sub("", text or "").strip()
    fenced = _FENCE.search(content)
    content = fenced[1].strip() if fenced else content
    return _object(content, key) or next((o for b in reversed(objects_in(content)) if (o := _object(b, key))), None)


def first_object(text: str | None) -> str | None:
    """The first balanced object of a text, if it is JSON; a text that starts with a fence is what the fence holds."""
    content = (text or "").strip()
    if content.startswith("```") and (end := content.find("```", 3)) > 0:
        content = content[3:end].strip().removeprefix("json").strip()
    blobs = objects_in(content)
    return _object(blobs[0], None) if blobs else None


def salvaged_json(text: Column, key: str = "edit_executed") -> Column:
    """See salvaged(); null where there is none."""
    return F.pandas_udf(lambda s: pd.Series([salvaged(t, key) for t in s], dtype=object), "string")(text)


def first_json(text: Column) -> Column:
    """See first_object()."""
    return F.pandas_udf(lambda s: pd.Series([first_object(t) for t in s], dtype=object), "string")(text)


def alignment(reply: Column) -> Column:
    """aligned, best_view, reason of a reply (JSON): aligned has to be a boolean, else there is no answer (null); a view
    that isn't a whole number is 0."""
    v = F.try_parse_json(reply)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    whole = kind("$.best_view") == "BIGINT"
    made = F.struct(F.try_variant_get(v, "$.aligned", "boolean").alias("aligned"), F.when(whole, F.try_variant_get(v, "$.best_view", "int")).otherwise(0).alias("best_view"), F.try_variant_get(v, "$.reason", "string").alias("reason"))
    return F.when(kind("$.aligned") == "BOOLEAN", made)
