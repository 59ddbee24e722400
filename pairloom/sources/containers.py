"""Containers of arrays (NPZ): what they hold, by their headers, and the cells and dense latents of those with latents."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from typing import IO

import numpy as np
import pyarrow as pa
from numpy.lib import format as npy
from pyspark.sql import DataFrame, SparkSession

CONTENTS = "path string, key string, dtype string, shape array<int>, nbytes long, json_keys array<string>, json_empty array<string>, number double, error string"
_IDS = "path string, obj_id string, edit_id string, role string, error string"
CELLS = f"{_IDS}, b int, x int, y int, z int, feats array<float>"
DENSE = f"{_IDS}, shape array<int>, ss array<float>"
#: Entries up to which a numeric array is read for its first number; rows in a batch; headers that are kept.
FEW, ROWS, HEADERS = 16, 10_000, 1000


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of all files that a path names."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _header(f: IO[bytes], known: dict) -> tuple[tuple[int, ...], np.dtype]:
    """Shape and type of an array; equal headers, of which there are many, are parsed once."""
    version = npy.read_magic(f)
    size = f.read(2 if version == (1, 0) else 4)
    raw = size + f.read(int.from_bytes(size, "little"))
    if (version, raw) not in known:
        if len(known) >= HEADERS:
            known.clear()
        shape, _, dtype = (npy.read_array_header_1_0 if version == (1, 0) else npy.read_array_header_2_0)(io.BytesIO(raw))
        known[version, raw] = shape, dtype
    return known[version, raw]


def _entries(content: bytes, known: dict) -> Iterator[dict]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            row = {"key": info.filename.removesuffix(".npy"), "nbytes": info.file_size}
            with z.open(info) as f:
                if info.filename.endswith(".npy"):
                    shape, dtype = _header(f, known)
                    n = int(np.prod(shape, dtype=np.int64))
                    row |= {"dtype": dtype.str, "shape": list(shape), "nbytes": n * dtype.itemsize}
                    if dtype.kind in "fiu" and 0 < n <= FEW and not row["key"].endswith(".json"):
                        row["number"] = float(np.frombuffer(f.read(n * dtype.itemsize), dtype)[0])
                    if dtype.hasobject and row["key"].endswith(".json"):
                        row["error"] = "an object array isn't read"
                        yield row
                        continue
                if row["key"].endswith(".json"):
                    try:
                        said = json.loads(f.read())
                        if isinstance(said, dict):
                            row |= {"json_keys": sorted(said), "json_empty": sorted(k for k, v in said.items() if not v)}
                        else:
                            row["error"] = "not an object"
                    except ValueError:
                        row["error"] = "not JSON"
            yield row


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"path": pa.string(), "key": pa.string(), "dtype": pa.string(), "shape": pa.list_(pa.int32()), "nbytes": pa.int64(), "json_keys": pa.list_(pa.string()), "json_empty": pa.list_(pa.string()), "number": pa.float64(), "error": pa.string()}
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()], list(kinds))
    rows, known = [], {}
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            try:
                rows += [{"path": path, **e} for e in _entries(content.as_py() or b"", known)]
            except (zipfile.BadZipFile, ValueError, OSError, EOFError):
                rows.append({"path": path, "error": "unreadable"})
            if len(rows) >= ROWS:
                yield batch(rows)
                rows = []
    if rows:
        yield batch(rows)


def contents(given: DataFrame) -> DataFrame:
    """given (path, content) -> path, key, dtype, shape, nbytes, json_keys, json_empty (keys of empty values), number,
    error: a row for each member of each container. Arrays aren't read, but for their headers; of those with up to 16
    numbers the first one is, of members named *.json the keys. What can't be read has a row that says so."""
    return given.select("path", "content").mapInArrow(_listed, CONTENTS)


def _ids(path: str) -> tuple[str | None, str | None, str | None]:
    """Object, edit and role of .../<edit_id>/<role>.npz; an edit's id holds its object's."""
    m = re.search(r"([^/]+)/(before|after)\.npz$", path)
    if m is None:
        return None, None, None
    o = re.fullmatch(r"[^_]+_(.+)_\d+", m[1])
    return o and o[1], m[1], m[2]


def _latents(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    with np.load(io.BytesIO(content), allow_pickle=False) as z:
        coords, feats, ss = z["slat_coords"], z["slat_feats"], z["ss"] if "ss" in z.files else None
    if coords.ndim != 2 or coords.shape[1] not in (3, 4) or feats.ndim != 2 or len(coords) != len(feats):
        raise ValueError(f"coords {coords.shape} don't fit feats {feats.shape}")
    return coords if coords.shape[1] == 4 else np.insert(coords, 0, 0, axis=1), feats, ss


def _decoded(dense: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                named = dict(zip(("path", "obj_id", "edit_id", "role"), (path, *_ids(path)), strict=True))
                try:
                    coords, feats, ss = _latents(content.as_py() or b"")
                except (KeyError, ValueError, OSError, EOFError, zipfile.BadZipFile) as e:
                    yield _batch(named, 1, dense, error=str(e) or type(e).__name__)
                    continue
                if dense and ss is not None:
                    yield _batch(named, 1, True, shape=list(ss.shape), ss=ss.astype(np.float32).ravel())
                for i in range(0, 0 if dense else len(coords), ROWS):
                    yield _batch(named, len(coords[i : i + ROWS]), False, coords=coords[i : i + ROWS], feats=feats[i : i + ROWS])

    return run


def _batch(named: dict, n: int, dense: bool, error: str | None = None, coords=None, feats=None, shape=None, ss=None) -> pa.RecordBatch:
    columns = {c: pa.array([v] * n, pa.string()) for c, v in (*named.items(), ("error", error))}
    floats = pa.list_(pa.float32())
    if dense:
        columns |= {"shape": pa.array([shape], pa.list_(pa.int32())), "ss": pa.array([ss], floats)}
    else:
        columns |= {a: pa.nulls(n, pa.int32()) if coords is None else pa.array(coords[:, i].astype(np.int32)) for i, a in enumerate("bxyz")}
        ends = None if feats is None else np.arange(0, feats.size + 1, feats.shape[1], dtype=np.int32) if feats.shape[1] else np.zeros(n + 1, np.int32)
        columns["feats"] = pa.nulls(n, floats) if feats is None else pa.ListArray.from_arrays(pa.array(ends), pa.array(feats.astype(np.float32).ravel()))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def latent_cells(given: DataFrame) -> DataFrame:
    """given (path, content: NPZ with slat_coords of three or four columns and slat_feats) -> path, obj_id, edit_id, role
    (of paths .../<edit_id>/before.npz or after.npz), error, b, x, y, z, feats: a row for each cell. A container that lacks
    them, or whose arrays don't fit, has one row with the error. Objects stored by pickling are never loaded."""
    return given.select("path", "content").mapInArrow(_decoded(False), CELLS)


def dense_latents(given: DataFrame) -> DataFrame:
    """The dense latent (ss) of each container that has one, flat, with its shape; errors as for latent_cells."""
    return given.select("path", "content").mapInArrow(_decoded(True), DENSE)
