"""Media columns: audio held as WAV in a column, its spectrum and its fingerprint."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pairloom.llm.arrow import add_columns

RATE, UNIT = 8000, 64
#: Samples in a frame and between frames' starts; peaks that an anchor is paired with, and frames up to the last one.
FRAME, HOP, FAN_OUT, REACH = 256, 128, 3, 32


def encode(payload: bytes) -> bytes:
    """One channel of 8-bit samples at 8 kHz."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams((1, 1, RATE, 0, "NONE", ""))
        w.writeframes(payload)
    return out.getvalue()


def decode(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Frames' numbers and hashes of spectral-peak pairs, and the number of frames.

    Hann-windowed Fourier transforms of overlapping frames (the last one is filled up with silence); a peak is a frame's
    strongest bin, the zero frequency aside, if no neighbouring frame has a stronger one there. Each is paired with the
    next peaks within reach; a pair's hash holds both bins and the distance, its time is the first one's frame.
    """
    x = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    n = max(1, -(-(len(x) - FRAME) // HOP) + 1)
    x = np.pad(x, (0, max(0, (n - 1) * HOP + FRAME - len(x))))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP][:n]
    window = np.hanning(FRAME).astype(np.float32)
    bins, keep = np.zeros(n, np.int64), np.zeros(n, bool)
    for at in range(0, n, 1024):  # very long audio is transformed in parts, each with a frame more on either side
        first, end = max(0, at - 1), min(n, at + 1024)
        s = np.abs(np.fft.rfft(frames[first : end + 1] * window, axis=1))[:, 1:]
        strongest, power, i = s.argmax(1), s.max(1), np.arange(at, end) - first
        before = np.where(i > 0, s[i - 1, strongest[i]], 0)
        after = np.where(i + 1 < len(s), s[np.minimum(i + 1, len(s) - 1), strongest[i]], 0)
        keep[at:end] = (power[i] > before) & (power[i] >= after) & (power[i] > 0)
        bins[at:end] = strongest[i] + 1
    t = np.flatnonzero(keep)
    f = bins[t]
    times, hashes = [], []
    for k in range(1, FAN_OUT + 1):
        a, b = t[:-k], t[k:]
        near = b - a <= REACH
        times.append(a[near])
        hashes.append((f[:-k][near] << 14) | (f[k:][near] << 6) | (b - a)[near])
    times, hashes = np.concatenate(times), np.concatenate(hashes)
    order = np.lexsort((hashes, times))
    return times[order].astype(np.int32), hashes[order].astype(np.int32), n


def media_columns(docs: DataFrame) -> DataFrame:
    """docs (text) -> the same rows and columns, with
    n_bytes long (of the UTF-8 text), payload_bytes long (with zeros up to a positive multiple of 64), media binary (the
    WAV), payload_sha256 and tail_crc32 (of the samples as read back from the WAV; the checksum is of the last 64),
    n_frames int, times and hashes array<int> (the fingerprint, sorted by time).

    A null text is stored as an empty one: 64 zero bytes. Texts are stored whole, however long; equal texts give equal
    values. Columns of these names are replaced.
    """

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for t in batch.column("text").to_pylist():
            raw = (t or "").encode("utf-8", "replace")
            media = encode(raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT)))
            back = decode(media)
            times, hashes, n = fingerprint(back)
            rows.append((len(raw), len(back), media, hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), n, times, hashes))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]

    ints = T.ArrayType(T.IntegerType())
    fields = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("media", T.BinaryType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("n_frames", T.IntegerType()), ("times", ints), ("hashes", ints)]
    return add_columns(docs, fields, compute)
