"""Substring dedup by depth-limited radix ordering of suffixes.

Suffixes are ordered only as far as the threshold of ``window`` bytes, most significant
part first: the first pass deals sampled suffixes by their first ``window - SPREAD + 1``
bytes, the second by all bytes their windows cover, the third opens what is still
undecided into every suffix and orders those by the whole threshold. A suffix that is
alone after a pass leaves. Equal groups after the last pass are exactly the repeated
windows. The sample takes, of every ``SPREAD`` neighbouring suffixes, the one whose first
bytes hash lowest, so equal windows sample equal suffixes at equal offsets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import RID, WindowHash, merge_spans, mix64, restore_ids, table, with_row_ids
from tidemark.llm.repeats import apply_to_documents, repeated_windows

#: bytes in the unit that hashes are made of
GRAM = 8


def grams(data: bytes) -> np.ndarray:
    """The mixed 8-byte value at every offset of ``data`` (which ends in 8 spare bytes)."""
    n = len(data) - GRAM
    return mix64(np.ndarray(shape=(n,), dtype="<u8", buffer=data, strides=(1,)).astype(np.uint64))


def _lowest(value: np.ndarray, width: int) -> np.ndarray:
    """The position of the lowest value (leftmost of equals) in each window of ``width``, a power of two."""
    v = (value >> np.uint64(32) << np.uint64(32)) | np.arange(len(value), dtype=np.uint64)
    step = 1
    while step < width:
        v = np.minimum(v[:len(v) - step], v[step:])
        step *= 2
    return (v & np.uint64(0xFFFFFFFF)).astype(np.int64)


def spread_of(window: int) -> int:
    """The largest power of two that is at most a third of the window (1 at least)."""
    return 1 << max(0, (window // 3).bit_length() - 1)


def make_sampler(window: int):
    width = spread_of(window)
    depth = window - width + 1

    def sampler(texts: list[bytes]):
        size = np.array([len(t) for t in texts], dtype=np.int64)
        data = b"".join(texts) + bytes(GRAM)
        first = np.cumsum(size) - size
        z = np.zeros(0, dtype=np.int64)
        if len(data) - GRAM < window:
            return z, z, z.astype(np.int32), z.astype(np.uint64), z.astype(np.uint64)
        g = grams(data)
        wh = WindowHash(g)
        # a suffix is judged by bytes of its own only, so the order of documents in a task cannot matter
        low = _lowest(g, width)
        p = np.flatnonzero(_inside(size, first, window, len(g)))
        s = low[p]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)
        a = np.flatnonzero(new)
        b = np.append(a[1:] - 1, len(p) - 1) if len(a) else a
        start, last, s = p[a], p[b], s[a]
        key = wh(s, s + depth - GRAM + 1)
        run = wh(start, last + window - GRAM + 1)
        run = mix64(run + (s - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        d = np.searchsorted(first, start, side="right") - 1
        return d, start - first[d], (last - start + 1).astype(np.int32), key, run
    return sampler


def _inside(size: np.ndarray, first: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which offsets start a window that ends in the same document."""
    edge = np.zeros(n + 1, dtype=np.int32)
    long = size >= window
    np.add.at(edge, first[long], 1)
    np.add.at(edge, (first + size - window + 1)[long], -1)
    return np.cumsum(edge[:-1]) > 0


def make_window_hash(window: int):
    def window_hash(text: bytes, starts: np.ndarray) -> np.ndarray:
        return WindowHash(grams(text + bytes(GRAM)))(starts, starts + window - GRAM + 1)
    return window_hash


_SCHEMA = pa.schema([(RID, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept_bytes", pa.binary())])


def remove_shared(docs: DataFrame, window: int = 200, with_bytes: bool = True) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with all bytes removed that a repeated window covers.

    A byte of the UTF-8 text goes if a ``window``-byte string covers it that also starts
    anywhere else, in this document or another (the first occurrence goes too).
    ``window`` is at least 16. Returns doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 and, with ``with_bytes``, what is left as kept_bytes
    (binary: a cut can fall inside a character).

    Null text counts as empty; an empty table gives an empty result. Rows with null or
    repeated ids count as documents of their own. Other columns are ignored.
    """
    if window < 2 * GRAM:
        raise ValueError(f"window must be at least {2 * GRAM} bytes")
    rows, own = with_row_ids(docs)
    spans = repeated_windows(rows, make_sampler(window), make_window_hash(window), earlier=False,
                             chunk_bytes=1 << 20)

    def apply(rid, text, start, count):
        if len(start) == 0:
            kept, n_spans = text, 0
        else:
            s, e = merge_spans(start, start + count + window - 1)
            n_spans = len(s)
            ends = np.append(0, e).tolist()
            kept = b"".join(text[x:y] for x, y in zip(ends, np.append(s, len(text)).tolist(), strict=True))
        return {RID: rid, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": n_spans,
                "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept_bytes": kept if with_bytes else None}

    ddl = f"{RID} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    out = restore_ids(apply_to_documents(rows, spans, apply, _SCHEMA, ddl), rows, own)
    return out if with_bytes else out.drop("kept_bytes")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: one row per document of ``documents``, windows of 200 bytes."""
    return remove_shared(table(spark, sf_dir, "documents"), window=200, with_bytes=False)
