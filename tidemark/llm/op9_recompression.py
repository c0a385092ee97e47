"""Substring dedup by recompression: words that repeat an earlier passage are removed.

Rounds of run and pair naming (:mod:`tidemark.llm.recompression`) give equal word
sequences the same symbols in their interior. The names are 64-bit fingerprints of what
they stand for, so they are global without a naming table; each window of ``window``
words is represented by one symbol that it holds completely, and the shared symbols are
grouped, verified and opened on Spark (:mod:`tidemark.llm.repeats`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import RID, WindowHash, merge_spans, mix64, restore_ids, table, with_row_ids
from tidemark.llm.recompression import anchors
from tidemark.llm.repeats import apply_to_documents, repeated_windows

#: words whose hash is kept per task; the table is emptied when it is full
CACHE_WORDS = 1 << 17


class WordHashes(dict):
    """Word -> 64-bit hash, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return mix64(np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words)))


def make_sampler(window: int, rounds: int):
    cache = WordHashes()

    def sampler(texts: list[bytes]):
        per_text = [t.split() for t in texts]
        n = np.array([len(w) for w in per_text], dtype=np.int64)
        words = np.concatenate([word_hashes(w, cache) for w in per_text])
        which = np.repeat(np.arange(len(texts)), n)
        first = np.cumsum(n) - n
        p, lo, hi = anchors(words, which, window, rounds)
        # a short symbol is a weak key: take at least half a window, to the right where it fits
        half = window // 2
        short = hi - lo < half
        right = short & (lo + half <= p + window)
        k_lo = np.where(short & ~right, hi - half, lo)
        k_hi = np.where(right, lo + half, hi)
        new = np.ones(len(p), dtype=bool)
        new[1:] = (k_lo[1:] != k_lo[:-1]) | (k_hi[1:] != k_hi[:-1]) | (p[1:] != p[:-1] + 1)
        a = np.flatnonzero(new)
        b = np.append(a[1:] - 1, len(p) - 1) if len(a) else a
        wh = WindowHash(words)
        key = wh(k_lo[a], k_hi[a])
        run = wh(p[a], p[b] + window)
        # equal runs must also hold the anchor at the same place
        run = mix64(run + (k_lo[a] - p[a]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        d = which[p[a]]
        return d, p[a] - first[d], (p[b] - p[a] + 1).astype(np.int32), key, run
    return sampler


def make_window_hash(window: int):
    cache = WordHashes()

    def window_hash(text: bytes, starts: np.ndarray) -> np.ndarray:
        return WindowHash(word_hashes(text.split(), cache))(starts, starts + window)
    return window_hash


_SCHEMA = pa.schema([(RID, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def remove_repeats(docs: DataFrame, window: int = 20, rounds: int = 3, with_text: bool = True) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the words removed that repeat an earlier window.

    Words are maximal runs of other characters than U+0020 and U+0009 to U+000D. A word
    goes if a window of ``window`` words covers it whose words also start earlier
    (smaller doc_id, or same document and earlier start). Returns doc_id, n_words,
    n_removed, n_spans (removed runs), kept_sha256 (kept words joined by one space) and,
    with ``with_text``, that text as kept_text.

    Null and empty texts have no words and stay; an empty table gives an empty result.
    Rows with null or repeated ids count as documents of their own, ordered by (id,
    text) with nulls first. Other columns are ignored.
    """
    rows, own = with_row_ids(docs)
    spans = repeated_windows(rows, make_sampler(window, rounds), make_window_hash(window), earlier=True)

    def apply(rid, text, start, count):
        words = text.split()
        if len(start) == 0:
            kept, removed, n_spans = words, 0, 0
        else:
            s, e = merge_spans(start, start + count + window - 1)
            gone = np.zeros(len(words) + 1, dtype=np.int32)
            gone[s] += 1
            gone[e] -= 1
            stay = np.cumsum(gone[:-1]) == 0
            kept = [w for w, k in zip(words, stay.tolist(), strict=True) if k]
            removed, n_spans = len(words) - len(kept), len(s)
        joined = b" ".join(kept)
        return {RID: rid, "n_words": len(words), "n_removed": removed, "n_spans": n_spans,
                "kept_sha256": hashlib.sha256(joined).hexdigest(),
                "kept_text": joined.decode("utf-8", "replace") if with_text else None}

    ddl = f"{RID} long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    out = restore_ids(apply_to_documents(rows, spans, apply, _SCHEMA, ddl), rows, own)
    return out if with_text else out.drop("kept_text")


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: one row per document of ``documents``, windows of 20 words."""
    docs = table(spark, sf_dir, "documents")
    return (remove_repeats(docs, window=20, rounds=3, with_text=False)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))
