"""Windows that occur more than once, found in passes that drop what is already decided.

A *sampler* reduces each text to records (key, run): neighbouring windows that share an
anchor form one run, ``key`` is a hash of the anchor's content and ``run`` one of
everything its windows cover. Equal windows always have equal keys. Then

1. records are dealt by key; equal (key, run) settle all windows of the run at once, and
   only where one key has different runs do the runs' first copies go on;
2. those runs are opened into single windows, dealt by window hash and compared.

Records travel as packed arrays, a few thousand to a row. Before each exchange equal
records of a task are combined, and of a key with many runs only two are sent as evidence
(the others go on directly), so one passage in a third of all documents costs its
receiver a few records per sending task, not one per document.

``earlier=True`` reports windows that also start earlier (smaller row id, or same row and
smaller start); ``earlier=False`` reports windows that also start anywhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import RID, discard, merge_spans, mix64, small_batches, store, text_chunks

RECORD, SPAN, WINDOW = 0, 1, 2
#: in the ``many`` column of span rows: these windows are settled, or still to be opened
SETTLED, TO_OPEN = 0, 1
_ROW = pa.schema([("dest", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("key", pa.binary()),
                  ("run", pa.binary()), ("doc", pa.binary()), ("start", pa.binary()), ("count", pa.binary()),
                  ("many", pa.binary())])
ROW_DDL = "dest int, kind int, n int, key binary, run binary, doc binary, start binary, count binary, many binary"
_TYPES = {"key": "<u8", "run": "<u8", "doc": "<i8", "start": "<i8", "count": "<i4", "many": "u1"}
FLUSH = 200_000


def _pack(kind: int, dest: np.ndarray, **cols: np.ndarray) -> list[dict]:
    """Rows of packed arrays, one for each destination; within it in the given order."""
    if len(dest) == 0:
        return []
    o = np.argsort(dest, kind="stable")
    d = dest[o]
    cut = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    ends = np.append(cut[1:], len(d))
    cols = {k: v[o].astype(_TYPES[k]) for k, v in cols.items()}
    return [{"dest": int(d[s]), "kind": kind, "n": int(e - s)} | {k: v[s:e].tobytes() for k, v in cols.items()}
            for s, e in zip(cut, ends, strict=True)]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ROW)


def _column(parts: list[bytes], name: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=_TYPES[name])


def _of_key(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(key) >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _of_doc(doc: np.ndarray, buckets: int) -> np.ndarray:
    """The partition of documents: ``pmod(xxhash64(id), buckets)`` as in :func:`_meet`, so ids in steps spread."""
    return np.mod(xxhash64(doc).view(np.int64), buckets)


def xxhash64(x: np.ndarray) -> np.ndarray:
    """The published 64-bit XXH64 of 8-byte integers with seed 42, which is what Spark's function of that name gives."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(v: np.ndarray, bits: int) -> np.ndarray:
        return v << np.uint64(bits) | v >> np.uint64(64 - bits)
    h = turned(x.astype(np.int64).view(np.uint64) * p2, 31) * p1 ^ (np.uint64(42 + 8) + p5)
    h = turned(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def _spans(doc, start, count, buckets: int, settled=None, opened=None) -> list[dict]:
    """Spans for their documents; with masks or positions, the settled ones and those to open in common rows."""
    if settled is None:
        return _pack(SPAN, _of_doc(doc, buckets), doc=doc, start=start, count=count,
                     many=np.full(len(doc), SETTLED, dtype=np.uint8))
    at = np.concatenate([np.flatnonzero(settled), opened])
    state = np.repeat(np.array([SETTLED, TO_OPEN], dtype=np.uint8), [len(at) - len(opened), len(opened)])
    return _pack(SPAN, _of_doc(doc[at], buckets), doc=doc[at], start=start[at], count=count[at], many=state)


def _classes(key, run, doc, start):
    """Order by (key, run, doc, start); where a class (key, run) and a key begin."""
    o = np.lexsort((start, doc, run, key))
    k, r = key[o], run[o]
    new_key = np.append(True, k[1:] != k[:-1])
    new_class = new_key | np.append(True, r[1:] != r[:-1])
    return o, new_key, new_class


def _sizes(new: np.ndarray) -> np.ndarray:
    first = np.flatnonzero(new)
    return np.diff(np.append(first, len(new)))


def _send_records(parts: list[tuple], earlier: bool, buckets: int) -> list[dict]:
    """Combine one task's records: rows of settled spans, runs to open, and records for their keys."""
    key, run, doc, start, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(key) == 0:
        return []
    o, new_key, new_class = _classes(key, run, doc, start)
    key, run, doc, start, count = key[o], run[o], doc[o], start[o], count[o]
    class_no = np.cumsum(new_class) - 1
    size = _sizes(new_class)[class_no]
    settled = ~new_class if earlier else size > 1
    first = np.flatnonzero(new_class)
    # the how-manieth class of its key each first record is
    key_first = np.flatnonzero(new_key[first])
    rank = np.arange(len(first)) - np.repeat(key_first, _sizes(new_key[first]))
    rows = _spans(doc, start, count, buckets, settled, first[rank >= 2])
    s = first[rank < 2]
    return rows + _pack(RECORD, _of_key(key[s], buckets), key=key[s], run=run[s], doc=doc[s], start=start[s],
                        count=count[s], many=(size[s] > 1).astype(np.uint8))


def _sample_task(sampler: Callable, earlier: bool, buckets: int, chunk_bytes: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for ids, texts in text_chunks(batches, chunk_bytes):
            which, start, count, key, run = sampler(texts)
            parts.append((key, run, np.asarray(ids, dtype=np.int64)[which], start, count))
            held += len(key)
            if held >= FLUSH:
                yield _batch(_send_records(parts, earlier, buckets))
                parts, held = [], 0
        if parts:
            yield _batch(_send_records(parts, earlier, buckets))
    return task


def _by_dest(batches: Iterator[pa.RecordBatch], kinds: tuple[int, ...]):
    """(dest, {column: packed parts}) of the given kinds; rows of other kinds as (None, record batch)."""
    dest, parts = None, {}
    for b in batches:
        kind = b.column(1).to_numpy()
        other = ~np.isin(kind, kinds)
        if other.any():
            yield None, b.filter(pa.array(other))
        for i in np.flatnonzero(~other):
            d = b.column(0)[i].as_py()
            if d != dest:
                if parts:
                    yield dest, parts
                dest, parts = d, {}
            for c in _TYPES:
                v = b.column(_ROW.get_field_index(c))[i].as_py()
                if v is not None:
                    parts.setdefault(c, []).append(v)
    if parts:
        yield dest, parts


def _settle_task(earlier: bool, buckets: int):
    """Receives records by key: settles equal runs, passes on the first copy of differing runs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dest, got in _by_dest(batches, (RECORD,)):
            if dest is None:
                yield got
                continue
            key, run, doc, start, count = (_column(got[c], c) for c in ("key", "run", "doc", "start", "count"))
            o, new_key, new_class = _classes(key, run, doc, start)
            doc, start, count = doc[o], start[o], count[o]
            class_no, key_no = np.cumsum(new_class) - 1, np.cumsum(new_key) - 1
            size = _sizes(new_class)[class_no]
            # a sender has settled its own copies; a first copy that meets others is settled here
            settled = ~new_class if earlier else size > 1
            first = np.flatnonzero(new_class)
            classes = np.bincount(key_no[first])
            opened = first[classes[key_no[first]] > 1]
            yield _batch(_spans(doc, start, count, buckets, settled, opened))
    return task


def _send_windows(parts: list[tuple], earlier: bool, buckets: int) -> list[dict]:
    key, doc, start = (np.concatenate(x) for x in zip(*parts, strict=True))
    o = np.lexsort((start, doc, key))
    key, doc, start = key[o], doc[o], start[o]
    same = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
    keep = np.append(True, ~same)
    key, doc, start = key[keep], doc[keep], start[keep]
    new = np.append(True, key[1:] != key[:-1])
    many = np.repeat(_sizes(new) > 1, _sizes(new))
    settled = ~new if earlier else many
    one = np.ones(len(key), dtype=np.int32)
    rows = _runs(doc[settled], start[settled], buckets)
    return rows + _pack(WINDOW, _of_key(key[new], buckets), key=key[new], doc=doc[new], start=start[new],
                        count=one[new], many=many[new].astype(np.uint8))


def _runs(doc, start, buckets: int) -> list[dict]:
    """Spans of single windows, neighbours joined."""
    if len(doc) == 0:
        return []
    o = np.lexsort((start, doc))
    d, s = doc[o], start[o]
    new = np.append(True, (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(s) - 1)
    return _spans(d[first], s[first], s[last] - s[first] + 1, buckets)


def _open_task(window_hash: Callable, earlier: bool, buckets: int):
    """Documents meet their runs to open; the runs' windows are sent by window hash."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for rid, text, start, count in _documents_with(batches, TO_OPEN):
            if len(start) == 0:
                continue
            s, e = merge_spans(start, start + count)
            at = np.concatenate([np.arange(a, b) for a, b in zip(s, e, strict=True)])
            key = window_hash(text, at)
            parts.append((key, np.full(len(at), rid, dtype=np.int64), at))
            held += len(at)
            if held >= FLUSH:
                yield _batch(_send_windows(parts, earlier, buckets))
                parts, held = [], 0
        if parts:
            yield _batch(_send_windows(parts, earlier, buckets))
    return task


def _compare_task(earlier: bool, buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dest, got in _by_dest(batches, (WINDOW,)):
            if dest is None:
                yield got
                continue
            key, doc, start, many = (_column(got[c], c) for c in ("key", "doc", "start", "many"))
            o = np.lexsort((start, doc, key))
            key, doc, start, many = key[o], doc[o], start[o], many[o]
            new = np.append(True, key[1:] != key[:-1])
            size = np.repeat(_sizes(new), _sizes(new))
            hit = ~new if earlier else (size > 1) | (many > 0)
            yield _batch(_runs(doc[hit], start[hit], buckets))
    return task


_DOC_COLS = ["dest", "kind", "n", RID, "text", "doc", "start", "count", "many"]


def _documents_with(batches: Iterator[pa.RecordBatch], state: int):
    """(row id, text, starts, counts) from rows of one dest sorted by kind: packed spans, then documents.

    Only spans in the given state are returned.
    """
    dest, parts, ready = None, {}, None
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)) for c in _DOC_COLS]
        for i in range(b.num_rows):
            d, kind = cols[0][i].as_py(), cols[1][i].as_py()
            if d != dest:
                dest, parts, ready = d, {}, None
            if kind != DOC:
                for c, col in zip(("doc", "start", "count", "many"), cols[5:], strict=True):
                    parts.setdefault(c, []).append(col[i].as_py())
                continue
            if ready is None:
                if parts:
                    doc, start, count, many = (_column(parts[c], c) for c in ("doc", "start", "count", "many"))
                    o = np.flatnonzero(many == state)
                    o = o[np.argsort(doc[o], kind="stable")]
                    ready = doc[o], start[o], count[o].astype(np.int64)
                    parts = {}
                else:
                    z = np.zeros(0, dtype=np.int64)
                    ready = z, z, z
            rid = cols[3][i].as_py()
            s, e = np.searchsorted(ready[0], [rid, rid + 1])
            yield rid, cols[4][i].as_py() or b"", ready[1][s:e], ready[2][s:e]


DOC = 9


def _meet(docs: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """Documents and the packed rows about them in one partition, the rows first."""
    left = rows.select("dest", "kind", "n", F.lit(None).cast("long").alias(RID), F.lit(None).cast("binary").alias("text"),
                       "doc", "start", "count", "many")
    none = F.lit(None).cast("binary")
    right = docs.select(F.pmod(F.xxhash64(RID), F.lit(parts)).cast("int").alias("dest"), F.lit(DOC).alias("kind"),
                        F.lit(1).alias("n"), RID, F.col("text").cast("binary").alias("text"),
                        none.alias("doc"), none.alias("start"), none.alias("count"), none.alias("many"))
    return left.unionByName(right).repartitionById(parts, F.col("dest")).sortWithinPartitions("kind")


def repeated_windows(docs: DataFrame, sampler: Callable, window_hash: Callable, earlier: bool,
                     chunk_bytes: int = 1 << 20) -> DataFrame:
    """Packed spans of window starts (see :data:`ROW_DDL`) for ``docs`` (RID, text).

    ``sampler(texts)`` gives arrays (text number, first window start, windows in the run,
    key, run); ``window_hash(text, starts)`` one hash per window.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select(RID, "text").mapInArrow(_sample_task(sampler, earlier, parts, chunk_bytes), ROW_DDL)
    # dest is the number of the partition that receives a row, so each has one dest and there is nothing to sort
    settled = sent.repartitionById(parts, F.col("dest")).mapInArrow(_settle_task(earlier, parts), ROW_DDL)
    with small_batches(spark):
        settled = store(settled, "repeat_runs")
    discard(spark)  # the records' shuffle files; else all exchanges are on disk together at the end
    windows = (_meet(docs, settled, parts).mapInArrow(_open_task(window_hash, earlier, parts), ROW_DDL)
               .repartitionById(parts, F.col("dest")).mapInArrow(_compare_task(earlier, parts), ROW_DDL))
    with small_batches(spark):
        windows = store(windows, "repeat_windows")
    discard(spark)
    return settled.unionByName(windows)


def apply_to_documents(docs: DataFrame, spans: DataFrame, fn: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """``fn(row id, text, starts, counts) -> dict`` over every document with its spans of window starts."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for rid, text, start, count in _documents_with(batches, SETTLED):
            rows.append(fn(rid, text, start, count))
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _meet(docs, spans, parts).mapInArrow(task, ddl)
