"""Helpers that the operators of this package share: tables, row ids, shared folders, hashes."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir

#: internal columns carry this prefix, so user columns cannot clash with them
RID = "__tm_rid"
#: white space of the contracts: U+0020 and U+0009 to U+000D
WS_CLASS = r"[\x20\x09-\x0D]+"
#: bytes of an Arrow batch that a task sends to Python within :func:`small_batches`
ARROW_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_EMPTY = np.zeros(0, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    This is how the operators cut lineage: a lost executor costs a re-read, not a
    recomputation, and every later use sees the same rows.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_tm_path"] = path
    return out


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within send at most :data:`ARROW_BYTES` to Python at once: a batch of long rows, up to 64 MB
    by default, is held several times outside the heap."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(ARROW_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def discard(spark: SparkSession, *stored: DataFrame) -> None:
    """Delete tables that :func:`store` returned; nothing that still has to run may read them.

    Spark removes the shuffle files of finished jobs when the driver collects its garbage,
    which a driver with little to do puts off for long; so that is asked for here, too.
    """
    sc = spark.sparkContext
    for df in stored:
        path = df.__dict__.get("_tm_path")
        if path:
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    for _ in range(2):  # what the first round releases can hold on to more
        gc.collect()
        sc._jvm.System.gc()
        time.sleep(0.3)


def with_row_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: list[str] | None = None) -> tuple[DataFrame, bool]:
    """``docs`` with a unique, non-null long :data:`RID` that orders like ``id_col``.

    Returns (rows, own): ``own`` tells that ids are unique and present and RID equals
    them. Otherwise (null, repeated or non-integer ids) rows are numbered in the order
    of (id, text), nulls first, and the numbered table is stored, so that every later
    use sees the same numbers.
    """
    cols = [id_col, text_col] if keep is None else keep
    base = docs.select(*[F.col(f"`{c}`") for c in cols])
    if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        odd = (docs.groupBy(F.col(f"`{id_col}`").alias("k")).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("k").isNull() | (F.col("n") > 1)).limit(1).count())
        if not odd:
            return base.withColumn(RID, F.col(f"`{id_col}`").cast("long")), True
    order = [F.col(f"`{c}`").asc_nulls_first() for c in (id_col, text_col)]
    numbered = (base.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn(RID, F.monotonically_increasing_id()))
    return store(numbered, "row_ids"), False


def restore_ids(out: DataFrame, rows: DataFrame, own: bool, id_col: str = "doc_id") -> DataFrame:
    """Put ``id_col`` back in front of a result that carries :data:`RID`."""
    if own:
        kind = dict(rows.dtypes)[id_col]
        return out.select(F.col(RID).cast(kind).alias(id_col), *[c for c in out.columns if c != RID])
    return (out.join(rows.select(RID, id_col), RID)
            .select(id_col, *[c for c in out.columns if c != RID]))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit values (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: odd base of the window hashes, and its inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out[:n]


class WindowHash:
    """64-bit hashes of any window of a sequence of already mixed unit hashes."""

    def __init__(self, units: np.ndarray):
        n = len(units)
        self._inv = powers(BASE_INV, n + 1)
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(units * powers(BASE, n), out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sum[end] - self._sum[start]) * self._inv[start]
        return mix64(raw + (end - start).astype(np.uint64))


def text_chunks(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """(row ids, texts as UTF-8) of (RID, text) batches, in groups of about ``max_bytes``.

    A null text counts as empty. A single longer text makes a group of its own.
    """
    ids, texts, size = [], [], 0
    for batch in batches:
        rid = batch.column(0)
        txt = batch.column(1).cast(pa.large_binary())
        for i in range(batch.num_rows):
            t = txt[i].as_py() or b""
            if texts and size + len(t) > max_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(rid[i].as_py())
            texts.append(t)
            size += len(t)
    if ids:
        yield ids, texts


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals as sorted maximal runs (touching ones are joined)."""
    if len(start) == 0:
        return start, end
    o = np.argsort(start, kind="stable")
    s, e = start[o], np.maximum.accumulate(end[o])
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] > e[:-1]
    first = np.flatnonzero(new)
    return s[first], e[np.append(first[1:] - 1, len(s) - 1)]
