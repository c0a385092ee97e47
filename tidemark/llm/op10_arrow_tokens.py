"""Token ids in Arrow files of equal-length sequences.

Every file is an Arrow IPC file whose record batches hold two fixed-size lists, ``ids``
and ``mask`` (one bit: token, or padding at a file's end), so sequence ``i`` is at a
computable offset of a memory-mapped file and is read without a copy. A second IPC file,
``.docs.arrow``, says where each document lies. Files cover ascending, disjoint ranges of
documents; a manifest table lists them with the ids before each.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import (
    BARE_PIECE, PieceEncoder, WordIds, is_word_tokenizer, library_ids, load_tokenizer, special_tokens)
from tidemark.llm.common import RID, restore_ids, store, table, text_chunks, with_row_ids
from tidemark.llm.op6_transducer_bpe import tokenizer_path
from tidemark.session import fresh_dir

SEQUENCE = 2048
#: sequences in a record batch
BATCH = 128


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])


class SequenceWriter:
    """Writes a stream of ids as fixed-size sequences; the files get their names when they are complete."""

    def __init__(self, folder: str, name: str, attempt: str, length: int, dtype: np.dtype):
        self._fs, root = _open(folder)
        self._fs.create_dir(root, recursive=True)
        self._final = f"{root}/{name}"
        self._temp = f"{root}/.{name}.{attempt}"
        kind = pa.from_numpy_dtype(dtype)
        self._schema = pa.schema([("ids", pa.list_(pa.field("item", kind, nullable=False), length)),
                                  ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))],
                                 metadata={"sequence_length": str(length)})
        self._kind, self._length, self._dtype = kind, length, dtype
        self._sink = self._fs.open_output_stream(self._temp + ".arrow")
        self._out = pa.ipc.new_file(self._sink, self._schema)
        self._held, self._n = [], 0
        self.total, self.sequences, self._docs = 0, 0, []

    def add(self, rid: int, ids: np.ndarray) -> None:
        self._docs.append((rid, self.total, len(ids)))
        self.total += len(ids)
        self._held.append(ids.astype(self._dtype))
        self._n += len(ids)
        if self._n >= BATCH * self._length:  # full batches only, so that a sequence's place is computable
            self._write(self._n // (BATCH * self._length) * BATCH)

    def _write(self, rows: int) -> None:
        flat = np.concatenate(self._held)
        cut = rows * self._length
        self._held, self._n = [flat[cut:]], max(0, len(flat) - cut)
        used = min(len(flat), cut)
        ids, mask = np.zeros(cut, dtype=self._dtype), np.zeros(cut, dtype=bool)
        ids[:used] = flat[:used]
        mask[:used] = True
        for at in range(0, rows, BATCH):
            s = slice(at * self._length, min(rows, at + BATCH) * self._length)
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x[s]), type=self._schema.field(k).type)
                    for k, x in enumerate((ids, mask))]
            self._out.write_batch(pa.record_batch(cols, schema=self._schema))
        self.sequences += rows

    def close(self) -> None:
        if self._n:
            self._write(-(-self._n // self._length))
        self._out.close()
        self._sink.close()
        docs = pa.table({RID: pa.array([d[0] for d in self._docs], pa.int64()),
                         "offset": pa.array([d[1] for d in self._docs], pa.int64()),
                         "n_tokens": pa.array([d[2] for d in self._docs], pa.int64())})
        with self._fs.open_output_stream(self._temp + ".docs.arrow") as sink, pa.ipc.new_file(sink, docs.schema) as out:
            out.write_table(docs)
        for end in (".arrow", ".docs.arrow"):  # a repeated attempt writes the same bytes
            self._fs.move(self._temp + end, self._final + end)


class SequenceFile:
    """Random access to the sequences, masks and documents of one file; local files are memory-mapped."""

    def __init__(self, folder: str, name: str):
        fs, root = _open(folder)

        def source(end: str):
            path = f"{root}/{name}{end}"
            return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self._file = pa.ipc.open_file(source(".arrow"))
        self._docs_file = pa.ipc.open_file(source(".docs.arrow"))
        self.length = self._file.schema.field("ids").type.list_size
        self.batches = self._file.num_record_batches

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of a record batch as flat arrays: ids over the file's own memory, the mask's bits unpacked."""
        b = self._file.get_batch(k)
        return b.column(0).flatten().to_numpy(zero_copy_only=True), b.column(1).flatten().to_numpy(zero_copy_only=False)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        k, r = divmod(i, BATCH)
        ids, mask = self.batch(k)
        s = slice(r * self.length, (r + 1) * self.length)
        return ids[s], mask[s]

    def documents(self) -> pa.Table:
        return self._docs_file.read_all()


_MANIFEST = pa.schema([("name", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()),
                       ("n_tokens", pa.int64()), ("n_sequences", pa.int64())])


def _write_task(spec: str, folder: str, end_id: int, length: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(spec)
        ids_of = WordIds(tok) if is_word_tokenizer(json.loads(spec)) else library_ids(tok)
        encoder = PieceEncoder(BARE_PIECE, special_tokens(tok), ids_of)
        top = max(end_id, max(tok.get_vocab(with_added_tokens=True).values()))
        dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        at = TaskContext.get()
        name, out, first, n = f"part-{at.partitionId():06d}", None, None, 0
        for ids, texts in text_chunks(batches, 1 << 20):
            flat, size = encoder.encode([t.decode() for t in texts])
            stop = np.append(0, np.cumsum(size))
            if out is None:
                out, first = SequenceWriter(folder, name, str(at.taskAttemptId()), length, dtype), ids[0]
            for k, rid in enumerate(ids):
                out.add(rid, np.append(flat[stop[k]:stop[k + 1]], np.uint32(end_id)))
            n += len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"name": name, "first_id": first, "n_docs": n, "n_tokens": out.total,
                                               "n_sequences": out.sequences}], schema=_MANIFEST)
    return task


def write_tokens(rows: DataFrame, folder: str, spec: str, end_id: int, length: int = SEQUENCE) -> DataFrame:
    """Write (RID, text) rows in ascending id order under ``folder``; returns the manifest (name, ..., base)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = store(rows.select(RID, "text").repartitionByRange(parts, RID).sortWithinPartitions(RID)
                    .mapInArrow(_write_task(spec, folder, end_id, length),
                                "name string, first_id long, n_docs long, n_tokens long, n_sequences long"), "token_files")
    files = sorted(written.collect(), key=lambda r: r["first_id"])  # one row a file
    base, out = 0, []
    for r in files:
        out.append((*r, base))
        base += r["n_tokens"]
    return spark.createDataFrame(out, "name string, first_id long, n_docs long, n_tokens long, n_sequences long, base long")


_READ = pa.schema([(RID, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read_task(folder: str):
    def documents(name: str, base: int) -> Iterator[pa.RecordBatch]:
        f = SequenceFile(folder, name)
        docs = f.documents()
        rid, offset, n = (docs.column(c).to_numpy() for c in (RID, "offset", "n_tokens"))
        crc = np.zeros(len(rid), dtype=np.int64)
        at, k = 0, 0
        for b in range(f.batches):
            ids = f.batch(b)[0].astype("<u4")
            while k < len(rid):
                s, e = max(offset[k], at) - at, min(offset[k] + n[k], at + len(ids)) - at
                if s >= len(ids):
                    break
                crc[k] = zlib.crc32(ids[s:e], int(crc[k]))
                if offset[k] + n[k] > at + len(ids):
                    break  # goes on in the next batch
                k += 1
            at += len(ids)
        yield pa.RecordBatch.from_pydict({RID: rid, "start": offset + base, "n_tokens": n, "ids_crc32": crc}, schema=_READ)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield from documents(r["name"], r["base"])
    return task


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """(RID, start, n_tokens, ids_crc32) of every document, from the files."""
    parts = max(1, manifest.count())
    return (manifest.select("name", "base").repartition(parts, "name")
            .mapInArrow(_read_task(folder), f"{RID} long, start long, n_tokens long, ids_crc32 long"))


def tokens_to_files(docs: DataFrame, tokenizer: str, end_id: int, length: int = SEQUENCE) -> tuple[str, DataFrame, DataFrame]:
    """Encode ``docs`` (doc_id, text), write the files, read them back: (folder, manifest, documents).

    ``tokenizer`` is the path of a white-space-dropping BPE file of the tokenizers
    library. Each document gets ``end_id`` appended; ``start`` counts the ids of all
    documents before it in ascending doc_id order.

    Null text counts as empty and is its end id alone; an empty table writes no file and
    gives an empty result. Rows with null or repeated ids are documents of their own,
    in the order of (id, text) with nulls first. Other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows, own = with_row_ids(docs)
    folder = fresh_dir(docs.sparkSession, "llm", "tokens")
    manifest = write_tokens(rows, folder, spec, end_id, length)
    return folder, manifest, restore_ids(read_documents(manifest, folder), rows, own)


def op10_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document with the 49k word vocabulary and end id 1, read back from the files."""
    return tokens_to_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)[2]
