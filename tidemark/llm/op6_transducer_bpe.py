"""BPE encoding and decoding with a transducer lexicon of the corpus's frequent words.

The words (pieces that no token crosses) of all texts are counted on Spark; the most
frequent are encoded once and compiled into a minimal acyclic automaton with their ids as
outputs, which tasks map into memory. A piece that the automaton lacks is merged by the
tokenizer's own model. Either way the ids are those of the tokenizers library.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import (
    SPACED_PIECE, PieceEncoder, byte_of_char, library_ids, load_tokenizer, ranges, special_tokens)
from tidemark.llm.common import RID, restore_ids, store, table, text_chunks, with_row_ids
from tidemark.llm.transducer import Transducer, build

#: words in the lexicon; it bounds what the driver gathers and what tasks map
LEXICON_WORDS = 40_000
#: distinct words a task counts before it sends them on
COUNTED_WORDS = 200_000


def _count_task():
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        find = re.compile(SPACED_PIECE).findall
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"piece": pa.array([p.encode() for p in held], pa.binary()),
                                               "n": pa.array(list(held.values()), pa.int64())})
        for _, texts in text_chunks(batches, 1 << 20):
            for t in texts:
                held.update(find(t.decode()))
            if len(held) > COUNTED_WORDS:
                yield rows()
                held.clear()
        if held:
            yield rows()
    return task


def lexicon(docs: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent pieces of all texts of ``docs`` (id, text): at most ``words`` of them.

    Pieces are taken by whole classes of frequency (16 to a doubling), from the highest
    down, as long as they fit, so the driver receives the class sizes and the chosen
    pieces only, however many tasks counted.
    """
    counts = docs.mapInArrow(_count_task(), "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 16).cast("int")
    frequent = store(counts.filter("n > 1").select("piece", level.alias("level")), "piece_levels")
    sizes = sorted(((r["level"], r["count"]) for r in frequent.groupBy("level").count().collect()), reverse=True)
    total, lowest = 0, None
    for at, size in sizes:  # at most 16 * 63 classes
        if total + size > words:
            break
        total, lowest = total + size, at
    if lowest is None:
        return []
    return sorted(bytes(r["piece"]) for r in frequent.filter(F.col("level") >= lowest).select("piece").collect())


def compile_lexicon(spark: SparkSession, spec: str, pieces: list[bytes]) -> str:
    """Build the automaton and hand it to the executors; returns the file's name for SparkFiles."""
    tok = load_tokenizer(spec)
    special = special_tokens(tok)
    plain = [p for p in pieces if not any(s.encode() in p for s in special)]
    ids = library_ids(tok)([p.decode() for p in plain])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as f:
        f.write(build(dict(zip(plain, ids, strict=True))))
    spark.sparkContext.addFile(path)  # the driver serves it to every executor, later ones too
    return name


def token_bytes(tok) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all tokens' bytes, first byte of each id, length of each id)"""
    chars = byte_of_char()
    by_id: dict[int, bytes] = {i: bytes(chars[c] for c in t) for t, i in tok.get_vocab(with_added_tokens=False).items()}
    by_id |= {i: t.encode() for t, i in special_tokens(tok).items()}
    parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    size = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(size) - size, size


_SCHEMA = pa.schema([(RID, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _encode_task(spec: str, lexicon_file: str, with_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(spec)
        merge = library_ids(tok)
        words = Transducer(SparkFiles.get(lexicon_file))

        def unseen(pieces: list[str]) -> list[list[int]]:
            number = words.numbers([p.encode() for p in pieces]).tolist()
            rest = iter(merge([p for p, n in zip(pieces, number, strict=True) if n < 0]))
            return [next(rest) if n < 0 else words.ids(n) for n in number]

        encoder = PieceEncoder(SPACED_PIECE, special_tokens(tok), unseen)
        data, first, size = token_bytes(tok)
        for ids, texts in text_chunks(batches, 1 << 20):
            flat, n = encoder.encode([t.decode() for t in texts])
            stop = np.append(0, np.cumsum(n))
            width = size[flat]
            body = data[ranges(first[flat], width)].tobytes()
            cut = np.append(0, np.cumsum(width))[stop]
            rows = []
            for k, rid in enumerate(ids):
                own = flat[stop[k]:stop[k + 1]]
                back = body[cut[k]:cut[k + 1]].decode("utf-8", "replace")
                rows.append({RID: rid, "n_tokens": len(own), "ids_sha256": hashlib.sha256(own.astype("<u4")).hexdigest(),
                             "decoded_sha256": hashlib.sha256(back.encode()).hexdigest(),
                             "ids": own.astype(np.int32) if with_ids else None, "decoded": back if with_ids else None})
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
    return task


def encode_decode(docs: DataFrame, tokenizer: str, lexicon_words: int = LEXICON_WORDS, with_ids: bool = True) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text) and decode it again.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, read by
    the driver. Returns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned
    32-bit), decoded_sha256 (of the decoded text in UTF-8) and, with ``with_ids``, ids and
    decoded. Special tokens written out in a text become their ids, as in the library.

    Null text counts as empty; an empty table gives an empty result. Rows with null or
    repeated ids are rows of their own. Other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows, own = with_row_ids(docs)
    body = rows.select(RID, "text")
    name = compile_lexicon(docs.sparkSession, spec, lexicon(body, lexicon_words))
    out = body.mapInArrow(_encode_task(spec, name, with_ids), f"{RID} long, n_tokens long, ids_sha256 string, "
                          "decoded_sha256 string, ids array<int>, decoded string")
    out = restore_ids(out, rows, own)
    return out if with_ids else out.drop("ids", "decoded")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op6_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document with the byte-level 50k vocabulary."""
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)
