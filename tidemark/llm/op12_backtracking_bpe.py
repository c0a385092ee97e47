"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The bytes of a piece are read as Latin-1 characters, so an Aho-Corasick automaton over the
vocabulary finds every token at every offset. From the left the longest token is taken
that is compatible with the token before it, that is, the merges of both tokens' bytes
give back just these two; where none is, the last token is given up for its next shorter
one. Token sequences whose neighbours are all compatible are exactly those that the merges
yield, and each prefix of a piece has one, so an offset that failed once is never tried
again and the work is linear in the piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import SPACED_PIECE
from tidemark.llm.common import RID, restore_ids, table, text_chunks, with_row_ids

#: entries a task keeps of each memo; a full one is emptied
KEPT = 400_000
#: bytes of the longest piece whose ids are kept
KEPT_BYTES = 64
#: what the public pattern does with ASCII and Latin-1 letters, digits and marks after at most one space
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN = f" ?[!-~{_LETTERS}]+"
PLAIN_SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ 0-9{_LETTERS}]+"
#: the public pattern on texts of these letters, digits, marks and ASCII white space alone
PLAIN_TEXT = f"[\\t-\\r -~{_LETTERS}]*"
PLAIN_MATCHES = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\t-\\r 0-9{_LETTERS}]+"
                 "|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+")
#: any other text is split once where the pattern never matches across: before white space that a word follows
_COARSE = re.compile(SPACED_PIECE)


#: fixed value: the public pattern, whose matches lie inside the coarse pieces
PUBLIC = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _is_public(pattern: str) -> bool:
    return pattern == PUBLIC


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Backtracker:
    """Encodes pieces by the ranks; merges only ever run on the bytes of two neighbouring tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self._rank = ranks
        self.token = {i: t for t, i in ranks.items()}
        self._own: dict[int, bool] = {}
        self._next: dict[int, dict[int, bool]] = {}  # by token: which tokens may follow it
        self._held = 0
        self._byte = {token[0]: (i, 1) for token, i in ranks.items() if len(token) == 1}
        self._find = ahocorasick.Automaton()
        for token, i in ranks.items():
            if len(token) > 1:
                self._find.add_word(token.decode("latin-1"), (i, len(token)))
        self._find.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """The merges as they are defined: always the lowest-ranked neighbours, the leftmost of equals."""
        rank, none = self._rank.get, float("inf")
        parts = [data[k:k + 1] for k in range(len(data))]
        joined = [rank(data[k:k + 2], none) for k in range(len(data) - 1)]  # of each part and the next
        while joined:
            best = min(joined)
            if best == none:
                break
            k = joined.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del joined[k]
            if k:
                joined[k - 1] = rank(parts[k - 1] + parts[k], none)
            if k < len(joined):
                joined[k] = rank(parts[k] + parts[k + 1], none)
        return [self._rank[p] for p in parts]

    def _first(self, i: int) -> bool:
        """Whether a token can begin a piece: the merges of its own bytes give it."""
        known = self._own[i] = self.merged(self.token[i]) == [i]
        return known

    def _follows(self, a: int, b: int) -> bool:
        """Whether the merges of both tokens' bytes give these two; then each is what its own bytes give, too.

        They are :meth:`merged`'s merges, up to the first one across the tokens' border.
        """
        self._held += 1
        rank, none, data, left = self._rank.get, float("inf"), self.token[a] + self.token[b], len(self.token[a]) - 1
        parts = [data[k:k + 1] for k in range(len(data))]
        joined = [rank(data[k:k + 2], none) for k in range(len(data) - 1)]
        while (best := min(joined)) != none:
            k = joined.index(best)
            if k == left:
                break
            left -= k < left
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del joined[k]
            if k:
                joined[k - 1] = rank(parts[k - 1] + parts[k], none)
            if k < len(joined):
                joined[k] = rank(parts[k] + parts[k + 1], none)
        known = self._next.setdefault(a, {})[b] = best == none and len(parts) == 2
        return known

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece; a piece that is a token is that token, whatever its merges."""
        whole = self._rank.get(piece)
        if whole is not None:
            return [whole]
        if self._held > KEPT:
            self._next, self._held = {}, 0
        n, byte = len(piece), self._byte
        # tokens at each offset, shortest first, as the automaton reports them by their ends
        try:
            at = [[byte[b]] for b in piece]
        except KeyError as e:
            raise ValueError(f"the ranks lack the byte {e}") from None
        if n > 1:
            for end, found in self._find.iter(piece.decode("latin-1")):
                at[end + 1 - found[1]].append(found)
        at.append([])
        ids: list[int] = []
        tried: list[int] = []  # for each id taken, how many shorter tokens its offset still has
        failed = bytearray(n + 1)
        pos, here, known = 0, at[0], self._own
        left = len(here)
        while pos < n:
            while left:
                left -= 1
                i, size = here[left]
                if failed[pos + size]:
                    continue
                good = known.get(i)
                if good is None:
                    good = self._follows(ids[-1], i) if ids else self._first(i)
                    known = self._next.get(ids[-1], {}) if ids else self._own
                if good:
                    ids.append(i)
                    tried.append(left)
                    pos += size
                    here, known = at[pos], self._next.get(i, {})
                    left = len(here)
                    break
            else:
                # a single byte may always stand alone, so the first offset never fails
                failed[pos] = 1
                left = tried.pop()
                pos -= len(self.token[ids.pop()])
                here, known = at[pos], self._next.get(ids[-1], {}) if ids else self._own
        return ids


class MatchTable(dict):
    """Match of the pattern -> its ids in decimal, joined by spaces, made when the match is first met."""

    def __init__(self, coder: Backtracker):
        self._encode = coder.encode
        self._decimal = {i: b"%d" % i for i in coder.token}

    def __missing__(self, match: str) -> bytes:
        out = b" ".join([self._decimal[i] for i in self._encode(match.encode())])
        if len(match) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[match] = out
        return out


class PieceTable(dict):
    """Coarse piece -> the ids of its matches in decimal; the same words stand beside many marks, so matches are kept too."""

    def __init__(self, pattern: str, coder: Backtracker):
        self._split, self.matches = regex.compile(pattern).findall, MatchTable(coder)
        self._plain, self._split_plain = (re.compile(PLAIN).fullmatch, re.compile(PLAIN_SPLIT).findall) if _is_public(
            pattern) else (None, None)

    def __missing__(self, piece: str) -> bytes:
        split = self._split_plain if self._plain and self._plain(piece) else self._split
        out = b" ".join([self.matches[m] for m in split(piece)])
        if len(piece) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = out
        return out


def splitter(pattern: str, pieces: PieceTable) -> Callable[[str], Iterator[bytes]]:
    """Text -> the decimal ids of its parts in order; a part without a match has none and is empty.

    The public pattern takes plain texts apart into its matches at once, so each match is
    looked up and encoded once and not again beside every mark it stands with.
    """
    if not _is_public(pattern):
        split = regex.compile(pattern).findall
        return lambda text: map(pieces.__getitem__, split(text))
    plain, split_plain, split = re.compile(PLAIN_TEXT).fullmatch, re.compile(PLAIN_MATCHES).findall, _COARSE.findall
    matches = pieces.matches
    return lambda text: map(matches.__getitem__, split_plain(text)) if plain(text) else map(pieces.__getitem__, split(text))


_SCHEMA = pa.schema([(RID, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_DDL = f"{RID} long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"


def _task(ranks, pattern: str, with_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Backtracker(parse_ranks(ranks.value))
        encoded = splitter(pattern, PieceTable(pattern, coder))
        token = {b"%d" % i: t for i, t in coder.token.items()}
        for ids, texts in text_chunks(batches, 1 << 20):
            rows = []
            for rid, text in zip(ids, texts, strict=True):
                line = b" ".join([d for d in encoded(text.decode()) if d])
                body = b"".join(map(token.__getitem__, line.split()))
                rows.append({RID: rid, "n_tokens": line.count(b" ") + 1 if line else 0,
                             "ids_sha256": hashlib.sha256(line).hexdigest(), "decoded_sha256": hashlib.sha256(body).hexdigest(),
                             "ids": list(map(int, line.split())) if with_ids else None,
                             "decoded": body.decode("utf-8", "replace") if with_ids else None})
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
    return task


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text) by a rank file and decode the ids again.

    ``ranks_path`` is read by the driver; each match of ``pattern`` is encoded by itself and
    text that it does not match has no ids. Returns doc_id, n_tokens, ids_sha256 (decimal
    ids joined by one space), decoded_sha256 (of the decoded bytes) and, with ``with_ids``,
    ids and decoded (bytes that are no UTF-8 replaced). Special tokens have no meaning here.

    Null text counts as empty and has no ids; an empty table gives an empty result. Rows
    with null or repeated ids are rows of their own. Other columns are ignored.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())  # one file of a known vocabulary
    rows, own = with_row_ids(docs)
    out = rows.select(RID, "text").mapInArrow(_task(ranks, pattern, with_ids), _DDL)
    out = restore_ids(out, rows, own)
    return out if with_ids else out.drop("ids", "decoded")


def op12_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document with the byte-level 50k rank file."""
    import public_tokenizers
    return encode_decode(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
                         public_tokenizers.PATTERN, with_ids=False)
