"""Piece-wise use of a BPE tokenizer: split a text where no token can cross, encode each distinct piece once."""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, count

import numpy as np

#: fixed value: the characters with the Unicode property White_Space
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: a run of other characters with at most one leading space, or white space up to the last before it
SPACED_PIECE = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: a run of other characters, for tokenizers that drop white space
BARE_PIECE = f"[^{WHITE}]+"
#: distinct pieces a task keeps; the table is emptied when it is full
KEPT_PIECES = 400_000


def load_tokenizer(spec: str):
    """A tokenizer of the ``tokenizers`` library from its JSON text, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    tok.no_padding()
    return tok


def special_tokens(tok) -> dict[str, int]:
    return {t.content: i for i, t in tok.get_added_tokens_decoder().items()}


_bare, _separators = re.compile(BARE_PIECE).findall, re.compile("[\x1c-\x1f]").search


def _split_bare(text: str) -> list[str]:
    """The bare pieces; str.split() differs only in four separators that are no white space here."""
    return _bare(text) if _separators(text) else text.split()


class PieceEncoder:
    """Encodes texts as the tokenizer does, looking each distinct piece up once.

    ``unseen(pieces)`` gives the ids of pieces that are met for the first time.
    """

    def __init__(self, pattern: str, specials: dict[str, int], unseen: Callable[[list[str]], list[list[int]]]):
        self._find = _split_bare if pattern == BARE_PIECE else re.compile(pattern).findall
        self._special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self._specials, self._unseen = specials, unseen
        self._empty()

    def _empty(self):
        self._number: defaultdict[str, int] = defaultdict(count().__next__)
        self._ids, self._end = array("I"), array("q", [0])
        # a special token is a piece that no split can yield, as it is marked
        for content, i in self._specials.items():
            _ = self._number["\0special\0" + content]  # takes the next number
            self._ids.append(i)
            self._end.append(len(self._ids))

    def _pieces(self, text: str) -> list[str]:
        if self._special is None or not self._special.search(text):
            return self._find(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += self._find(text[at:m.start()])
            out.append("\0special\0" + m.group())
            at = m.end()
        return out + self._find(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)"""
        if len(self._number) > KEPT_PIECES:
            self._empty()
        per_text = [self._pieces(t) for t in texts]
        n = np.array([len(p) for p in per_text], dtype=np.int64)
        get = self._number.__getitem__
        which = np.concatenate([np.fromiter(map(get, p), dtype=np.int64, count=len(p)) for p in per_text])
        known = len(self._end) - 1
        if len(self._number) > known:
            fresh = list(self._number)[known:]
            ids = self._unseen(fresh)
            ends = np.cumsum([len(x) for x in ids]) + len(self._ids)
            self._ids.extend(chain.from_iterable(ids))
            self._end.extend(ends.tolist())
        flat, end = np.array(self._ids, dtype=np.uint32), np.array(self._end, dtype=np.int64)
        size = end[which + 1] - end[which]
        out = flat[ranges(end[which], size)]
        total = np.append(0, np.cumsum(size))
        stop = np.append(0, np.cumsum(n))
        return out, total[stop[1:]] - total[stop[:-1]]


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0] .. first[0] + size[0] - 1, first[1] ..`` as one array."""
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(first - (stop - size), size)


def library_ids(tok) -> Callable[[list[str]], list[list[int]]]:
    def ids(pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch(pieces, add_special_tokens=False)]
    return ids


def byte_of_char() -> dict[str, int]:
    """The byte that each printable stand-in character of byte-level vocabularies means."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in set(own)]
    return out | {chr(256 + k): b for k, b in enumerate(rest)}


#: fixed value: how the lower-casing word tokenizers split what is left after white space
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: the same for lower-case ASCII and Latin-1 letters, which NFC and lower-casing treat one by one
_LATIN = "\xc0-\xd6\xd8-\xf6\xf8-\xff"
_LATIN_SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+"


def is_word_tokenizer(spec: dict) -> bool:
    """Whether a tokenizer file normalises and splits as :class:`WordIds` assumes."""
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and spec["model"].get("type") == "BPE"
            and cuts[0].get("pattern") == {"Regex": WORD_SPLIT} and cuts[0].get("invert") is True
            and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex"))


class WordIds:
    """Ids of white-space free pieces: the library's model on each distinct word, its whole way for other scripts."""

    def __init__(self, tok):
        self._whole, self._model = library_ids(tok), tok.model
        self._plain = re.compile(f"[!-~{_LATIN}]+").fullmatch
        self._split = re.compile(_LATIN_SPLIT).findall
        stand_in = {b: c for c, b in byte_of_char().items()}
        self._bytes = {n: "".join(stand_in[b] for b in chr(n).encode()) for n in range(0xC0, 0x100)}
        self._known: dict[str, list[int]] = {}

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        known, out, other = self._known, [], []
        if len(known) > KEPT_PIECES:
            known.clear()
        for k, piece in enumerate(pieces):
            if not (piece.isascii() and piece.isprintable() or self._plain(piece)):
                other.append(k)
                out.append([])
                continue
            low = piece.lower()
            # most pieces are a word, or a word and one mark
            words = ((low,) if low.isalpha() else (low[:-1], low[-1]) if low[:-1].isalpha() and low[-1] in ".,;:!?"
                     else self._split(low))
            ids: list[int] = []
            for word in words:
                got = known.get(word)
                if got is None:
                    stood = word if word.isascii() else word.translate(self._bytes)
                    got = known[word] = [t.id for t in self._model.tokenize(stood)]
                ids = ids + got if ids else got
            out.append(ids)
        for k, ids in zip(other, self._whole([pieces[k] for k in other]), strict=True):
            out[k] = ids
        return out
