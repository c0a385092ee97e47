"""Spelling variants (11), backtracking BPE (12) and conversation repair (13) against brute force and the library."""

import hashlib
import random
import re
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from brute import cheapest, damage, letter_words, one_edit_apart, repaired_conversations, spelling
from llm_helpers import SMALL, odd_frame, odd_rows, small_docs  # noqa: F401

from tidemark.llm import op11_spelling_variants as op11
from tidemark.llm import op12_backtracking_bpe as op12
from tidemark.llm import op13_conversation_repair as op13

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# spelling variants

def variants(rng, letters, n, longest):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, longest))) for _ in range(n)}
    for w in list(words):
        k = rng.randrange(len(w))
        words.add(w[:k] + rng.choice(letters) + w[k + rng.randint(0, 1):])
    return sorted(w for w in words if len(w) >= 4)


@pytest.mark.parametrize("share", [1, 6, 50, 50_000])
@pytest.mark.parametrize("letters,longest", [("ab", 7), ("abc", 9), ("abcdeé漢\U0001F600", 12), ("abcdefgh", 45)])
def test_listed_grams_find_every_near_pair(monkeypatch, share, letters, longest):
    monkeypatch.setattr(op11, "SHARE", share)
    words = variants(random.Random(share * len(letters) + longest), letters, 90, longest)
    counts = {}
    for w in words:
        padded = op11._padded(w)
        for p in range(len(w) + op11.SHORT - 1):
            for q in range(op11.SHORT, op11.LONG + 1):
                counts[padded[p:p + q]] = counts.get(padded[p:p + q], 0) + 1
    total = sum(len(w) + op11.SHORT - 1 for w in words)
    frequent = {g: n for g, n in counts.items() if n > total // share}
    lists = {}
    for w in words:
        for key in op11.list_keys(w, frequent):
            lists.setdefault(key, []).append(w)
    member = [(k, w) for k, ws in enumerate(lists.values()) for w in ws]
    x, y = op11.near_pairs(np.array([k for k, _ in member]), np.full(len(member), 2), [w for _, w in member])
    got = {frozenset((member[p][1], member[q][1])) for p, q in zip(x.tolist(), y.tolist())}
    assert got == {frozenset((a, b)) for k, a in enumerate(words) for b in words[k + 1:] if one_edit_apart(a, b)}
    for a, b in [*map(tuple, got)][:50]:
        assert op11.one_edit(a, b)


def test_spelling_equals_brute_force(spark, small_docs, monkeypatch):
    monkeypatch.setattr(op11, "BLOCK", 7)  # lists in many blocks
    docs = spark.createDataFrame(small_docs, "doc_id long, text string")
    for modulus, min_n in ((199, 5), (3, 2)):
        words = letter_words(small_docs, min_n=min_n, modulus=modulus)
        out = op11.spelling_forms(op11.word_counts(docs, min_n=min_n, modulus=modulus)).collect()
        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out} == spelling(words)
        assert len(out) == len(words)
    assert any(f for f, *_ in spelling(words).values())


def test_query_equals_brute_force(spark, small_docs):
    out = op11.op11_spelling_variants(spark, SMALL)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: tuple(r)[1:] for r in out.collect()} == spelling(letter_words(small_docs))


def test_long_chains_and_hot_lists(spark):
    # n grows five-fold along a chain; a third of the words share everything but the end
    chain = [("a" * k + "bcdefg", 5 ** (k + 1)) for k in range(9)]
    same = [("commonprefix" + chr(97 + a) + chr(97 + b) + chr(97 + c), 6) for a in range(12) for b in range(12) for c in range(4)]
    words = dict(chain + same)
    out = op11.spelling_forms(spark.createDataFrame(list(words.items()), "word string, n long"))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect()}
    assert got == spelling(words)
    assert got["bcdefg"][1] == "aaaaaaaabcdefg"


def test_spelling_odd_inputs(spark):
    passage = "Strasse strasse STRASSE stras strassen Éclair éclair " * 3
    rows = odd_rows(passage)
    out = op11.spelling_forms(op11.word_counts(odd_frame(spark, passage)))
    assert {r.word: tuple(r)[1:] for r in out.collect()} == spelling(letter_words(rows))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op11.spelling_forms(op11.word_counts(empty)).count() == 0
    long = spark.createDataFrame([("x" * 3000, 9), ("x" * 2999 + "y", 50), ("x" * 3001, 7), (None, 4)], "word string, n long")
    assert {r.word[-2:] + str(len(r.word)): r.n_near for r in op11.spelling_forms(long).collect()} == {
        "xx3000": 2, "xy3000": 1, "xx3001": 1}
    with pytest.raises(ValueError):
        op11.spelling_forms(spark.createDataFrame([("abc", 1)], "word string, n long"))
    with pytest.raises(ValueError):
        op11.spelling_forms(long, ratio=1)


# byte-level BPE

@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_backtracking_equals_the_library(name, small_docs):
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = op12.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = op12.Backtracker(ranks)
    rng = random.Random(7)
    chars = "aàé the ing  \n\t1230'sllve--==__.,;é漢字\U0001F600\x1c\x85　ABCab"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * 3000, " " * 777, "=-" * 900, "Thethethe" * 200, "<|endoftext|>", *[t for _, t in small_docs[:60]]]
    assert op12.PUBLIC == public_tokenizers.PATTERN
    texts += [a + b + c + d for a in ("", " ", "'") for b in ("don't", "ÀÿÖ", "12", "x²", "ªµº", "__") for c in ("", "'s", ",", "×÷", "'re'") for d in ("", "7", "z")]
    table = op12.PieceTable(public_tokenizers.PATTERN, coder)
    for text in texts:
        want = library.encode_ordinary(text)
        assert [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in coder.encode(m.encode())] == want
        assert b" ".join(d for d in map(table.__getitem__, op12._COARSE.findall(text)) if d) == b" ".join(b"%d" % i for i in want)


def test_plain_texts_are_taken_apart_once(small_docs):
    with open(RANKS, "rb") as f:
        ranks = op12.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = op12.Backtracker(ranks)
    pieces = op12.PieceTable(public_tokenizers.PATTERN, coder)
    encoded = op12.splitter(public_tokenizers.PATTERN, pieces)
    rng = random.Random(8)
    texts = ["".join(rng.choice("aÀÿé ths'rellvm  \n\t\r\x0b\x0c12,.-~_\"") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += [f"word{a}{b}" for a in ",.;:!?" for b in ("", " ", "\n", "\n\nb", "  c", " \t")]
    for text in texts + ["x\x1cy z", "x\x85 y", "ªa 1²", "\xa0 a"] + [t for _, t in small_docs[:60]]:
        assert b" ".join(d for d in encoded(text) if d) == b" ".join(b"%d" % i for i in library.encode_ordinary(text))
        # a word beside a mark is no entry of its own
        assert not pieces or not regex.fullmatch(op12.PLAIN_TEXT, text)
        pieces.clear()


def test_pairs_are_judged_up_to_the_border():
    with open(RANKS, "rb") as f:
        coder = op12.Backtracker(op12.parse_ranks(f.read()))
    rng, ids = random.Random(9), list(coder.token)
    for _ in range(3000):
        a, b = (rng.choice(ids[:rng.choice((260, 600, len(ids)))]) for _ in range(2))
        assert coder._follows(a, b) == (coder.merged(coder.token[a] + coder.token[b]) == [a, b])


def test_unreachable_tokens_and_missing_bytes():
    ranks = {bytes([b]): b for b in b"abcd"} | {b"ab": 200, b"bc": 201, b"abcd": 202, b"cd": 203}
    coder = op12.Backtracker(ranks)
    assert coder.encode(b"abcd") == [202]  # a whole piece that is a token
    for piece in (b"abcda", b"aabcd", b"abcabcd", b"dcba", b"bcdab"):
        assert coder.encode(piece) == coder.merged(piece)
    with pytest.raises(ValueError):
        coder.encode(b"abx")


def expected_codes(texts):
    with open(RANKS, "rb") as f:
        ranks = op12.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for t in texts:
        ids = library.encode_ordinary(t or "")
        out.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    return out


def test_codes_of_the_documents(spark, small_docs, monkeypatch):
    monkeypatch.setattr(op12, "KEPT", 500)  # memos that are emptied on the way
    out = op12.op12_backtracking_bpe(spark, SMALL).collect()
    want = dict(zip([i for i, _ in small_docs], expected_codes([t for _, t in small_docs])))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == want
    assert len(out) == len(small_docs)


def test_codes_of_odd_rows(spark):
    passage = "One  passage\x1c of text, 日本 \U0001F600 don't <|endoftext|>  \n"
    rows = odd_rows(passage)
    out = op12.encode_decode(odd_frame(spark, passage), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == sorted(
        ((i or 0), *c) for (i, _), c in zip(rows, expected_codes([t for _, t in rows])))
    assert sorted(r.decoded for r in out) == sorted(t or "" for _, t in rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op12.encode_decode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    # another pattern may leave text out
    words = op12.encode_decode(spark.createDataFrame([(1, "ab 12")], "doc_id long, text string"), RANKS, r"[a-z]+").first()
    assert words.decoded == "ab"


# conversation repair

def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(3)
    for k in range(1500):
        monkeypatch.setattr(op13, "BLOCK", rng.choice([1, 2, 3, 4096]))
        symbols = []
        while len(symbols) < k % 15:
            symbols += [rng.randrange(9)] * rng.choice([1, 1, 1, 2, 3, 5])
        runs = [(s, len(list(g))) for s, g in groupby(symbols)]
        cost, audit, _ = op13.repair(bytes(s for s, _ in runs), [n for _, n in runs])
        plain = [(op13.SYMBOLS[s][0], False, op13.SYMBOLS[s][1]) if s else ("u", True, False) for s in symbols]
        assert (cost, audit) == cheapest(plain)


def test_a_long_run():
    cost, audit, plan = op13.repair(bytes([3]), [1_000_001])
    assert cost == 1_000_002 and len(audit) == len(re.findall("k|[=+].", plan)) == 1_000_002


def check_conversations(got, want):
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert len(got) == len(want)


def test_query_of_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = repaired_conversations(damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    out = op13.op13_conversation_repair(spark, SMALL)
    assert dict(out.dtypes)["cost"] == "bigint"
    check_conversations(out.collect(), {c: want[c][:8] if c in want else none for c in {r[0] for r in rows}})


def odd_turns():
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    texts = ["", " \n\t", None, "Yes.", "Yes.", "no", "Who? \x0b", "\U0001F600", " long " * 3000 + "end.", "a\nb."]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, None, *range(6)]), rng.choice(roles), rng.choice(texts)) for _ in range(160)]
    hot = [(9, k, "user" if k % 3 else "assistant", f"t {k % 40}{'.' * (k % 2)}") for k in range(600)]
    return rows + rows[:30] + hot + [(10, None, "user", " ")]


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(op13, "RUNS", 5)  # a conversation in many parts
    rows = odd_turns()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, n int")
    check_conversations(op13.repair_conversations(frame).collect(), repaired_conversations(rows))
    out = op13.repair_conversations(frame.limit(0))
    assert out.count() == 0 and "repaired" in out.columns


def test_damage_equals_brute_force(spark):
    rows = odd_turns()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, op13.damaged(frame).collect()), key=order) == sorted(damage(rows), key=order)
