"""BPE (6), token files (10) against the tokenizers library, WARC derivatives (4)."""

import hashlib
import json
import os
import zlib

import numpy as np
import pytest
from llm_helpers import odd_frame, odd_rows, small_docs  # noqa: F401
from tokenizers import Tokenizer

from tidemark.llm.bpe import BARE_PIECE, SPACED_PIECE, PieceEncoder, WordIds, is_word_tokenizer, library_ids, special_tokens
from tidemark.llm.op4_warc_derivatives import (
    BadRecord, derivatives, digest, page_text, parse_record, read_warc, response_record, write_warc)
from tidemark.llm.op6_transducer_bpe import encode_decode, tokenizer_path
from tidemark.llm.op10_arrow_tokens import SequenceFile, tokens_to_files
from tidemark.llm.transducer import Transducer, build

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
HARD = ["a  b\n\n c\t\td <|endoftext|> x<|endoftext|>'s 's it's I'll  x \x1c\x1dq 　\u0085 éﬁ \U0001F600 12 3456 a_b--c!!",
        "İ Σσς <|startoftext|> end ", "", " ", "\n\n", " x x x", "ア漢字 ​ zero ́ comb",
        "é    ", "\0special\0<|endoftext|>", "don't can't we're " * 3]


@pytest.mark.parametrize("path,pattern", [(BYTE, SPACED_PIECE), (WORD, BARE_PIECE)])
def test_pieces_equal_the_library(path, pattern, small_docs):
    tok = Tokenizer.from_file(path)
    enc = PieceEncoder(pattern, special_tokens(tok), library_ids(tok))
    texts = HARD + [t for _, t in small_docs[:60]]
    flat, n = enc.encode(texts)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_word_ids_equal_the_library(small_docs):
    with open(WORD, encoding="utf-8") as f:
        assert is_word_tokenizer(json.load(f))
    with open(BYTE, encoding="utf-8") as f:
        assert not is_word_tokenizer(json.load(f))
    tok = Tokenizer.from_file(WORD)
    enc = PieceEncoder(BARE_PIECE, special_tokens(tok), WordIds(tok))
    rare = ["ÀÉÎÕÜ ÿ×÷ ß ẞ ΑΣ Σ ŠžǄ 'S 'RE it'S I'LL d'D 1a2 ½² a_b __ --x!! ªº µ \u0130x e\u0301 \ufb01", "'re're'x", "é" * 50]
    texts = HARD + rare + [t for _, t in small_docs]
    flat, n = enc.encode(texts)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_transducer(tmp_path):
    entries = {w.encode(): [k, len(w)] * (k % 3) for k, w in enumerate(["", "a", "ab", "abc", "b", "bc", "xabc", "xbc", "talking",
                                                                       "walking", "walked", "talked", "été"])}
    path = tmp_path / "lexicon"
    path.write_bytes(build(entries))
    t = Transducer(str(path))
    words = [*entries, b"abcd", b"walk", b"\xff", b"zz"]
    number = t.numbers(words)
    assert [t.ids(n) if n >= 0 else None for n in number.tolist()] == [entries.get(w) for w in words]
    path.write_bytes(build({}))
    assert Transducer(str(path)).numbers([b"a", b""]).tolist() == [-1, -1]
    shared = {p + b"ing": [1] for p in (b"talk", b"walk", b"jump", b"sing")}
    assert len(build(shared)) < len(build({p + s: [1] for p, s in zip((b"talk", b"walk", b"jump", b"sing"),
                                                                       (b"abc", b"def", b"ghi", b"jkl"))}))


@pytest.mark.parametrize("words", [0, 50, 5000])
def test_bpe_round_trip(spark, small_docs, words):
    tok = Tokenizer.from_file(BYTE)
    docs = [*small_docs[:80], *[(1000 + k, t) for k, t in enumerate(HARD)], (2000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in encode_decode(df, BYTE, lexicon_words=words).collect()}
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        r = got[i]
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), back)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_lexicon_takes_whole_classes_that_fit(spark):
    from tidemark.llm.op6_transducer_bpe import lexicon
    docs = spark.createDataFrame([(1, "a" + " b" * 64 + " c" * 64 + " d" * 8 + " e f")], "doc_id long, text string")
    assert lexicon(docs, 1) == [] and lexicon(docs, 2) == [b" b", b" c"] and lexicon(docs, 9) == [b" b", b" c", b" d"]
    assert lexicon(docs.limit(0), 9) == []


def test_bpe_odd_rows(spark):
    df = odd_frame(spark, "some passage")
    got = encode_decode(df, BYTE).collect()
    assert sorted(r.decoded for r in got) == sorted(t or "" for _, t in odd_rows("some passage"))
    assert encode_decode(df.limit(0), BYTE).count() == 0


def check_files(spark, docs, df, length):
    tok = Tokenizer.from_file(WORD)
    folder, manifest, out = tokens_to_files(df, WORD, end_id=1, length=length)
    want, at = [], 0
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in out.collect()) == want
    return folder, manifest.orderBy("base").collect(), [tok.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]


@pytest.mark.parametrize("length", [16, 2048])
def test_token_files(spark, small_docs, length):
    docs = [*small_docs[:60], (1000, None), (1001, ""), (1002, HARD[0])]
    folder, files, ids = check_files(spark, docs, spark.createDataFrame(docs, "doc_id long, text string"), length)
    stream = []
    for m in files:
        f = SequenceFile(folder, m.name)
        assert f.length == length
        for k in range(m.n_sequences):
            seq, mask = f.sequence(k)
            assert len(seq) == length and not seq.flags.owndata  # a view of the mapped file
            assert mask.sum() == length or k == m.n_sequences - 1
            stream += seq[mask == 1].tolist()
    assert stream == [x for d in ids for x in d]


def test_token_files_odd_rows(spark):
    check_files(spark, odd_rows("some passage"), odd_frame(spark, "some passage"), 64)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens_to_files(empty, WORD, 1)[2].count() == 0


PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>A &amp; B</title><style>p{}</style></head>
<body><!-- gone --><script>var t="</p>";</script><nav><a href="/x?a=1&amp;b=2">X</a></nav><p>one <b>two</b><br>three &eacute;
<img src='i.png'></p></body></html>"""


def test_derivatives_link_to_their_response(spark):
    rec = response_record(7, "http://e.org/a\r\nb", PAGE, "2024-01-02T03:04:05Z")
    head, block, size = parse_record(rec)
    assert size == len(rec) and head["warc-block-digest"] == digest(block)
    df = spark.createDataFrame([(bytearray(rec), 1), (None, 2), (bytearray(b"junk"), 3), (bytearray(rec[:-60]), 4),
                                (bytearray(rec.replace(b"WARC-Type: response", b"WARC-Type: request")), 5),
                                (bytearray(rec), 6)], "record binary, uri int")
    rows = derivatives(df).collect()
    good = [r for r in rows if r.error is None]
    assert len(rows) == 5 and len(good) == 2 and good[0] == good[1]
    r = good[0]
    assert r.source_id == head["warc-record-id"] and r.source_digest == digest(PAGE.encode())
    for data, rid, dig, kind in ((r.metadata, r.metadata_id, r.metadata_digest, "metadata"),
                                 (r.conversion, r.conversion_id, r.conversion_digest, "conversion")):
        h, b, _ = parse_record(bytes(data))
        assert (h["warc-type"], h["warc-record-id"], h["warc-refers-to"]) == (kind, rid, r.source_id)
        assert h["warc-block-digest"] == dig == digest(b) and h["warc-date"] == "2024-01-02T03:04:05Z"
        assert h["warc-target-uri"] == "http://e.org/a b"
    assert parse_record(bytes(r.conversion))[1].decode() == "X\none two\nthree é" == page_text(PAGE)
    facts = json.loads(parse_record(bytes(r.metadata))[1])["Envelope"]
    assert facts["WARC-Header-Metadata"]["warc-record-id"] == r.source_id
    page = facts["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert page["HTML-Metadata"]["title"] == "A & B" and page["HTML-Metadata"]["lang"] == "en"
    assert [x["url"] for x in page["HTML-Metadata"]["links"]] == ["/x?a=1&b=2", "i.png"]


def test_warc_files_round_trip(spark, scratch):
    recs = [response_record(k, f"http://e.org/{k}", None if k == 3 else PAGE * k) for k in range(40)]
    df = spark.createDataFrame([(bytearray(r),) for r in recs] + [(None,)], "record binary")
    files = write_warc(df, os.path.join(scratch, "warc"), max_bytes=2000)
    assert files.count() > 3 and files.groupBy().sum("records").first()[0] == 40
    back = sorted(bytes(r.record) for r in read_warc(spark, os.path.join(scratch, "warc"), files).collect())
    assert back == sorted(recs)
    none = write_warc(df.limit(0), os.path.join(scratch, "none"))
    assert read_warc(spark, os.path.join(scratch, "none"), none).count() == 0


def test_a_bad_record_in_the_middle_of_a_file(spark, scratch):
    recs = [response_record(k, f"http://e.org/{k}", PAGE * k) for k in range(6)]
    bad = [b"WARC/1.1\r\nno colon\r\n\r\nblock\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n" + b"y" * (3 << 20) + b"\r\n\r\n"]
    folder = os.path.join(scratch, "foreign")
    # one file in this order
    df = spark.createDataFrame([(bytearray(r),) for r in (*recs[:2], bad[0], *recs[2:4], bad[1], *recs[4:])], "record binary").coalesce(1)
    back = read_warc(spark, folder, write_warc(df, folder))
    assert sorted(bytes(r.record) for r in back.collect()) == sorted(recs + bad)
    out = derivatives(back)
    assert out.where("error is not null").count() == 2 and out.where("error is null").count() == 6


def test_bad_records():
    for data in (b"", b"WARC/1.1\r\nno colon\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"):
        with pytest.raises(BadRecord):
            parse_record(data)


def http_record(headers, body, kind="text/html"):
    head = "".join(f"{k}: {v}\r\n" for k, v in [("Content-Type", kind), *headers] if v)
    block = f"HTTP/1.1 200 OK\r\n{head}\r\n".encode() + body
    lines = f"WARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nWARC-Concurrent-To: <urn:x:2>\r\nWARC-Concurrent-To: <urn:x:3>\r\n"
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


CODED_PAGE = "<html><head><title>T</title></head><body><p>Grüße, 日本</p><p>two</p></body></html>"


def chunked(data, size=7):
    parts = [data[k:k + size] for k in range(0, len(data), size)]
    return b"".join(b"%x;x=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


@pytest.mark.parametrize("headers,body,kind,text,problem", [
    ([("Content-Encoding", "gzip")], __import__("gzip").compress(CODED_PAGE.encode()), "text/html", "Grüße, 日本\ntwo", None),
    ([("Content-Encoding", "deflate")], zlib.compress(CODED_PAGE.encode()), "text/html", "Grüße, 日本\ntwo", None),
    ([("Content-Encoding", "deflate")], zlib.compress(CODED_PAGE.encode())[2:-4], "text/html", "Grüße, 日本\ntwo", None),
    ([("Transfer-Encoding", "chunked")], chunked(CODED_PAGE.encode()), "text/html", "Grüße, 日本\ntwo", None),
    ([("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip")], chunked(__import__("gzip").compress(CODED_PAGE.encode())), "text/html",
     "Grüße, 日本\ntwo", None),
    ([("Transfer-Encoding", "chunked")], CODED_PAGE.encode(), "text/html", "Grüße, 日本\ntwo", None),
    ([], CODED_PAGE.replace("</head>", "x" * 3000 + '<meta charset="latin-1"></head>').replace(", 日本", "").encode("latin-1"), "text/html",
     "Grüße\ntwo", None),
    ([], b"\x89PNG\r\n\0\0", "image/png", None, None), ([], b"a\0b", "", None, None), ([], b"<p>plain</p>", "", "plain", None),
    ([], b"1 < 2\n\n<p>", "text/plain", "1 < 2\n\n<p>", None),
    ([("Content-Encoding", "br")], b"\x0b\x02", "text/html", None, "content coding br"),
    ([("Content-Encoding", "gzip")], b"no gzip", "text/html", None, "gzip: "),
    ([("Content-Encoding", "gzip")], __import__("gzip").compress(CODED_PAGE.encode())[:-12], "text/html", None, "gzip: incomplete"),
])
def test_bodies(spark, headers, body, kind, text, problem):
    record = http_record(headers, body, kind)
    row = derivatives(spark.createDataFrame([(record,)], "record binary")).first()
    meta = json.loads(parse_record(bytes(row.metadata))[1])["Envelope"]
    response = meta["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert row.error is None and row.source_digest == digest(body) == response["Entity-Digest"]
    assert meta["WARC-Header-Metadata"]["warc-concurrent-to"] == ["<urn:x:2>", "<urn:x:3>"]
    assert (response.get("Entity-Problem") or "").startswith(problem or "") and bool(response.get("Entity-Problem")) == bool(problem)
    if text is None:
        assert row.conversion is None and row.conversion_id is None and row.conversion_digest is None
    else:
        block = parse_record(bytes(row.conversion))[1]
        assert block.decode() == text and row.conversion_digest == digest(block)


def test_a_body_that_unfolds_too_far(spark, monkeypatch):
    from tidemark.llm import op4_warc_derivatives as op4
    monkeypatch.setattr(op4, "MAX_BODY", 1000)
    record = http_record([("Content-Encoding", "gzip")], __import__("gzip").compress(b"x" * 2000))
    rows = derivatives(spark.createDataFrame([(record,)], "record binary")).collect()
    assert len(rows) == 1 and "unfolds" in rows[0].error and rows[0].metadata is None


def test_responses_of_odd_pages(spark):
    from tidemark.llm.op4_warc_derivatives import responses
    rows = [(1, None, None, "x"), (2, "http://a", "", "x"), (2, "http://a", "", "x"), (None, "http://b", "<p>" + "long " * 50_000, "x"),
            (3, "http://c/\r\nX: y", CODED_PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    out = derivatives(responses(pages)).collect()
    assert len(out) == 5 and all(r.error is None for r in out)
    assert len({r.source_id for r in out}) == 4  # the repeated page gives the same record
    texts = sorted(parse_record(bytes(r.conversion))[1].decode() for r in out)
    assert texts[:3] == ["", "", ""] and texts[3] == "Grüße, 日本\ntwo" and texts[4] == "long " * 49_999 + "long"
    assert responses(pages.limit(0)).count() == 0
