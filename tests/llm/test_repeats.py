"""Substring dedup (operators 5 and 9) against brute force."""

import random

import brute
import numpy as np
import pytest
from llm_helpers import odd_frame, odd_rows, small_docs  # noqa: F401

from tidemark.llm.op5_suffixes import remove_shared, spread_of
from tidemark.llm.op9_recompression import remove_repeats
from tidemark.llm.recompression import anchors

PASSAGE = " ".join(f"w{i % 37}" for i in range(60))


def words_of(rows):
    return sorted((r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def bytes_of(rows):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def check_words(spark, docs, window, df=None):
    df = spark.createDataFrame(docs, "doc_id long, text string") if df is None else df
    got = remove_repeats(df, window=window, with_text=False).collect()
    want = brute.earlier_words(docs, window)
    assert words_of(got) == sorted(want.values())
    return got


def check_bytes(spark, docs, window, df=None):
    df = spark.createDataFrame(docs, "doc_id long, text string") if df is None else df
    got = remove_shared(df, window=window, with_bytes=False).collect()
    assert bytes_of(got) == sorted(brute.shared_bytes(docs, window).values())
    return got


def test_words_on_test_data(spark, small_docs):
    got = check_words(spark, small_docs, 20)
    want = brute.earlier_words(small_docs, 20)
    assert {r.doc_id: r.n_removed for r in got} == {i: want[k][1] for k, (i, _) in enumerate(small_docs)}


def test_bytes_on_test_data(spark, small_docs):
    got = check_bytes(spark, small_docs, 200)
    want = brute.shared_bytes(small_docs, 200)
    assert {r.doc_id: r.n_removed for r in got} == {i: want[k][1] for k, (i, _) in enumerate(small_docs)}


def test_odd_rows(spark):
    # rows are documents of their own, in the order of (id, text)
    check_words(spark, odd_rows(PASSAGE), 20, odd_frame(spark, PASSAGE))
    check_bytes(spark, odd_rows(PASSAGE), 64, odd_frame(spark, PASSAGE))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
    assert remove_shared(empty).count() == 0


def test_few_letters_make_many_overlapping_repeats(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 120)))) for i in range(40)]
    docs.append((99, "a " * 300))
    check_words(spark, docs, 8)
    check_bytes(spark, docs, 24)


def test_kept_texts(spark):
    plain = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "x " + plain), (2, plain + " y")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in remove_repeats(df, window=20).collect()}
    assert got == {1: "x " + plain, 2: "y"}
    left = {r.doc_id: bytes(r.kept_bytes) for r in remove_shared(df, window=64).collect()}
    assert left == {1: b"x ", 2: b" y"}


def test_window_bound(spark):
    with pytest.raises(ValueError):
        remove_shared(spark.createDataFrame([], "doc_id long, text string"), window=8)
    assert spread_of(200) == 64


@pytest.mark.parametrize("alphabet", [2, 5, 1000])
def test_equal_windows_take_equal_anchors(alphabet):
    rnd = np.random.default_rng(alphabet)
    shared = rnd.integers(0, alphabet, 60).astype(np.uint64)
    left, right = (rnd.integers(0, alphabet, 50).astype(np.uint64) for _ in range(2))
    words = np.concatenate([left, shared, right, right, shared, left])
    doc = np.repeat([0, 1], 160)
    p, lo, hi = anchors(words, doc, 20, 3)
    at = {int(x): (int(a - x), int(b - x)) for x, a, b in zip(p, lo, hi)}
    for k in range(41):
        assert at[50 + k] == at[210 + k]
    assert all(0 <= a and b <= 20 for a, b in at.values())


def test_documents_are_dealt_by_a_hash(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tidemark.llm.repeats import _of_doc
    ids = [*range(0, 32_000, 8), -1, -8, 1 << 62, -(1 << 63)]
    dealt = _of_doc(np.array(ids, dtype=np.int64), 8)
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select("id", F.pmod(F.xxhash64("id"), F.lit(8)).alias("p")).collect()
    assert {r.id: r.p for r in rows} == dict(zip(ids, dealt.tolist()))
    assert np.bincount(dealt).min() > 400  # ids that are multiples of the partitions spread evenly


def test_exchanges_are_released_between_the_passes(spark, monkeypatch):
    from tidemark.llm import repeats
    events = []
    monkeypatch.setattr(repeats, "store", lambda df, name, f=repeats.store: events.append(name) or f(df, name))
    monkeypatch.setattr(repeats, "discard", lambda spark, *t: events.append("discard"))
    text = "".join(chr(97 + k * k % 26) + str(k) for k in range(200))
    docs = spark.createDataFrame([(1, text), (2, "other " + text), (3, "short")], "doc_id long, text string")
    assert sum(r.n_removed for r in remove_shared(docs).collect()) == 2 * len(text)
    assert events == ["repeat_runs", "discard", "repeat_windows", "discard"]


def test_packed_rows_are_not_sorted_and_travel_in_small_batches(spark, monkeypatch):
    from tidemark.llm import common, repeats
    conf, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    def look(df, name, f=repeats.store):
        seen[name] = df._jdf.queryExecution().executedPlan().toString().count("Sort ["), spark.conf.get(conf)
        return f(df, name)
    monkeypatch.setattr(repeats, "store", look)
    before = spark.conf.get(conf)
    text = "".join(chr(97 + k * k % 26) + str(k) for k in range(200))
    docs = spark.createDataFrame([(1, text), (2, "other " + text), (3, "short")], "doc_id long, text string")
    assert sum(r.n_removed for r in remove_shared(docs).collect()) == 2 * len(text)
    # only documents and the rows about them are sorted, and only by kind
    assert seen == {"repeat_runs": (0, str(common.ARROW_BYTES)), "repeat_windows": (1, str(common.ARROW_BYTES))}
    assert spark.conf.get(conf) == before


def test_small_batches_end_with_an_error(spark):
    from tidemark.llm import common
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        1 / 0
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
