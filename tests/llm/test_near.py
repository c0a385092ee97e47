"""MinHash near-dedup (operator 2), line dedup (7) and components against brute force."""

import random

import brute
from llm_helpers import odd_frame, odd_rows, small_docs  # noqa: F401

from pyspark.sql import functions as F

from tidemark.llm import op7_fuzzy_lines as op7
from tidemark.llm.components import components
from tidemark.llm.op2_bayes_minhash import BATCH, HASHES, least_matches, near_duplicates
from tidemark.llm.op7_fuzzy_lines import AGREEING, BANDS, ROWS, apply_lines, dedup_lines
from tidemark.llm.common import with_row_ids

TEXT = " ".join(f"w{i}" for i in range(80))


def check_near(spark, docs, shingle, percent, df=None):
    df = spark.createDataFrame(docs, "doc_id long, text string") if df is None else df
    got = near_duplicates(df, shingle, percent).collect()
    want = brute.near_components(docs, shingle, percent)
    expect = sorted((docs[k][0] if docs[k][0] is not None else -1, n, docs[r][0] if docs[r][0] is not None else -1, k == r)
                    for k, (n, r) in want.items())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id,
                   r.kept) for r in got) == expect


def test_near_on_test_data(spark, small_docs):
    check_near(spark, small_docs, 3, 85)


def test_near_odd_rows(spark):
    check_near(spark, odd_rows(TEXT), 3, 85, odd_frame(spark, TEXT))
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_chains_and_a_large_family(spark):
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    docs, n = [], 0
    for _ in range(120):  # variants of one text, some of them far from the smallest id
        words = list(base)
        for _ in range(rnd.randrange(0, 9)):
            words[rnd.randrange(120)] = f"x{rnd.randrange(10 ** 6)}"
        docs.append((n, " ".join(words)))
        n += 1
    chain = [f"c{i}" for i in range(150)]
    for k in range(12):  # each linked to the next only
        docs.append((n, " ".join(chain[3 * k:] + [f"d{i}" for i in range(3 * k)])))
        n += 1
    check_near(spark, docs, 3, 85)


def test_pruning_keeps_the_chosen_miss_probability():
    import math
    for need, n in zip(least_matches(0.85, 1e-4), range(BATCH, HASHES + 1, BATCH)):
        def tail(m):
            return sum(math.comb(n + 1, k) * 0.85 ** k * 0.15 ** (n + 1 - k) for k in range(m + 1))
        assert tail(need) >= 1e-4 and (need == 0 or tail(need - 1) < 1e-4)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5001 + i) for i in range(50)] + [(None, 3), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_lines(spark, docs, df=None, missed=0):
    df = spark.createDataFrame(docs, "doc_id long, text string") if df is None else df
    got = sorted((r.n_lines, r.n_removed, r.text or "") for r in dedup_lines(df).collect())
    roots = brute.line_components(docs, 20, 80)
    want = []
    for k, (_, text) in enumerate(docs):
        lines = (text or "").split("\n")
        left = [x for p, x in enumerate(lines) if roots.get((k, p), (k, p)) == (k, p)]
        want.append((0 if text is None else len(lines), len(lines) - len(left), "\n".join(left)))
    assert sum(a != b for a, b in zip(got, sorted(want))) <= missed


def test_lines_on_test_data(spark, small_docs):
    check_lines(spark, small_docs, missed=1)  # banding has high, not full recall


def test_lines_planted(spark):
    line = "A line of some forty words that is " + " ".join(f"v{i}" for i in range(30))
    near = line.replace("v7", "u7")
    docs = [(1, f"{line}\nalone one here, twenty chars"), (2, f"short\n{near}\nshort"), (3, line), (4, f"  {line}\t"),
            (5, f"{line}\n{line}"), (6, "another line that is not like the rest at all")]
    check_lines(spark, docs)


def test_lines_odd_rows(spark):
    check_lines(spark, odd_rows(TEXT), odd_frame(spark, TEXT))
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lines_keep_other_columns_and_null_texts(spark):
    rows, _ = with_row_ids(odd_frame(spark, TEXT), keep=["doc_id", "text", "key", "rid", "n_tokens"])
    out = apply_lines(rows)
    assert out.where("text is null").count() == 2
    assert {"key", "rid", "n_tokens"} <= set(out.columns)


def test_lines_in_a_bucket_of_many_families(spark, monkeypatch):
    rnd = random.Random(5)
    families = ["".join(rnd.choice("abcdefghij ") for _ in range(60)) for _ in range(50)]
    docs = [(k * 3 + j, f"{f}{'xyz'[j]}") for k, f in enumerate(families) for j in range(3)]
    # all lines in one bucket, which is dealt in several blocks
    monkeypatch.setattr(op7, "BLOCK", 20)
    signed = op7._bands
    monkeypatch.setattr(op7, "_bands", lambda lines: signed(lines).withColumn("bands", F.array(F.lit(1).cast("long"))))
    check_lines(spark, docs)


def test_lines_without_spaces(spark):
    rnd = random.Random(6)
    # one other character at the beginning, or only the beginning in common
    tails = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789/-") for _ in range(90)) for _ in range(40)]
    docs = [(2 * k + j, f"https://ww{'wv'[j]}.{t}") for k, t in enumerate(tails) for j in range(2)]
    han = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(60)) for _ in range(20)]
    docs += [(1000 + 2 * k + j, f"{'甲乙'[j]}{t}") for k, t in enumerate(han) for j in range(2)]
    check_lines(spark, docs)


def test_lines_near_the_threshold(spark):
    rnd = random.Random(7)
    docs, n = [], 0
    while n < 600:  # pairs of similarity 0.80 to 0.85, no chains
        line = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9)))
                        for _ in range(rnd.randrange(8, 36)))
        other = list(line)
        for _ in range(max(1, len(line) // 45)):
            other[rnd.randrange(len(line))] = "#"
        a, b = ({x[i:i + 5] for i in range(len(x) - 4)} for x in (line, "".join(other)))
        if 0.80 <= len(a & b) / len(a | b) < 0.85:
            docs += [(n, line), (n + 1, "".join(other))]
            n += 2
    assert BANDS * ROWS > AGREEING and (1 - 0.8 ** ROWS) ** BANDS < 1e-3
    check_lines(spark, docs, missed=2)  # 300 pairs at 8e-4 or less: 0.24 expected


def test_a_bucket_of_one_large_component_is_dealt_once(spark):
    from tidemark.llm.op2_bayes_minhash import BUCKET_BLOCK, _dealt_members
    n = 8 * BUCKET_BLOCK
    buckets = spark.range(n).select(F.lit(7).cast("long").alias("bucket"), F.lit(0).alias("band"), "id",
                                    F.when(F.col("id") == 5, 5).otherwise(0).cast("long").alias("comp"))
    dealt = _dealt_members(buckets)
    assert dealt.count() <= n + 10
    # every member of the large component meets the other one in exactly one block
    met = dealt.where("side = 0").select("i", "j").join(dealt.where("side = 1 and top"), ["i", "j"])
    assert met.select("id").distinct().count() == met.count() == n - 1
    assert _dealt_members(buckets.where("id != 5")).count() == 0


def test_buckets_are_whole_however_rows_are_batched():
    import numpy as np
    import pyarrow as pa
    rnd = random.Random(9)
    for _ in range(300):
        width = rnd.randrange(1, 9)
        rows = sorted({(rnd.randrange(12), rnd.randrange(60)) for _ in range(rnd.randrange(0, 40))})
        cut = rnd.randrange(len(rows) + 1)
        sent = []
        for part in ([r for r in rows if r[1] % 2], [r for r in rows if r[1] % 2 == 0], []):  # two tasks and an empty one
            ids = sorted({i for _, i in part})
            # a value of its own where a line is in no bucket of the band
            lists = pa.array([[0 if (b, i) in part else 100 + i for b in range(12)] for i in ids], pa.list_(pa.int32()))
            batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["id", "bands"])
            for made in op7._local_buckets(iter([batch.slice(0, cut), batch.slice(cut)] if cut < len(ids) else [batch])):
                sent += made.to_pylist()
        sent.sort(key=lambda r: (r["a"] is not None, r["band"], r["id"]))
        table = pa.RecordBatch.from_pylist(sent, schema=op7._BUCKET)
        got = [r for b in op7._joined_buckets(iter([table.slice(k, width) for k in range(0, max(1, len(sent)), width)])) for r in b.to_pylist()]
        assert all(r["band"] & 0xFFFFFFFF == 0 for r in got)
        got = [r | {"band": r["band"] >> 32} for r in got]
        size = {b: sum(x == b for x, _ in rows) for b, _ in rows}
        assert sorted((r["band"], r["id"]) for r in got) == [r for r in rows if size[r[0]] > 1]
        # the comparisons with a hub join each bucket: every member reaches the smallest by way of hubs
        up = {(r["band"], r["id"]): r["a"] for r in got}
        for b, i in up:
            at = i
            while up[b, at] != at:
                at = up[b, at]
            assert at == min(j for x, j in rows if x == b)
    assert np.array(op7._halves(b"x")).dtype == np.int64


def test_lines_outside_the_basic_plane(spark):
    line = "a line with \U0001F600 two \U0001F680 astral characters and some more words to compare"
    docs = [(1, line), (2, line.replace("more", "most")), (3, "\U0001F600" * 19 + "\n" + "\U0001F600" * 20), (4, "\U0001F600" * 20)]
    check_lines(spark, docs)


def stored_tables(monkeypatch, *modules):
    """The tables that ``modules`` store from now on: (name, table as read back)."""
    made = []
    for m in modules:
        monkeypatch.setattr(m, "store", lambda df, name, f=m.store: made.append((name, f(df, name))) or made[-1][1])
    return made


def on_disk(df):
    import os
    return os.path.exists(df.__dict__["_tm_path"].removeprefix("file:"))


def test_near_duplicates_keep_no_large_table(spark, small_docs, monkeypatch):
    from tidemark.llm import op2_bayes_minhash as op2
    made = stored_tables(monkeypatch, op2)
    out = op2.near_duplicates(spark.createDataFrame(small_docs, "doc_id long, text string"))
    left = {name for name, df in made if on_disk(df)}
    assert left.isdisjoint({"signatures", "representatives", "buckets", "sets", "star_candidates", "bucket_components"})
    assert out.count() == len(small_docs)


def test_only_lines_that_resemble_others_are_read_again(spark, monkeypatch):
    rnd = random.Random(11)
    docs = [(k, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80))) for k in range(200)]
    docs += [(1000, docs[3][1] + "x"), (1001, docs[5][1])]
    monkeypatch.setattr(op7, "discard", lambda *a: None)
    made = stored_tables(monkeypatch, op7)
    check_lines(spark, docs)
    tables = dict(made)
    assert [name for name, df in made if "line" in df.columns] == ["line_texts", "line_met_texts"]
    assert sorted(bytes(r.line).decode() for r in tables["line_texts"].collect()) == [docs[3][1], docs[3][1] + "x"]
    assert tables["line_met_texts"].count() == 0


def test_lines_are_decided_in_dataframe_expressions(spark, monkeypatch):
    import re
    first, last, other = (f"a line that comes {k} and is long enough to take part" for k in ("first", "lastly, or so,", "in between"))
    # gone lines at both ends, next to each other, alone and all of a text
    docs = [(1, f"{first}\n{last}\n{other}"), (2, f"{first}\nx\n{last}\n{other}\ny\n\n{first}"), (3, f"\n{last}\n{last}\nz\n"), (4, first)]
    plans = []
    monkeypatch.setattr(op7, "store", lambda df, name, f=op7.store: plans.append(df._jdf.queryExecution().analyzed().toString()) or f(df, name))
    out = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    plans.append(out._jdf.queryExecution().analyzed().toString())
    assert len(plans) > 5 and not [p for p in plans if re.search("InArrow|InPandas|Python", p)]
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in out.collect()} == {
        1: (3, 0, docs[0][1]), 2: (7, 4, "x\ny\n"), 3: (5, 2, "\nz\n"), 4: (1, 1, "")}


def test_a_pair_of_lines_is_met_from_one_bucket_only(spark, monkeypatch):
    rnd = random.Random(12)
    base = [rnd.choice("abcdefghij") for _ in range(150)]
    docs = []
    for k in range(40):  # copies that resemble each other, most of them below the threshold
        line = list(base)
        for p in rnd.sample(range(150), 4):
            line[p] = "#"
        docs.append((k, "".join(line)))
    monkeypatch.setattr(op7, "discard", lambda *a: None)
    made = stored_tables(monkeypatch, op7)
    check_lines(spark, docs)
    met = dict(made)["line_met"].select("a", "b")
    assert met.count() > 20 and met.count() == met.distinct().count()


def test_sketches_leave_all_lines_that_reach_the_threshold(spark):
    rnd = random.Random(13)
    lines, pairs = [], []
    for k in range(150):
        line = [rnd.choice("abcdefghij é日\U0001F600") for _ in range(rnd.randrange(20, 900))]
        other = list(line)
        for _ in range(rnd.randrange(0, 1 + len(line) // 20)):
            other[rnd.randrange(len(line))] = "#"
        lines += [(2 * k, "".join(line)), (2 * k + 1, "".join(other))]
        pairs += [(2 * k, 2 * k + 1), (2 * k, (2 * k + 3) % 300)]
    body = op7._sketches(spark.createDataFrame([(i, bytearray(x.encode())) for i, x in lines], "id long, line binary"))
    both = op7._pairs_with(spark.createDataFrame(pairs, "a long, b long"), body, "body")
    left = {(r.a, r.b) for r in both.filter(op7._possible("x", "y", 80)).select("a", "b").collect()}
    sets = {i: {x[j:j + 5] for j in range(len(x) - 4)} for i, x in lines}
    alike = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(alike) > 30 and alike <= left and len(left) < 150


def family(rnd, n, size, changed):
    """``n`` lines made of one by changing some characters: of similarity 0.65 to 0.78 with ``changed`` about 1 in 45."""
    base = [rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)]
    lines = []
    for _ in range(n):
        line = list(base)
        for p in rnd.sample(range(size), changed):
            line[p] = rnd.choice("0123456789")
        lines.append("".join(line))
    return lines


def similarity(x, y):
    a, b = ({s[i:i + 5] for i in range(len(s) - 4)} for s in (x, y))
    return len(a & b) / len(a | b)


def test_lines_below_the_threshold_leave_a_large_bucket_only_when_in_doubt(spark, monkeypatch):
    lines = family(random.Random(14), 60, 400, 8)
    alike = [100 * similarity(x, y) >= 76 for k, x in enumerate(lines) for y in lines[:k]]
    monkeypatch.setattr(op7, "LARGE", 3, raising=False)
    monkeypatch.setattr(op7, "discard", lambda *a: None)
    made = stored_tables(monkeypatch, op7)
    check_lines(spark, list(enumerate(lines)))
    met = dict(made)["line_met"].count()
    # before, all that agree in their signatures: most of the 1770 pairs
    assert met <= sum(alike) + 200


def test_sketches_of_long_lines_are_sharp(spark):
    lines = family(random.Random(15), 40, 1500, 32)
    pairs = [(a, b) for b in range(len(lines)) for a in range(b)]
    assert max(similarity(lines[a], lines[b]) for a, b in pairs) < 0.77
    body = op7._sketches(spark.createDataFrame([(i, bytearray(x.encode())) for i, x in enumerate(lines)], "id long, line binary"))
    both = op7._pairs_with(spark.createDataFrame(pairs, "a long, b long"), body, "body")
    assert both.filter(op7._possible("x", "y", 80)).count() < 0.02 * len(pairs)
