"""Quality cascade (3), decontamination (1) and PII (8)."""

import datetime as dt
import hashlib
import re

import pytest
from llm_helpers import SMALL, odd_frame
from pyspark.sql import functions as F

from tidemark.llm.op1_template_decontamination import contaminated
from tidemark.llm.op3_quality_cascade import BASE_RULES, MEASURES, RULES, cascade, order_rules, words_of
from tidemark.llm.op8_feistel_pii import DATE_A, DATE_B, feistel, luhn_valid, pseudonymise
from tidemark.llm.queries import ORACLE_SQL, QUERIES

CLEAN = ("The committee met on a rainy evening and spoke about many plans for the old harbour, "
         "its boats and the people who still live beside the water every day.")


def test_quality_matches_sql(spark):
    import importlib.util
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spec = importlib.util.spec_from_file_location("tm_compare_llm", os.path.join(root, "tools", "compare.py"))
    compare = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(compare)
    con = compare.duck(SMALL)
    for name, sql in ORACLE_SQL.items():
        problems, *_ = compare.compare(spark, con, name, QUERIES[name], sql, SMALL)
        assert not problems, problems


def test_repeated_words_by_hand(spark):
    eight = "a b c d e f g h"
    texts = [None, "", eight, f"{eight} {eight}", f"{eight} x {eight}", "a " * 12, "x y " + eight + " z " + eight + " i"]

    def brute(text):
        w = (text or "").split()
        seen = {}
        for p in range(len(w) - 7):
            seen.setdefault(tuple(w[p:p + 8]), []).append(p)
        return len({k for ps in seen.values() if len(ps) > 1 for p in ps for k in range(p, p + 8)})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    df = df.withColumn("words", words_of(F.col("text")))
    got = [r.n for r in df.select("i", MEASURES["n_repeat_words"]().alias("n")).orderBy("i").collect()]
    assert got == [brute(t) for t in texts]


def test_cascade_verdict_does_not_depend_on_the_order(spark):
    docs = spark.createDataFrame([(1, CLEAN), (2, "few"), (3, "# " * 30 + CLEAN), (4, "so so so so " * 9), (5, None)],
                                 "doc_id long, text string")
    kept = {r.doc_id for r in cascade(docs).where("rejected_by is null").collect()}
    assert kept == {1}
    assert {r.doc_id for r in cascade(docs, tuple(reversed(RULES))).where("rejected_by is null").collect()} == kept
    assert sorted(r.name for r in order_rules(docs, RULES)) == sorted(r.name for r in RULES)
    assert cascade(docs, rules=()).where("rejected_by is null").count() == 5


def test_rules_are_ordered_by_what_is_left_to_reject(spark):
    from tidemark.llm.op3_quality_cascade import Rule
    docs = spark.createDataFrame([(k, "x " * k) for k in range(40)], "doc_id long, text string")
    most = Rule("most", lambda m: m("n_words") < 20)
    inside = Rule("inside", lambda m: m("n_words") < 15)      # rejects nothing that "most" lets through
    other = Rule("other", lambda m: m("n_words") >= 38)
    dear = Rule("dear", lambda m: (m("n_repeat_words") >= 0) & (m("n_words") < 30))
    times = {"most": 1.1, "inside": 0.3, "other": 1.0, "dear": 40.0}

    def order(rules):
        runs = iter([0.1] * 3 + [0.1 + times[r.name] for r in rules for _ in range(3)])
        return [r.name for r in order_rules(docs, rules, clock=lambda job: next(runs))]
    # 15 rows at a quarter of a second come first, then 5 at one, 2 at one, 8 at 32
    assert order((most, inside, other, dear)) == ["inside", "most", "other", "dear"]
    assert order((dear, other, inside, most)) == ["inside", "most", "other", "dear"]
    times["inside"] = 1.0
    assert order((inside, other, dear, most)) == ["most", "other", "dear", "inside"]


def test_later_measures_are_skipped(spark):
    """A rejected row does not reach the measures of later rules."""
    from tidemark.llm.op3_quality_cascade import Rule
    docs = spark.createDataFrame([(1, "few words"), (2, "another few")], "doc_id long, text string")
    first = Rule("first", lambda m: m("n_words") < 20)
    fails = Rule("fails", lambda m: F.raise_error(F.lit("measured")).cast("boolean"))
    import tidemark.llm.op3_quality_cascade as op3
    keep = op3.order_rules
    try:
        op3.order_rules = lambda docs, rules, sample_rows: list(rules)
        assert cascade(docs, (first, fails)).where("rejected_by = 'first'").count() == 2
        with pytest.raises(Exception, match="measured"):
            cascade(docs, (fails, first)).collect()
    finally:
        op3.order_rules = keep


def test_cascade_odd_rows(spark):
    df = odd_frame(spark, CLEAN)
    out = cascade(df, BASE_RULES, measures=("n_words",))
    assert out.count() == df.count() and set(df.columns) < set(out.columns)
    assert out.where("rejected_by is null").count() == 5  # the long text repeats a word
    assert cascade(df.limit(0)).count() == 0


def test_decontamination(spark):
    d = "doc_id long, text string"
    told = "Once a man named {} buys {} apples for {} {} each and then gives {} apples to his friend {} before going home."
    bench = spark.createDataFrame([(7, told.format("Alice", 5, 2, "euros", 5, "Dave")), (8, None), (9, "The quick brown fox jumps!"),
                                   (10, "")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Before. " + told.format("Bob", 12, 3, "dollars", 12, "Carl") + " After."),    # same slots, other values
        (2, told.format("Bob", 12, 3, "dollars", 9, "Carl")),                              # one value became two
        (3, told.format("Alice", 5, 2, "euros", 5, "Dave").upper().lower()),
        (4, "see the quick brown fox jumps over"), (5, CLEAN), (6, None), (11, "")], d)
    got = {(r.doc_id, r.item_id): r.reparameterised for r in contaminated(docs, bench).collect()}
    assert got[1, 7] is True and got[4, 9] is False
    assert all(i != 5 for i, _ in got)
    wide = {r.doc_id: r.covered_tokens for r in contaminated(docs, bench).where("item_id = 7").collect()}
    assert wide[1] == 24 and wide.get(2, 0) < 24
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_of_passages_with_few_literals(spark):
    items = {1: "12 + 7 = 19 and 30 - 4 = 26 , 8 x 3 = 24", 2: "Paris London Rome Berlin Madrid Vienna Lisbon Dublin Athens Oslo",
             3: "Der Hund und die Katze des Nachbarn schlafen im Garten unter dem Baum der Tante",
             4: "Which Planet Is Closest"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = spark.createDataFrame([(1, "so " + items[1]), (2, "visit " + items[2]), (3, "x " + items[3].lower()),
                                  (4, "Q: " + items[4] + " to us"), (5, "X " + items[3].upper()), (6, items[2].lower())],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 3), (6, 2)}


def test_one_inconsistent_value_drops_only_its_windows(spark):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    words[20] = words[150] = "42"
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(words[:150] + ["43"] + words[151:]))], "doc_id long, text string")
    got = contaminated(docs, bench).collect()
    # all but the changed value is covered by windows that are verbatim
    assert [(r.doc_id, r.covered_tokens, r.item_tokens, r.reparameterised) for r in got] == [(1, 199, 200, False)]


def test_decontamination_on_test_data(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    truth = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in r.text}
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == truth


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, CLEAN, 3), (1, CLEAN, 4), (None, None, 5)], "item_id long, text string, key int")
    assert contaminated(odd_frame(spark, CLEAN), bench).count() == 12  # six texts hold it, against two equal items


def test_pseudonyms(spark):
    text = ("mail a.b@x.com at 42.144.35.254, card 4041894974608795 or 4041 8949 7460 8795, call +1 (988) 555-2485; "
            "born 1970-02-28, 28/02/1970, 02/28/1970, 31.12.1999; ssn 123-45-6789")
    bad = "card 4041894974608796 date 99/99/1999 ssn 000-12-3456 version 4.0 at 1.2.3.4.5"
    df = spark.createDataFrame([(1, text), (2, text), (3, bad), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonymise(df, "k").collect()}
    assert got[1].text == got[2].text and got[1].n_replaced == 10
    for value in re.findall(r"\S+@\S+|42\.144\S+|4041\S+|\(988\) \S+|\d+[-/.]\d+[-/.]\d+", text):
        assert value.strip(",;") not in got[1].text
    assert re.sub(r"\S+@\S+", "@", re.sub(r"\d+", "9", got[1].text)) == re.sub(r"\S+@\S+", "@", re.sub(r"\d+", "9", text))
    assert (got[3].text, got[3].n_replaced) == (bad, 0) and got[4].text is None and got[5].text == ""
    plain, spaced = re.search(r"card (\d+) or ([\d ]+),", got[1].text).groups()
    assert plain == spaced.replace(" ", "")
    assert spark.range(1).select(luhn_valid(F.lit(plain)).alias("ok")).first().ok
    other = pseudonymise(df, "another key").where("doc_id = 1").first().text
    assert other != got[1].text
    assert pseudonymise(df.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        pseudonymise(df.withColumn("n_replaced", F.lit(1)), "k")


def test_pseudonyms_beside_other_digits(spark):
    card, amex = "4111 1111 1111 1111", "3782 822463 10005"
    texts = [f"{card} 12/27", f"{card} 123", f"12 {card}", f"12 34 56 {card} 2", f"no.{card.replace(' ', '')}", f"-{card}",
             f"{card} {amex} 7", f"{card} 2024-01-05", f"{card} 3.5", "+44 20 7946 0958", "+442079460958", "+49 30 901820",
             "on 5/3/2021", "on 2021-3-5", "on 5.3.2021", "on 05.03.2021"]
    kept = ["1234 5678 9012 3456 12/27", "0.4111111111111111", "on 39/13/2021", "9" * 20000 + "x", "1 " * 3000]
    df = spark.createDataFrame(list(enumerate(texts + kept)), "doc_id long, text string")
    got = [(r.text, r.n_replaced) for r in pseudonymise(df, "k").orderBy("doc_id").collect()]
    for old, (new, n) in zip(texts, got):
        assert n == 1 + (amex in old) + ("2024-01-05" in old), (old, new, n)
        assert card not in new and "1111111111" not in new and amex not in new and old != new
        if "/2021" not in old and "2021-" not in old and ".2021" not in old:
            assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", old)
    assert got[0][0].endswith(" 12/27") and got[1][0].endswith(" 123") and got[2][0].startswith("12 4")
    assert got[0][0][:19] == got[1][0][:19] == got[2][0][3:] == got[3][0][9:28] == got[6][0][:19]
    assert got[9][0].replace(" ", "") == got[10][0] and got[11][0].startswith("+49 ")
    assert re.sub(r"\b0", "", got[15][0]) == got[14][0]
    assert [x for x in zip(got[len(texts):], kept) if x[0] != (x[1], 0)] == []


def test_feistel_is_a_permutation(spark):
    a, b = F.lit(DATE_A).cast("long"), F.lit(DATE_B).cast("long")
    x = spark.range(DATE_A * DATE_B).select(feistel(F.col("id"), a, b, F.lit("k"), "date").alias("x"))
    r = x.agg(F.countDistinct("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    assert (r.n, r.lo, r.hi) == (DATE_A * DATE_B, 0, DATE_A * DATE_B - 1)


def test_pseudonyms_odd_rows(spark):
    df = odd_frame(spark, "write to me@example.org " + CLEAN)
    out = pseudonymise(df, "k")
    assert out.columns == [*df.columns, "n_replaced"] and out.count() == df.count()
    assert out.where("text like '%me@example.org%'").count() == 0 and out.where("n_replaced = 1").count() == 6


def test_pseudonyms_of_more_formats(spark):
    rows = ["call 415 555 2671 now", "on 2021/03/05, due 2021/3/5.", "2021/13/05 and 123 456 7890 stay", "1415 555 26710 stays",
            "id 12 415 555 2671 stays", "4155552671, 123 45 6789, 5.3.21, Jan 5, 2021 stay"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    got = [r.text for r in pseudonymise(df, "k").orderBy("doc_id").collect()]
    assert re.fullmatch(r"call [2-9]\d\d [2-9]\d\d \d{4} now", got[0]) and got[0] != rows[0]
    dates = re.fullmatch(r"on (\d{4})/(\d\d)/(\d\d), due (\d{4})/(\d{1,2})/(\d{1,2})\.", got[1])
    assert dates and [int(x) for x in dates.groups()[:3]] == [int(x) for x in dates.groups()[3:]] and got[1] != rows[1]
    assert got[2:] == rows[2:]


def independent_feistel(rank, a, b, key, tag, rounds=8):
    """The network written again with Python's hashlib."""
    left, right, ring_l, ring_r = rank // b, rank % b, a, b
    for n in range(1, rounds + 1):
        ring = ring_l
        inner = hashlib.sha256(f"{key}|{tag}|{n}|{right}".encode()).hexdigest()
        outer = hashlib.sha256(f"{key}|{inner}".encode()).hexdigest()
        left, right = right, (left + int(outer[:15], 16) % ring) % ring
        ring_l, ring_r = ring_r, ring_l
    return left * b + right


def test_pseudonyms_equal_an_independent_network(spark):
    ranks = [0, 1, 12345, DATE_A * DATE_B - 1, 777]
    df = spark.createDataFrame([(r,) for r in ranks], "r long")
    a, b = F.lit(DATE_A).cast("long"), F.lit(DATE_B).cast("long")
    got = [x.y for x in df.select(feistel(F.col("r"), a, b, F.lit("k"), "date").alias("y")).collect()]
    assert got == [independent_feistel(r, DATE_A, DATE_B, "k", "date") for r in ranks]
    # a date, an address and a telephone number by hand
    first = dt.date(1800, 1, 1)
    day = dt.date(2021, 3, 5)
    new = first + dt.timedelta(days=independent_feistel((day - first).days, DATE_A, DATE_B, "k", "date"))
    ip = independent_feistel(0x0A000001, 65536, 65536, "k", "ip")
    phone = independent_feistel(((415 - 200) * 800 + 355) * 10000 + 2671, 80_000, 80_000, "k", "phone")
    text = spark.createDataFrame([(1, "2021-03-05 10.0.0.1 415-555-2671")], "doc_id int, text string")
    tel = f"{phone // 8_000_000 + 200}-{phone // 10_000 % 800 + 200}-{phone % 10_000:04d}"
    assert pseudonymise(text, "k").first().text == f"{new} {'.'.join(str(b) for b in ip.to_bytes(4, 'big'))} {tel}"
