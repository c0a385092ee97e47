"""Property tests: operators against brute-force Python on generated inputs,
including a hot key holding a large share of the rows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.dedup import keep_latest
from tidemark.operators.joins import asof_join

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

key = st.sampled_from(["hot", "hot", "hot", "a", "b", None])
row = st.tuples(key, st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(-3, 3))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=60))
def test_keep_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, ts int, v int")
    got = [tuple(r) for r in keep_latest(df, ["k", "d"], order=["ts"]).collect()]

    def sort_key(r):  # ts desc nulls last, then v desc
        return (r[2] is not None, r[2] if r[2] is not None else 0, r[3])
    best = {}
    for r in rows:
        g = (r[0], r[1])
        if g not in best or sort_key(r) > sort_key(best[g]):
            best[g] = r
    assert sorted(map(repr, got)) == sorted(map(repr, best.values()))


day = st.integers(0, 40)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["USD", "EUR"]), day, st.floats(0.5, 5, allow_nan=False)),
                max_size=25, unique_by=lambda x: (x[0], x[1])),
       st.lists(st.tuples(st.sampled_from(["USD", "EUR", "CHF"]), day), min_size=1, max_size=40))
def test_asof_matches_brute_force(spark, rates, facts):
    base = dt.date(2024, 1, 1)
    r = spark.createDataFrame([(c, base + dt.timedelta(days=d), v) for c, d, v in rates],
                              "c string, d date, rate double")
    f = spark.createDataFrame([(i, c, base + dt.timedelta(days=d)) for i, (c, d) in enumerate(facts)],
                              "id int, c string, d date")
    got = {x.id: x.rate for x in asof_join(f, r, ["c"], "d", "d", ["rate"]).collect()}
    assert len(got) == len(facts)
    for i, (c, d) in enumerate(facts):
        cands = [(rd, v) for rc, rd, v in rates if rc == c and rd <= d]
        assert got[i] == (max(cands)[1] if cands else None)


@SETTINGS
@given(st.integers(0, 2000), st.integers(-5, 1500), st.integers(1, 400))
def test_chunks_tile_the_range(spark, start_off, span, max_days):
    from tidemark.operators.calendar import chunk_date_range
    start = dt.date(2020, 1, 1) + dt.timedelta(days=start_off)
    end = start + dt.timedelta(days=span)
    rows = sorted((r.chunk_start, r.chunk_end) for r in chunk_date_range(spark, start, end, max_days).collect())
    if span < 0:
        assert rows == []
        return
    assert rows[0][0] == start and rows[-1][1] == end
    for (s1, e1), (s2, _) in zip(rows, rows[1:]):
        assert s2 == e1 + dt.timedelta(days=1)
    assert all(s <= e and (e - s).days < max_days for s, e in rows)


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ019_", min_size=0, max_size=12), min_size=1, max_size=20))
def test_camel_to_snake_matches_python_re(spark, names):
    import re

    from pyspark.sql import functions as F

    from tidemark.functions.columns import camel_to_snake
    from tidemark.schemas import CAMEL_PASS_1, CAMEL_PASS_2

    def py(name):  # the same fixed patterns through Python's re ($1 -> \1)
        s = re.sub(CAMEL_PASS_1[0], CAMEL_PASS_1[1].replace("$", "\\"), name)
        return re.sub(CAMEL_PASS_2[0], CAMEL_PASS_2[1].replace("$", "\\"), s).lower()
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.s for r in df.select(camel_to_snake(F.col("n")).alias("s")).collect()]
    assert got == [py(n) for n in names]


cell = st.one_of(st.none(), st.integers(-1000, 1000).map(str), st.floats(-1e6, 1e6, allow_nan=False).map(repr),
                 st.sampled_from(["abc", "", " 7 ", "1e3", "NaN-ish"]))


@SETTINGS
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=20))
def test_unpivot_numeric_matches_brute_force(spark, rows):
    from tidemark.operators.reshape import unpivot_numeric
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, totalAssets string, netIncome string, "
                                                                      "cashFlow string")
    got = sorted((r.id, r.metric_name, r.metric_value) for r in
                 unpivot_numeric(df, ["id"], ["totalAssets", "netIncome", "cashFlow"]).collect())
    # brute force: the values Spark's own try_cast gives, one cell at a time
    names = {"totalAssets": "total_assets", "netIncome": "net_income", "cashFlow": "cash_flow"}
    expect = []
    for i, r in enumerate(rows):
        for col, v in zip(names, r):
            if v is None:
                continue
            x = spark.sql("SELECT try_cast(:v AS double) AS x", args={"v": v}).first().x
            if x is not None:
                expect.append((i, names[col], x))
    assert got == sorted(expect)


batch = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 99)), max_size=8,
                 unique_by=lambda r: r[0] if r[0] is not None else object())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(batch, min_size=1, max_size=4))
def test_upsert_sequence_matches_dict_model(spark, batches):
    import os
    import uuid

    from tidemark.session import local_path, work_dir
    from tidemark.sinks.upsert import read_current, table_exists, upsert
    path = os.path.join(local_path(work_dir(spark, "prop")), uuid.uuid4().hex)
    model: dict = {}
    nulls: list = []
    for b in batches:
        if not b and not table_exists(spark, path):
            continue
        upsert(spark, spark.createDataFrame(b, "k int, v int"), path, ["k"])
        for k, v in b:
            if k is None:
                nulls.append(v)          # a null key never matches: every one is inserted
            else:
                model[k] = v             # matched -> updated, else inserted
    if not table_exists(spark, path):
        return
    got = [tuple(r) for r in read_current(spark, path).collect()]
    assert sorted(v for k, v in got if k is None) == sorted(nulls)
    assert sorted((k, v) for k, v in got if k is not None) == sorted(model.items())
