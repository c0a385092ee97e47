import datetime as dt
import json
import os

from tidemark.jobs import bronze, gold, quality, silver
from tidemark.jobs.lake import Lake
from tidemark.sources.reference import macro_indicators_table, tickers_table

RUN1 = dt.datetime(2024, 3, 1, 6, 0, 0, tzinfo=dt.timezone.utc)
RUN2 = dt.datetime(2024, 3, 2, 6, 0, 0, tzinfo=dt.timezone.utc)


def _w(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _land(root):
    p = os.path.join(root, "landing", "stooq")
    _w(p, "pko.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,40,41,39,40.5,100\n2024-01-03,40.5,42,40,41.5,200\n")
    _w(p, "pzu.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,50,51,49,50.5,300\nnot-a-date,1,1,1,1,1\n")
    _w(p, "bad.csv", "when,o,h,l,c,v\n2024-01-02,1,1,1,1,1\n")
    f = os.path.join(root, "landing", "nbp")
    _w(f, "usd.json", json.dumps({"table": "A", "currency": "dolar", "code": "USD", "rates": [
        {"no": "1", "effectiveDate": "2024-01-02", "mid": 3.8117}, {"no": "2", "effectiveDate": "2024-01-03",
                                                                     "mid": 3.95}]}))
    g = os.path.join(root, "landing", "gus")
    _w(g, "217230_2023.json", json.dumps({"results": [{"id": "1", "name": "cpi", "values": [
        {"year": "2022", "val": 114.4, "attrId": 1}, {"year": "2023", "val": 106.2, "attrId": 1}]}]}))
    b = os.path.join(root, "landing", "fmp_bs")
    _w(b, "PKO.json", json.dumps([
        {"date": "2023-12-31", "symbol": "PKO.WA", "reportedCurrency": "PLN", "fiscalYear": "2023", "period": "FY",
         "totalAssets": 100, "cashAndEquivalents": 5.5, "goodwill": None},
        {"date": "2023-09-30", "symbol": "PKO.WA", "reportedCurrency": "PLN", "fiscalYear": "2023", "period": "Q3",
         "totalAssets": 90.5, "goodwill": None}]))
    _w(b, "PZU.json", json.dumps({"Error Message": "limit reached"}))


def test_medallion_end_to_end_and_rerun(spark, scratch):
    _land(scratch)
    lake = Lake(os.path.join(scratch, "lake"), partitioned={"silver_prices": ["date"], "fact_prices": ["date"]})
    tickers = tickers_table(spark, [
        {"ticker": "PKO", "stooq_symbol": "pko", "fmp_symbol": "PKO.WA", "company_name": "PKO BP", "currency": "PLN"},
        {"ticker": "PZU", "stooq_symbol": "pzu", "fmp_symbol": None, "company_name": "PZU", "currency": "PLN"}])
    indicators = macro_indicators_table(spark, [("cpi", 217230, "%")])
    for run in (RUN1, RUN2):  # two ingestion runs of the same payloads
        bronze.ingest_prices(spark, lake, os.path.join(scratch, "landing", "stooq"), tickers, run)
        bronze.ingest_fx(spark, lake, os.path.join(scratch, "landing", "nbp"), run)
        bronze.ingest_macro(spark, lake, os.path.join(scratch, "landing", "gus"), indicators, run)
        bronze.ingest_statements(spark, lake, os.path.join(scratch, "landing", "fmp_bs"), "balance_sheet", run)
    assert lake.read_bronze(spark, "bronze_stooq_prices").count() == 8   # 4 rows x 2 runs, bad file excluded
    assert spark.read.parquet(lake.path("bronze_stooq_prices_quarantine")).count() == 2

    for _ in range(2):  # rerunning Silver and Gold is idempotent
        silver.build_silver_prices(spark, lake, tickers)
        silver.build_silver_fx_rates(spark, lake)
        silver.build_silver_fundamentals(spark, lake)
        silver.build_silver_macro(spark, lake)
        gold.build_dim_company(spark, lake, tickers)
        gold.build_dim_date(spark, lake, from_silver=True)
        gold.build_fact_prices(spark, lake)
        gold.build_fact_fundamentals(spark, lake)
        gold.build_fact_macro(spark, lake)
        fp = {(r.ticker, str(r.date)): (r.close, r.currency) for r in lake.read(spark, "fact_prices").collect()}
        assert fp == {("PKO", "2024-01-02"): (40.5, "PLN"), ("PKO", "2024-01-03"): (41.5, "PLN"),
                      ("PZU", "2024-01-02"): (50.5, "PLN")}
        ff = {(str(r.period_end_date), r.metric_name): r.metric_value
              for r in lake.read(spark, "fact_fundamentals").collect()}
        assert ff == {("2023-12-31", "total_assets"): 100.0, ("2023-12-31", "cash_and_equivalents"): 5.5,
                      ("2023-09-30", "total_assets"): 90.5}
        fm = {r.reference_date.year: r.value for r in lake.read(spark, "fact_macro").collect()}
        assert fm == {2022: 114.4, 2023: 106.2}
        assert lake.read(spark, "dim_company").count() == 2

    res = quality.run_reconciliation(spark, lake, raise_on_fail=False)
    failed = {r.check_name for r in res.where("NOT passed").collect()}
    # the bad-date Bronze price row is dropped in Silver; every other check passes
    assert failed == set(), failed
    quality.run_reconciliation(spark, lake)


def test_payload_path_matches_inferred_path(spark, scratch):
    _land(scratch)
    land = os.path.join(scratch, "landing", "fmp_bs")
    wide = Lake(os.path.join(scratch, "lake_wide"))
    pay = Lake(os.path.join(scratch, "lake_payload"))
    for run in (RUN1, RUN2):
        bronze.ingest_statements(spark, wide, land, "balance_sheet", run)
        bronze.ingest_statement_payloads(spark, pay, land, "balance_sheet", run)
    silver.build_silver_fundamentals(spark, wide)
    silver.build_silver_fundamentals_from_payloads(spark, pay)
    a = sorted(tuple(r) for r in wide.read(spark, "silver_fundamentals").collect())
    b = sorted(tuple(r) for r in pay.read(spark, "silver_fundamentals").collect())
    assert a == b and len(a) == 3


def test_cli_runs_a_job(spark, scratch):
    from tidemark.jobs.__main__ import JOBS, parse_args
    _land(scratch)
    ref = os.path.join(scratch, "tickers.json")
    with open(ref, "w") as f:
        json.dump([{"ticker": "PKO", "stooq_symbol": "pko", "fmp_symbol": None, "company_name": "PKO BP",
                    "currency": "PLN"}], f)
    lake_root = os.path.join(scratch, "cli_lake")
    for argv in (["bronze_prices", "--lake", lake_root, "--landing", os.path.join(scratch, "landing", "stooq"),
                  "--tickers", ref, "--run-time", "2024-03-01T06:00:00+00:00"],
                 ["silver_prices", "--lake", lake_root, "--tickers", ref, "--partitioned", "silver_prices=date"]):
        a = parse_args(argv)
        layout = {t: c.split(",") for t, c in (x.split("=", 1) for x in a.partitioned)}
        JOBS[a.job](a, spark, Lake(lake_root, partitioned=layout))
    got = Lake(lake_root, partitioned={"silver_prices": ["date"]}).read(spark, "silver_prices")
    assert got.where("ticker = 'PKO'").count() == 2


def test_kafka_source_needs_connector(spark):
    import pytest
    from tidemark.streaming.prices import kafka_ticks
    with pytest.raises(RuntimeError):
        kafka_ticks(spark, "localhost:9", "trades")


def test_bronze_validation_and_empty_batch(spark, scratch):
    import pytest
    from tidemark.sources.landed import EmptyBatchError
    land = os.path.join(scratch, "land_rules")
    _w(land, "pko.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,40,41,39,40.5,100\n2024-01-03,45,41,39,40,100\n")
    lake = Lake(os.path.join(scratch, "lake_rules"))
    tickers = tickers_table(spark, [("PKO", "pko", None, "PKO BP", "PLN")])
    assert bronze.ingest_prices(spark, lake, land, tickers, RUN1) == 1          # open > high quarantined
    q = spark.read.parquet(lake.path("bronze_stooq_prices_quarantine")).first()
    assert q.reject_reason == "rules: open_le_high"
    empty = os.path.join(scratch, "land_empty")
    _w(empty, "pko.csv", "Date,Open,High,Low,Close,Volume\n")
    with pytest.raises(EmptyBatchError):
        bronze.ingest_prices(spark, lake, empty, tickers, RUN1)


def test_stream_and_batch_feed_silver_with_precedence(spark, scratch):
    from tidemark.jobs.silver import start_silver_prices_stream
    from tidemark.streaming.prices import file_stream, ticks_from_events
    _land(scratch)
    lake = Lake(os.path.join(scratch, "lake_sp"))
    tickers = tickers_table(spark, [("PKO", "pko", None, "PKO BP", "PLN"), ("T1", None, None, "t1", "USD")])
    bronze.ingest_prices(spark, lake, os.path.join(scratch, "landing", "stooq"), tickers, RUN1)
    silver.build_silver_prices(spark, lake, tickers)
    # a tick stream for ticker T1 on 2024-01-02 and PKO (which batch also has) on 2024-01-02
    land = os.path.join(scratch, "ticks")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 10), 1, "click", 7.0, '{"k": 5}')], schema) \
        .write.parquet(land)
    ticks = ticks_from_events(file_stream(spark, land, spark.createDataFrame([], schema).schema))
    start_silver_prices_stream(spark, lake, ticks, tickers, os.path.join(scratch, "cp_sp"), available_now=True,
                               state_partitions=2).awaitTermination()
    got = {(r.ticker, str(r.date)): (r.close, r.source_priority) for r in lake.read(spark, "silver_prices").collect()}
    assert got[("T1", "2024-01-02")] == (7.0, 2)
    assert got[("PKO", "2024-01-02")] == (40.5, 1)
    silver.build_silver_prices(spark, lake, tickers)          # a batch rerun keeps the streamed row
    again = {(r.ticker, str(r.date)): r.source_priority for r in lake.read(spark, "silver_prices").collect()}
    assert again[("T1", "2024-01-02")] == 2


def test_request_plans(spark):
    from tidemark.sources.reference import currencies_table
    cur = currencies_table(spark, [("USD", "dolar"), ("EUR", "euro")])
    fx = bronze.fx_request_plan(cur, "2022-03-01", "2023-07-15")
    assert fx.count() == 4 and {str(r.chunk_end) for r in fx.collect()} == {"2023-03-02", "2023-07-15"}
    ind = macro_indicators_table(spark, [("cpi", 217230, "%"), ("gdp", 1, "PLN")])
    assert bronze.macro_request_plan(ind, 2015, 2024).count() == 20
    tk = tickers_table(spark, [("PKO", "pko", "PKO.WA", "PKO BP", "PLN"), ("X", "x", None, "X", "PLN")])
    assert bronze.statement_request_plan(tk).count() == 3


def test_cli_full_medallion(spark, scratch):
    from tidemark.jobs.__main__ import JOBS, parse_args
    _land(scratch)
    L = os.path.join(scratch, "landing")
    tick = os.path.join(scratch, "tickers.csv")
    with open(tick, "w") as f:
        f.write("ticker,stooq_symbol,fmp_symbol,company_name,currency\nPKO,pko,PKO.WA,PKO BP,PLN\nPZU,pzu,,PZU,PLN\n")
    ind = os.path.join(scratch, "indicators.csv")
    with open(ind, "w") as f:
        f.write("name,gus_variable_id,unit\ncpi,217230,%\n")
    root = os.path.join(scratch, "cli_full")
    run = ["--run-time", "2024-03-01T06:00:00+00:00"]
    steps = [
        ["bronze_prices", "--landing", f"{L}/stooq", "--tickers", tick, *run],
        ["bronze_fx_rates", "--landing", f"{L}/nbp", *run],
        ["bronze_macro", "--landing", f"{L}/gus", "--indicators", ind, *run],
        ["bronze_statements", "--landing", f"{L}/fmp_bs", "--statement-type", "balance_sheet", *run],
        ["silver_prices", "--tickers", tick], ["silver_fx_rates"], ["silver_fundamentals"], ["silver_macro"],
        ["gold_dim_company", "--tickers", tick], ["gold_dim_date", "--from-silver", "--exclude-holidays"],
        ["gold_fact_prices"], ["gold_fact_fundamentals"], ["gold_fact_macro"], ["quality_reconciliation"],
        ["maintenance_compact_bronze", "--table", "bronze_stooq_prices"],
        ["maintenance_vacuum", "--table", "silver_prices", "--keep", "1"],
    ]
    for argv in steps:
        a = parse_args([argv[0], "--lake", root, *argv[1:]])
        JOBS[a.job](a, spark, Lake(root))
    lake = Lake(root)
    assert lake.read(spark, "fact_prices").count() == 3
    assert lake.read(spark, "dim_date").where("date = '2024-01-01'").first().is_trading_day_gpw is False
    assert lake.read_bronze(spark, "bronze_stooq_prices").count() == 4


def test_cli_stream_silver_prices(spark, scratch):
    from tidemark.jobs.__main__ import JOBS, parse_args
    ticks = os.path.join(scratch, "ticks_json")
    _w(ticks, "t1.json", '{"ticker": "PKO", "ts": "2024-01-02T09:00:00Z", "price": 40.0, "qty": 5}\n'
                         '{"ticker": "PKO", "ts": "2024-01-02T15:00:00Z", "price": 41.5, "qty": 7}\n')
    tick = os.path.join(scratch, "tk.json")
    with open(tick, "w") as f:
        json.dump([{"ticker": "PKO", "stooq_symbol": "pko", "fmp_symbol": None, "company_name": "PKO", "currency": "PLN"}], f)
    root = os.path.join(scratch, "cli_stream")
    a = parse_args(["stream_silver_prices", "--lake", root, "--landing", ticks, "--tickers", tick, "--checkpoint",
                    os.path.join(scratch, "cp_cli"), "--available-now", "--state-partitions", "2"])
    JOBS[a.job](a, spark, Lake(root))
    r = Lake(root).read(spark, "silver_prices").first()
    assert (r.ticker, str(r.date), r.open, r.close, r.volume, r.source_priority) == ("PKO", "2024-01-02", 40.0, 41.5, 12, 2)


def test_incremental_silver_since(spark, scratch):
    lake = Lake(os.path.join(scratch, "lake_inc"))
    tickers = tickers_table(spark, [("PKO", "pko", None, "PKO BP", "PLN")])
    schema = "ticker string, date string, open double, high double, low double, close double, volume long, " \
             "source string, retrieved_at timestamp"
    day1 = dt.datetime(2024, 3, 1, 6)
    day2 = dt.datetime(2024, 3, 2, 6)
    lake.append_bronze(spark.createDataFrame([("PKO", "2024-01-02", 1.0, 2.0, 0.5, 10.0, 1, "stooq", day1),
                                              ("PKO", "2024-01-03", 1.0, 2.0, 0.5, 11.0, 1, "stooq", day1)], schema),
                       "bronze_stooq_prices")
    silver.build_silver_prices(spark, lake, tickers)
    lake.append_bronze(spark.createDataFrame([("PKO", "2024-01-03", 1.0, 2.0, 0.5, 12.0, 1, "stooq", day2)], schema),
                       "bronze_stooq_prices")
    silver.build_silver_prices(spark, lake, tickers, since="2024-03-02")   # only the new retrieval day is read
    got = {str(r.date): r.close for r in lake.read(spark, "silver_prices").collect()}
    assert got == {"2024-01-02": 10.0, "2024-01-03": 12.0}
    # a late-landing older retrieval cannot roll the row back (newer wins)
    lake.append_bronze(spark.createDataFrame([("PKO", "2024-01-03", 1.0, 2.0, 0.5, 99.0, 1, "stooq",
                                               dt.datetime(2024, 3, 1, 5))], schema), "bronze_stooq_prices")
    silver.build_silver_prices(spark, lake, tickers, since="2024-03-01")
    got = {str(r.date): r.close for r in lake.read(spark, "silver_prices").collect()}
    assert got == {"2024-01-02": 10.0, "2024-01-03": 12.0}
