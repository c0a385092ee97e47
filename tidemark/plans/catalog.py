"""The registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dedup, gold, reshape, standardize
from tidemark.operators.calendar import date_dimension_from
from tidemark.operators.joins import add_currency_column
from tidemark.plans import derive as d

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- prices: dedup -> standardize -> lookup -> gold --------------------------------

@query
def dedup_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Latest retrieval per (ticker, date) of the event-derived Bronze prices."""
    return dedup.dedup_prices(d.bronze_prices(spark, sf))


@query
def standardize_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Text dates parsed, unparseable rows dropped."""
    return standardize.standardize_prices(d.bronze_prices(spark, sf))


@query
def lookup_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Prices labelled with the listing currency; unknown tickers keep a null."""
    p = standardize.standardize_prices(d.bronze_prices(spark, sf)).select("ticker", "date", "close")
    return add_currency_column(p, d.tickers(spark, sf))


def silver_prices(spark: SparkSession, sf: str) -> DataFrame:
    deduped = dedup.dedup_prices(d.bronze_prices(spark, sf))
    return add_currency_column(standardize.standardize_prices(deduped), d.tickers(spark, sf))


@query
def fact_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The full prices chain (dedup, parse, label) projected to the Gold contract."""
    return gold.build_fact_prices(silver_prices(spark, sf))


@query
def fact_prices_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: Gold prices star-joined to the calendar dimension (default
    bounds 2000-01-01..2035-12-31), monthly close statistics per listing
    currency and day type. Facts outside the calendar keep their month."""
    from tidemark.operators.calendar import date_dimension
    facts = fact_prices(spark, sf)
    cal = date_dimension(spark)
    m = gold.monthly_by_day_type(facts.withColumn("close_dec", F.col("close").cast("decimal(18,2)")),
                                 cal, "date", "close_dec", extra_keys=["currency"])
    return m.select("currency", "year", "month", "is_trading_day_gpw", "n_rows",
                    F.col("sum_value").cast("decimal(38,2)").alias("sum_close"))


# ---- fx --------------------------------------------------------------------------------

@query
def dedup_fx_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Latest retrieval per (currency_code, effective_date)."""
    return dedup.dedup_fx_rates(d.bronze_fx(spark, sf))


@query
def standardize_fx_rates(spark: SparkSession, sf: str) -> DataFrame:
    """A35 + A20: deduplicated FX rates with parsed dates."""
    return standardize.standardize_fx_rates(dedup.dedup_fx_rates(d.bronze_fx(spark, sf)))


# ---- macro -----------------------------------------------------------------------------

@query
def dedup_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Latest retrieval per (indicator_name, year); order dates tie, other columns break ties."""
    return dedup.dedup_macro(d.bronze_macro(spark, sf))


@query
def standardize_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Country and year-end reference date added."""
    return standardize.standardize_macro(dedup.dedup_macro(d.bronze_macro(spark, sf)))


@query
def fact_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Silver macro projected to the Gold contract."""
    return gold.build_fact_macro(standardize_macro(spark, sf))


# ---- fundamentals ------------------------------------------------------------------------

@query
def dedup_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    """Latest retrieval per (ticker, date, period, statement_type)."""
    return dedup.dedup_fundamentals(d.bronze_fundamentals(spark, sf))


@query
def standardize_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed period end and period_type."""
    return standardize.standardize_fundamentals(dedup.dedup_fundamentals(d.bronze_fundamentals(spark, sf)))


@query
def unpivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Wide statements to long metrics; text metrics drop."""
    return reshape.unpivot_statement_metrics(d.statements_from_part(spark, sf))


@query
def fact_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    """Long metrics projected to the Gold contract."""
    return gold.build_fact_fundamentals(unpivot_metrics(spark, sf))


@query
def silver_fundamentals_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Full Silver fundamentals chain over lineitem statements."""
    return reshape.unpivot_statement_metrics(standardize_fundamentals(spark, sf))


@query
def variant_statements_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The Silver fundamentals chain through schema-free payload Bronze:
    lineitem statements landed as JSON-array bodies, exploded to one payload
    per record, deduplicated at statement grain, typed, then unpivoted from
    VARIANT. Same result as ``silver_fundamentals_lineitem``."""
    from tidemark.sources.landed import statement_record_maps
    b = d.bronze_fundamentals(spark, sf)
    env = ["ticker", "statement_type", "source", "retrieved_at"]
    rec = b.select(*env, F.to_json(F.array(F.struct(*[c for c in b.columns if c not in env]))).alias("body"))
    bronze = statement_record_maps(rec, "body", keep=env)
    field = lambda n: F.col("payload")[n]
    typed = bronze.withColumns({n: field(n) for n in ("date", "period", "fiscalYear", "reportedCurrency")})
    # ties on retrieved_at are broken field by field, as the wide path does
    fields = {"orderKey": "bigint", "suppKey": "bigint", "lineNumber": "int", "quantity": "double",
              "extendedPrice": "double", "discount": "double", "tax": "double"}
    typed = typed.withColumns({f"__tb_{n}": field(n).try_cast(t) for n, t in fields.items()})
    # a field is carried once: typed where its text is the value's, in the map otherwise
    typed = typed.withColumn("payload", reshape.without_typed(F.col("payload"), {n: F.col(f"__tb_{n}") for n in fields}))
    latest = dedup.keep_latest(typed.drop("record_pos"), ["ticker", "date", "period", "statement_type"],
                               tie_break=["fiscalYear", "reportedCurrency", "source", *[f"__tb_{n}" for n in fields]])
    latest = latest.withColumn("payload", reshape.with_typed(F.col("payload"), {n: F.col(f"__tb_{n}") for n in fields}))
    latest = latest.drop(*[f"__tb_{n}" for n in fields])
    return reshape.statements_from_map(standardize.standardize_fundamentals(latest))


@query
def variant_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A25 through VARIANT: the same metrics from a JSON payload."""
    s = d.statements_from_part(spark, sf)
    ids = ["ticker", "period_end_date", "statement_type", "period_type", "fiscal_year",
           "reported_currency", "source", "retrieved_at"]
    base = s.select("ticker", F.col("date").alias("period_end_date"), "statement_type", "period_type",
                    F.col("fiscalYear").try_cast("int").alias("fiscal_year"),
                    F.col("reportedCurrency").alias("reported_currency"), "source", "retrieved_at",
                    F.to_json(F.struct("partSize", "retailPrice", "brandName")).alias("payload"))
    out = reshape.variant_metrics(base, ids, "payload")
    return out.select(*ids, "metric_name", "metric_value")


@query
def snake_case_keys(spark: SparkSession, sf: str) -> DataFrame:
    """camelCase names built from part names, converted to snake_case."""
    from tidemark.functions.columns import camel_to_snake
    p = d.table(spark, sf, "part")
    words = F.split("p_name", " ")
    cap = lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    first, rest = words[0], F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    names = F.array(F.concat(first, F.array_join(F.transform(rest, cap), "")), F.concat(F.col("p_type"), cap(first)),
                    F.concat(F.lit("eps"), F.lower(F.array_join(rest, ""))))
    e = p.select("p_partkey", F.posexplode(names).alias("pos", "raw_name"))
    return e.select("p_partkey", F.col("pos").cast("int").alias("pos"), "raw_name",
                    camel_to_snake(F.col("raw_name")).alias("snake_name"))


# ---- unions ----------------------------------------------------------------------------

@query
def union_statements(spark: SparkSession, sf: str) -> DataFrame:
    """A19 + A39: three inputs stamped with a statement type, unioned with missing columns null."""
    c = d.table(spark, sf, "customer").withColumn("statement_type", F.lit("balance_sheet"))
    s = d.table(spark, sf, "supplier").withColumn("statement_type", F.lit("income_statement"))
    p = d.table(spark, sf, "part").withColumn("statement_type", F.lit("cash_flow"))
    return c.unionByName(s, allowMissingColumns=True).unionByName(p, allowMissingColumns=True)


@query
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two slices with permuted columns unioned by name back to the table."""
    ev = d.table(spark, sf, "events")
    first = F.col("event_type").isin("click", "view")
    a = ev.where(first)
    b = ev.where(~first | F.col("event_type").isNull()).select(*reversed(ev.columns))
    return a.unionByName(b)


# ---- sources: landed payloads ----------------------------------------------------------

@query
def csv_price_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitems landed as OHLCV CSV lines, parsed back on executors."""
    from tidemark.sources.landed import price_rows_from_csv_lines, split_corrupt, to_bronze_prices
    li = d.table(spark, sf, "lineitem")
    px = F.col("l_extendedprice")
    line = F.concat_ws(",", F.date_format("l_shipdate", "yyyy-MM-dd"), px.cast("string"),
                       (px * (F.lit(1.0) + F.col("l_tax"))).cast("string"),
                       (px * (F.lit(1.0) - F.col("l_discount"))).cast("string"), px.cast("string"),
                       F.col("l_quantity").cast("bigint").cast("string"))
    landed = li.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"), line.alias("line"))
    rows = price_rows_from_csv_lines(landed, "line", "ticker", "stooq", F.to_timestamp_ntz(F.lit(d.RUN1_AT)))
    clean, _ = split_corrupt(rows)
    return to_bronze_prices(clean)


@query
def csv_header_check(spark: SparkSession, sf: str) -> DataFrame:
    """The first line of every landed price file against the contract's header."""
    from tidemark.session import fresh_dir
    from tidemark.sources.landed import csv_header_status, file_stem, first_lines
    landing = d.land_price_csv(spark, sf, fresh_dir(spark, "landing", "prices"))
    return csv_header_status(first_lines(spark, landing)).select(
        file_stem(F.col("file_path")).alias("symbol"), "first_line", "header_ok")


def _ingested_prices(spark: SparkSession, sf: str):
    from tidemark.jobs.bronze import ingest_prices
    from tidemark.jobs.lake import Lake
    from tidemark.session import fresh_dir
    base = fresh_dir(spark, "landing", "prices")
    lake = Lake(f"{base}/lake")
    ingest_prices(spark, lake, d.land_price_csv(spark, sf, base), d.symbol_map(spark, sf),
                  F.to_timestamp_ntz(F.lit(d.RUN1_AT)))
    return lake


@query
def csv_files_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The Bronze job over landed CSV files with wrong headers, blank lines, blank
    dates, cut rows, broken rules and unknown symbols; the accepted rows."""
    return _ingested_prices(spark, sf).read_bronze(spark, "bronze_stooq_prices")


@query
def bronze_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What the same job accepts and quarantines, by reason; together all landed rows."""
    from tidemark.sinks.tables import read_appended
    lake = _ingested_prices(spark, sf)
    bad = read_appended(spark, lake.path("bronze_stooq_prices_quarantine"))
    return (bad.select(F.split_part("reject_reason", F.lit(":"), F.lit(1)).alias("outcome"))
            .unionByName(lake.read_bronze(spark, "bronze_stooq_prices").select(F.lit("accepted").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows")))


@query
def payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Shape guards over landed bodies: pages and documents as CSV bodies,
    event props and conversation turns as JSON-array bodies."""
    from tidemark.sources.landed import classify_payload
    pages = d.table(spark, sf, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("item_id"),
                                               classify_payload(F.col("html"), "csv").alias("payload_status"))
    docs = d.table(spark, sf, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("item_id"),
                                                  classify_payload(F.col("text"), "csv").alias("payload_status"))
    ev = d.table(spark, sf, "events").select(F.lit("events").alias("origin"), F.col("event_id").alias("item_id"),
                                             classify_payload(F.col("props"), "json_array").alias("payload_status"))
    conv = d.table(spark, sf, "conversations").select(
        F.lit("conversations").alias("origin"), (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
        classify_payload(F.col("text"), "json_array").alias("payload_status"))
    return pages.unionByName(docs).unionByName(ev).unionByName(conv)


@query
def json_explode_rates(spark: SparkSession, sf: str) -> DataFrame:
    """FX bodies ``{table, currency, code, rates[]}`` built per event, parsed and exploded."""
    from tidemark.sources.landed import fx_rows_from_json
    ev = d.table(spark, sf, "events")
    day = F.to_date("ts")
    rates = F.array(
        F.struct(F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("no"),
                 F.date_format(day, "yyyy-MM-dd").alias("effectiveDate"), F.col("value").alias("mid")),
        F.struct(F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("no"),
                 F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("effectiveDate"),
                 (F.col("value") + F.lit(0.5)).alias("mid")))
    body = F.to_json(F.struct(F.lit("A").alias("table"), F.col("event_type").alias("currency"),
                              F.upper("event_type").alias("code"), rates.alias("rates")))
    return fx_rows_from_json(ev.select(body.alias("body")), "body", "nbp", F.to_timestamp_ntz(F.lit(d.RUN1_AT)))


@query
def json_nested_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Macro bodies ``{results[].values[]}`` per order; pending orders land a
    body without ``results`` (no rows), the second value is null (kept)."""
    from tidemark.sources.landed import macro_rows_from_json
    o = d.table(spark, sf, "orders")
    y = F.year("o_orderdate")
    values = F.array(F.struct(y.cast("string").alias("year"), F.col("o_totalprice").alias("val")),
                     F.struct((y + 1).cast("string").alias("year"), F.lit(None).cast("double").alias("val")))
    body = F.when(F.col("o_orderstatus") == "P", F.to_json(F.struct(F.lit(1).alias("total"))))
    body = body.otherwise(F.to_json(F.struct(F.array(F.struct(
        F.col("o_orderpriority").alias("id"), F.col("o_orderstatus").alias("name"),
        values.alias("values"))).alias("results"))))
    landed = o.select(F.concat(F.lit("ind_"), F.col("o_orderpriority")).alias("indicator_name"),
                      F.col("o_custkey").cast("int").alias("variable_id"), F.lit("%").alias("unit"), body.alias("body"))
    return macro_rows_from_json(landed, "body", F.col("indicator_name"), F.col("variable_id"), F.col("unit"),
                                "gus", F.to_timestamp_ntz(F.lit(d.RUN1_AT)))


@query
def json_schema_union(spark: SparkSession, sf: str) -> DataFrame:
    """Statement-like JSON records landed as files; the reader infers the
    field union (absent = null, all-null = string, int + float = double)."""
    from tidemark.session import fresh_dir
    from tidemark.sources.landed import read_statement_json
    path = fresh_dir(spark, "landing", "statements")
    d.statement_payload(d.table(spark, sf, "events")).select("payload").write.text(path)
    return read_statement_json(spark, path)


# ---- generated tables ------------------------------------------------------------------

@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar over the order-date range."""
    return date_dimension_from(d.table(spark, sf, "orders"), "o_orderdate", pad_months=0)


@query
def dim_date_from_data(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar over the ship-date range padded by one year on each side."""
    return date_dimension_from(d.table(spark, sf, "lineitem"), "l_shipdate", pad_months=12)


@query
def trading_day_holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Order-date calendar whose trading-day flag also excludes public holidays."""
    from tidemark.operators.calendar import holiday_table, with_holidays
    cal = dim_date(spark, sf)
    return with_holidays(cal, holiday_table(cal))


@query
def backfill_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Per order priority, its order-date range in request chunks of <= 367 days."""
    from tidemark.operators.calendar import chunk_ranges
    o = d.table(spark, sf, "orders")
    r = o.groupBy("o_orderpriority").agg(F.to_date(F.min("o_orderdate")).alias("range_start"),
                                         F.to_date(F.max("o_orderdate")).alias("range_end"))
    return chunk_ranges(r, "range_start", "range_end")


@query
def backfill_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Per region, every year between its customers' first and last order."""
    from tidemark.operators.calendar import year_grid
    o = d.table(spark, sf, "orders")
    per_cust = o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("y0"),
                                          F.max(F.year("o_orderdate")).alias("y1"))
    c = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    geo = d.table(spark, sf, "nation").join(d.table(spark, sf, "region"),
                                            F.col("n_regionkey") == F.col("r_regionkey"))
    geo = geo.select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    j = per_cust.join(c, "o_custkey").join(geo, "c_nationkey")
    r = j.groupBy("r_name").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return year_grid(r, F.col("y0"), F.col("y1")).select("r_name", "year")


@query
def dim_company(spark: SparkSession, sf: str) -> DataFrame:
    """Company dimension from supplier reference rows (nation = listing currency)."""
    from tidemark.operators.joins import lookup_left_join
    s = d.table(spark, sf, "supplier")
    n = d.table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    t = lookup_left_join(s, n, "s_nationkey").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
        F.lit(None).cast("string").alias("stooq_symbol"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("F"), F.col("s_suppkey").cast("string"))).alias("fmp_symbol"),
        F.col("s_name").alias("company_name"), F.col("n_name").alias("currency"))
    return gold.build_dim_company(t)


# ---- sinks -------------------------------------------------------------------------------

def _bronze_run(spark, sf, at):
    from tidemark.functions.columns import provenance
    return provenance(d.bronze_prices(spark, sf), "stooq", F.to_timestamp_ntz(F.lit(at)))


@query
def bronze_append_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingestion runs appended to one Bronze table, read back."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.tables import append, read_appended
    path = fresh_dir(spark, "tables", "bronze_prices")
    append(_bronze_run(spark, sf, d.RUN1_AT), path)
    append(_bronze_run(spark, sf, d.RUN2_AT), path)
    return read_appended(spark, path)


@query
def append_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """The second append adds a column; older rows read it as null."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.tables import append, read_appended
    path = fresh_dir(spark, "tables", "bronze_prices_evolving")
    append(_bronze_run(spark, sf, d.RUN1_AT), path)
    append(_bronze_run(spark, sf, d.RUN2_AT).withColumn("adj_close", F.col("close") * F.lit(0.5)), path)
    return read_appended(spark, path, merge_schema=True)


def _upsert_sides(spark, sf):
    ev = d.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    target = ev.where(F.col("event_type") != "purchase")
    source = ev.where(F.col("event_type").isin("purchase", "click")).withColumn("value", F.col("value") + F.lit(1.0))
    return target, source


@query
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Create on first run, then merge: clicks are updated, purchases inserted."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_current, upsert
    path = fresh_dir(spark, "tables", "silver_events")
    target, source = _upsert_sides(spark, sf)
    upsert(spark, target, path, ["event_id"])
    upsert(spark, source, path, ["event_id"])
    return read_current(spark, path)


@query
def upsert_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Rerunning the same merge leaves the table unchanged."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_current, upsert
    path = fresh_dir(spark, "tables", "silver_events")
    target, source = _upsert_sides(spark, sf)
    upsert(spark, target, path, ["event_id"])
    upsert(spark, source, path, ["event_id"])
    upsert(spark, source, path, ["event_id"])
    return read_current(spark, path)


@query
def upsert_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Partition-scoped upsert (table partitioned by event day): only the
    days the source touches are rewritten."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_partitioned, upsert_partitions
    path = fresh_dir(spark, "tables", "silver_events_by_day")
    target, source = _upsert_sides(spark, sf)
    day = F.to_date("ts")
    upsert_partitions(spark, target.withColumn("day", day), path, ["event_id", "day"], ["day"])
    upsert_partitions(spark, source.withColumn("day", day), path, ["event_id", "day"], ["day"])
    return read_partitioned(spark, path)


@query
def upsert_many_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """An increment that touches every day of the order history (over a
    thousand partitions): finished orders are updated, pending ones inserted."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_partitioned, upsert_partitions
    path = fresh_dir(spark, "tables", "orders_by_day")
    o = d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                            F.to_date("o_orderdate").alias("day"))
    upsert_partitions(spark, o.where(F.col("o_orderstatus") != "P"), path, ["o_orderkey", "day"], ["day"])
    more = o.where(F.col("o_orderstatus") != "O").withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    upsert_partitions(spark, more, path, ["o_orderkey", "day"], ["day"])
    return read_partitioned(spark, path)


@query
def compact_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, the second with one more column, compacted in place."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.tables import append, read_appended
    from tidemark.sinks.upsert import compact_partitions
    path = fresh_dir(spark, "tables", "bronze_compacted")
    day = F.to_date("retrieved_at")
    append(_bronze_run(spark, sf, d.RUN1_AT).withColumn("day", day), path, ["day"])
    append(_bronze_run(spark, sf, d.RUN2_AT).withColumn("adj_close", F.col("close") * F.lit(0.5)).withColumn("day", day),
           path, ["day"])
    compact_partitions(spark, path, ["day"])
    return read_appended(spark, path).drop("day")


@query
def append_type_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A metric that one run infers as whole numbers and the next as fractions,
    and one that is empty at first, stay readable in one table."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.tables import append, read_appended
    path = fresh_dir(spark, "tables", "bronze_drift")
    o = d.table(spark, sf, "orders")
    metrics = ["revenue", "margin"]
    append(o.select("o_orderkey", F.col("o_custkey").alias("revenue"), F.lit(1).alias("run")), path,
           numbers_as_double=metrics)
    append(o.select("o_orderkey", F.col("o_totalprice").alias("revenue"), F.lit(2).alias("run"),
                    F.col("o_custkey").alias("margin")), path, numbers_as_double=metrics)
    append(o.select("o_orderkey", F.lit(None).cast("string").alias("revenue"), F.lit(3).alias("run"),
                    (F.col("o_totalprice") / 2).alias("margin")), path, numbers_as_double=metrics)
    return read_appended(spark, path)


# ---- reconciliation --------------------------------------------------------------------

def _price_layers(spark, sf):
    bronze = d.bronze_prices(spark, sf)
    silver = silver_prices(spark, sf)
    return bronze, silver, gold.build_fact_prices(silver)


@query
def recon_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze-Silver (loose) and Silver-Gold (exact) row counts."""
    from tidemark.operators.quality import compare_row_counts
    b, s, g = _price_layers(spark, sf)
    return compare_row_counts(b, s, exact=False, name="prices_bronze_silver_count").unionByName(
        compare_row_counts(s, g, exact=True, name="prices_silver_gold_count"))


@query
def recon_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Date ranges compared across layers after casting to the target type."""
    from tidemark.operators.quality import compare_range
    b, s, g = _price_layers(spark, sf)
    return compare_range(b, s, "date", "date", "prices_bronze_silver_date_range").unionByName(
        compare_range(s, g, "date", "date", "prices_silver_gold_date_range"))


@query
def recon_summary(spark: SparkSession, sf: str) -> DataFrame:
    """all_passed and the failed check names in check order."""
    from tidemark.operators.quality import summarize
    r = recon_counts(spark, sf).withColumn("ordinal", F.lit(0)).unionByName(
        recon_ranges(spark, sf).withColumn("ordinal", F.lit(1)))
    return summarize(r)


def suite_checks():
    from tidemark.operators.quality import Check
    return [
        Check("prices_bronze_silver_count", "count_loose", "bronze_prices", "silver_prices"),
        Check("prices_bronze_silver_date_range", "range", "bronze_prices", "silver_prices", "date", "date"),
        Check("prices_silver_gold_count", "count_exact", "silver_prices", "fact_prices"),
        Check("prices_silver_gold_date_range", "range", "silver_prices", "fact_prices", "date", "date"),
        Check("fx_bronze_silver_count", "count_loose", "bronze_fx", "silver_fx"),
        Check("fx_bronze_silver_date_range", "range", "bronze_fx", "silver_fx", "effective_date", "effective_date"),
        Check("macro_bronze_silver_count", "count_loose", "bronze_macro", "silver_macro"),
        Check("macro_bronze_silver_year_range", "range", "bronze_macro", "silver_macro", "year", "year"),
        Check("macro_silver_gold_count", "count_exact", "silver_macro", "fact_macro"),
        Check("macro_silver_gold_date_range", "range", "silver_macro", "fact_macro", "reference_date",
              "reference_date"),
        Check("fundamentals_bronze_silver_count", "count_loose", "bronze_fundamentals", "silver_statements"),
        Check("fundamentals_bronze_silver_date_range", "range", "bronze_fundamentals", "silver_statements",
              "date", "date"),
        Check("fundamentals_silver_gold_count", "count_exact", "silver_fundamentals", "fact_fundamentals"),
        Check("fundamentals_silver_gold_date_range", "range", "silver_fundamentals", "fact_fundamentals",
              "period_end_date", "period_end_date"),
    ]


def suite_tables(spark, sf):
    b, s, g = _price_layers(spark, sf)
    sm = standardize_macro(spark, sf)
    sst = standardize_fundamentals(spark, sf)
    sfl = reshape.unpivot_statement_metrics(sst)
    return {
        "bronze_prices": b, "silver_prices": s, "fact_prices": g,
        "bronze_fx": d.bronze_fx(spark, sf), "silver_fx": standardize_fx_rates(spark, sf),
        "bronze_macro": d.bronze_macro(spark, sf), "silver_macro": sm, "fact_macro": gold.build_fact_macro(sm),
        "bronze_fundamentals": d.bronze_fundamentals(spark, sf), "silver_statements": sst,
        "silver_fundamentals": sfl, "fact_fundamentals": gold.build_fact_fundamentals(sfl),
    }


@query
def recon_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Fourteen Bronze-Silver and Silver-Gold checks as one result table."""
    from tidemark.operators.quality import run_suite
    return run_suite(suite_tables(spark, sf), suite_checks())


# ---- documented extensions (Tier B) ---------------------------------------------------

@query
def asof_fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    """Daily closes converted with the latest rate published on or before the
    day (rates appear on Mondays and Thursdays); SIGNUP is the base currency."""
    from tidemark.operators.joins import convert_currency
    p = standardize.standardize_prices(dedup.dedup_prices(d.bronze_prices(spark, sf)))
    p = p.select("ticker", "date", F.upper("source").alias("currency"), "close")
    r = standardize_fx_rates(spark, sf).where(F.dayofweek("effective_date").isin(2, 5))
    return convert_currency(p, r, base_currency="SIGNUP").select(
        "ticker", "date", "currency", "close", "fx_rate", "close_pln")


@query
def ref_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan facts per foreign key."""
    from tidemark.operators.quality import orphan_counts
    cust = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return orphan_counts([
        ("orders_customer", d.table(spark, sf, "orders"), cust, ["o_custkey"]),
        ("documents_labels", d.table(spark, sf, "documents"), d.table(spark, sf, "labels"), ["doc_id"]),
    ])


@query
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Share of nulls per column in one pass."""
    from tidemark.operators.quality import null_rates as rates
    docs = d.table(spark, sf, "documents").join(d.table(spark, sf, "labels"), "doc_id", "left")
    return rates(docs)


def lineitem_rules() -> dict:
    return {
        "quantity_positive": F.col("l_quantity") > 0,
        "quantity_at_most_50": F.col("l_quantity") <= 50,
        "discount_in_range": F.col("l_discount").between(0.0, 0.1),
        "tax_non_negative": F.col("l_tax") >= 0,
        "price_positive": F.col("l_extendedprice") > 0,
    }


@query
def validate_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Violations per lineitem rule."""
    from tidemark.operators.quality import violation_counts
    return violation_counts(d.table(spark, sf, "lineitem"), lineitem_rules())


@query
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Fields added / removed / retyped between two payload batches."""
    from tidemark.operators.quality import schema_drift as drift
    p = d.statement_payload(d.table(spark, sf, "events"))
    p = p.withColumn("batch", F.when(F.col("event_type").isin("click", "view"), "b1").otherwise("b2"))
    return drift(p, "batch", "payload", "b1", "b2")


@query
def field_presence_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift on the inferred route: payloads landed as JSON files, read with
    the inferred field union, compared between two retrieval batches."""
    from tidemark.operators.quality import field_presence_drift as drift
    from tidemark.session import fresh_dir
    from tidemark.sources.landed import read_statement_json
    p = d.statement_payload(d.table(spark, sf, "events"))
    batch = F.when(F.col("event_type").isin("click", "view"), "b1").otherwise("b2")
    path = fresh_dir(spark, "landing", "statements_by_batch")
    p.select(F.concat(F.lit('{"batch":"'), batch, F.lit('",'), F.expr("substr(payload, 2)")).alias("j")) \
        .write.text(path)
    wide = read_statement_json(spark, path)
    return drift(wide, "batch", "b1", "b2")


@query
def pivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Long metrics pivoted back to one row per statement."""
    long = unpivot_metrics(spark, sf)
    return reshape.pivot_metrics(long, ["ticker", "period_end_date", "statement_type", "period_type"],
                                 ["part_size", "retail_price"])


@query
def star_join_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem revenue by order month and day type (orders x calendar star join)."""
    li = d.table(spark, sf, "lineitem")
    o = d.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    cal = date_dimension_from(o, "o_orderdate", pad_months=0)
    rev = (F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")))
    # pre-aggregate lines per order before the join: an order holding a third
    # of all lines becomes one row in the join shuffle
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(rev).alias("revenue"))
    facts = per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    c = cal.select(F.col("date").alias("__cal_date"), "year", "month", "is_trading_day_gpw")
    j = facts.join(c, F.to_date("o_orderdate") == F.col("__cal_date"))
    m = j.groupBy("year", "month", "is_trading_day_gpw").agg(F.sum("n_lines").alias("n_lines"),
                                                            F.sum("revenue").alias("revenue"))
    return m.select("year", "month", "is_trading_day_gpw", "n_lines",
                    F.col("revenue").cast("decimal(38,4)").alias("revenue"))


@query
def peer_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Customers ranked by order value inside their market segment."""
    from tidemark.operators.ranking import grouped_rank
    o = d.table(spark, sf, "orders")
    rev = o.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)")
                                     .alias("revenue"))
    c = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = rev.join(c, "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    return grouped_rank(j, ["c_mktsegment"], "revenue", out_col="peer_rank")


@query
def peer_metric_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Fundamentals peer comparison: tickers ranked by extended price within
    each (statement type, period end) peer group of the Silver facts."""
    from tidemark.operators.ranking import grouped_rank
    long = reshape.unpivot_statement_metrics(standardize_fundamentals(spark, sf), only=["extended_price"])
    # one value per ticker and peer group: the largest reported (several lines can share a key)
    per_ticker = long.groupBy("statement_type", "period_end_date", "ticker").agg(
        F.max("metric_value").alias("metric_value"))
    return grouped_rank(per_ticker, ["statement_type", "period_end_date"], "metric_value", out_col="peer_rank")


def _daily_closes(spark, sf):
    p = standardize.standardize_prices(dedup.dedup_prices(d.bronze_prices(spark, sf)))
    return p.select("ticker", "date", "close", "source")


@query
def cross_source_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Two vendors' daily closes compared key by key (tolerance 0.01)."""
    from tidemark.operators.quality import cross_source_diff as diff
    p = _daily_closes(spark, sf)
    a = p.where(F.col("source") != "error")
    b = p.where(F.col("source") != "view").withColumn(
        "close", F.col("close") + F.when(F.col("source") == "click", F.lit(0.5)).otherwise(F.lit(0.0)))
    return diff(a, b, ["ticker", "date"], "close", 0.01)


@query
def merge_batch_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Batch and stream price rows merged; the stream wins, then the latest."""
    batch = standardize.standardize_prices(d.bronze_prices(spark, sf))
    stream = batch.where(F.col("source").isin("click", "purchase")).withColumn("close", F.col("close") * F.lit(2.0))
    return dedup.merge_with_precedence([(batch, 1), (stream, 2)], ["ticker", "date"])


# ---- reference tables and batch guards ---------------------------------------------------

@query
def reference_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The ticker reference table written as a JSON file from ``customer``, read back
    and used as a lookup."""
    from tidemark.session import fresh_dir
    path = fresh_dir(spark, "reference", "tickers")
    d.tickers(spark, sf).write.json(path)
    ref = spark.read.schema("ticker string, stooq_symbol string, fmp_symbol string, company_name string, "
                            "currency string").json(path)
    p = standardize.standardize_prices(d.bronze_prices(spark, sf)).select("ticker", "date", "close")
    return add_currency_column(p, ref)


@query
def empty_batch_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Per event type, whether a batch of its rows with a negative value is refused as empty."""
    from tidemark.sources.landed import batch_status
    p = d.bronze_prices(spark, sf)
    return batch_status(p, "source", p.select("source"), F.col("close") < 0).drop("n_accepted")


@query
def union_widened(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs whose common column has clashing types are widened before the union."""
    from tidemark.operators.union import union_all_by_name
    c = d.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("amount"))
    s = d.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"))
    p = d.table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("amount"),
                                          F.col("p_size").alias("size"))
    return union_all_by_name([c, s, p])


# ---- streaming (file stream over the events table, availableNow) ------------------------

def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.streaming.prices import file_stream
    schema = d.table(spark, sf, "events").schema
    return file_stream(spark, sf, schema, glob="events.parquet")


@query
def stream_bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    """Raw price events appended from a stream into Bronze, read back."""
    from tidemark.session import fresh_dir
    from tidemark.streaming.prices import start_append_stream
    base = fresh_dir(spark, "streams", "bronze_prices")
    q = start_append_stream(d.prices_from_events(_event_stream(spark, sf)), f"{base}/table", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/table")


def _state_partitions(spark: SparkSession) -> int:
    # state grows with tickers x open windows, not with history: one partition per core
    return max(1, spark.sparkContext.defaultParallelism)


def _run_bars(spark, sf, transform=None, keys=("ticker", "date")):
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_current
    from tidemark.streaming.prices import daily_bars, start_upsert_stream, ticks_from_events
    base = fresh_dir(spark, "streams", "daily_bars")
    bars = daily_bars(ticks_from_events(_event_stream(spark, sf)))
    start_upsert_stream(bars, f"{base}/table", list(keys), f"{base}/checkpoint", transform=transform,
                        state_partitions=_state_partitions(spark)).awaitTermination()
    return read_current(spark, f"{base}/table")


@query
def stream_ohlcv_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily OHLCV bars from the tick stream (update mode + upsert)."""
    return _run_bars(spark, sf)


@query
def stream_ohlcv_multibatch(spark: SparkSession, sf: str) -> DataFrame:
    """B12 over several micro-batches: the ticks are landed as four files in time order and
    read one file a batch, so bars are merged across batches; result = batch result."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_current
    from tidemark.streaming.prices import daily_bars, file_stream, start_upsert_stream, ticks_from_events
    base = fresh_dir(spark, "streams", "daily_bars_multi")
    ev = d.table(spark, sf, "events")
    # a file holds a stretch of time, so no tick comes later than the watermark allows
    ev.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{base}/landing")
    stream = file_stream(spark, f"{base}/landing", ev.schema, max_files_per_trigger=1)
    start_upsert_stream(daily_bars(ticks_from_events(stream), watermark="3650 days"), f"{base}/table",
                        ["ticker", "date"], f"{base}/checkpoint",
                        state_partitions=_state_partitions(spark)).awaitTermination()
    return read_current(spark, f"{base}/table")


@query
def latest_quote(spark: SparkSession, sf: str) -> DataFrame:
    """Current quote per ticker, maintained by a streaming aggregate."""
    from tidemark.session import fresh_dir
    from tidemark.sinks.upsert import read_current
    from tidemark.streaming.prices import latest_quotes, start_upsert_stream, ticks_from_events
    base = fresh_dir(spark, "streams", "latest_quote")
    q = latest_quotes(ticks_from_events(_event_stream(spark, sf)))
    start_upsert_stream(q, f"{base}/table", ["ticker"], f"{base}/checkpoint",
                        state_partitions=_state_partitions(spark)).awaitTermination()
    # the source's event times are TIMESTAMP_NTZ: hand the quote time back in that type
    return read_current(spark, f"{base}/table").withColumn("quote_ts", F.col("quote_ts").cast("timestamp_ntz"))


PRICE_DROP_THRESHOLD = 0.5


@query
def price_drop_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Tickers whose price fell at least 50 % from the day's open to its close."""
    from tidemark.streaming.prices import drop_alerts
    t = _run_bars(spark, sf, transform=lambda b: drop_alerts(b, PRICE_DROP_THRESHOLD))
    return t.where(F.col("alert")).drop("alert")


from tidemark.plans import advanced  # noqa: E402

QUERIES.update(advanced.QUERIES)
