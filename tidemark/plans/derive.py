"""Derivations of the medallion inputs from the driver's test tables.

Each function reads whole tables and maps them onto a Bronze/Silver shape
(prices from ``events``, macro from ``orders``, statements from ``lineitem``
and ``part``...). The SQL twins live in :mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed retrieval times stamped by the derived ingestion runs.
RUN1_AT = "2024-02-01 06:00:00"
RUN2_AT = "2024-02-02 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k")


def bronze_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: events as price ticks (see :func:`prices_from_events`)."""
    return prices_from_events(table(spark, sf_dir, "events"))


def prices_from_events(ev: DataFrame) -> DataFrame:
    """Events (batch or stream) as Bronze price rows. ``date`` is text; rows
    whose payload k is 0 carry the unparseable date ``not-a-date``."""
    date = F.when(_k() == "0", F.lit("not-a-date")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return ev.select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"),
        date.alias("date"),
        F.col("value").alias("open"),
        (F.col("value") + F.lit(1.0)).alias("high"),
        (F.col("value") - F.lit(1.0)).alias("low"),
        F.col("value").alias("close"),
        _k().cast("bigint").alias("volume"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("retrieved_at"),
    )


def bronze_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E renamed to the FX contract: one currency per event type."""
    p = bronze_prices(spark, sf_dir)
    return p.select(F.upper("source").alias("currency_code"), F.col("date").alias("effective_date"),
                    F.col("close").alias("mid_rate"), F.lit("nbp").alias("source"), "retrieved_at")


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker reference data from ``customer``: customers with a negative
    balance are not listed, so their tickers stay unknown (null currency)."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("stooq_symbol"),
        F.lit(None).cast("string").alias("fmp_symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("currency"))


def bronze_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as macro observations: indicator = priority, one value per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("indicator_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("variable_id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderstatus").alias("unit"),
        F.lit("gus").alias("source"),
        F.col("o_orderdate").alias("retrieved_at"),
    )


def bronze_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as wide statement rows (several statements per key)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("l_returnflag") == "R", F.lit("FY")).otherwise(F.lit("Q1")).alias("period"),
        F.col("l_linestatus").alias("statement_type"),
        F.year("l_shipdate").cast("string").alias("fiscalYear"),
        F.lit("USD").alias("reportedCurrency"),
        F.lit("fmp").alias("source"),
        F.col("l_shipdate").alias("retrieved_at"),
        F.col("l_orderkey").alias("orderKey"),
        F.col("l_suppkey").alias("suppKey"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedPrice"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def statements_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized wide statements from ``part``: two numeric metrics and a
    text field that must not survive the unpivot."""
    p = table(spark, sf_dir, "part")
    date = F.date_add(F.to_date(F.lit("2000-01-01")), F.col("p_size"))
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"),
        date.alias("date"),
        F.col("p_type").alias("statement_type"),
        F.when(F.col("p_size") > 25, F.lit("FY")).otherwise(F.lit("Q2")).alias("period"),
        F.when(F.col("p_size") > 25, F.lit("annual")).otherwise(F.lit("quarter")).alias("period_type"),
        F.year(date).cast("string").alias("fiscalYear"),
        F.lit("USD").alias("reportedCurrency"),
        F.lit("fmp").alias("source"),
        F.to_timestamp_ntz(F.lit(RUN1_AT)).alias("retrieved_at"),
        F.col("p_size").alias("partSize"),
        F.col("p_retailprice").alias("retailPrice"),
        F.col("p_brand").alias("brandName"),
    )


def statement_payload(df: DataFrame) -> DataFrame:
    """Event payloads whose shape varies by event type (for inference/drift)."""
    k = _k().cast("bigint")
    is_view = F.col("event_type") == "view"
    is_click = F.col("event_type") == "click"
    body = F.when(is_click, F.to_json(F.struct(F.col("event_id"), k.alias("k"), F.col("value").alias("v"))))
    body = body.when(is_view, F.to_json(F.struct(F.col("event_id"), (k + F.lit(0.5)).alias("k"),
                                                 F.col("user_id").alias("extra"))))
    body = body.otherwise(F.to_json(F.struct(F.col("event_id"), k.alias("k"),
                                             F.lit(None).cast("string").alias("note")),
                                    {"ignoreNullFields": "false"}))
    return df.select("event_id", "event_type", body.alias("payload"))


def land_price_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Events as landed price files ``<folder>/<symbol>.csv``, one symbol per nation.

    Every fifth symbol's file has a lower-case header. Of twenty rows one has no date, one
    is cut after two fields, one is a blank line and one has its high below its low.
    """
    from tidemark.schemas import EXPECTED_PRICE_CSV_HEADER
    from tidemark.sinks.upsert import _fs
    key = F.col("user_id") % 25
    day = F.date_format("ts", "yyyy-MM-dd")
    v = F.col("value")
    kind = F.col("event_id") % 20
    high = F.when(kind == 3, v - 5.0).otherwise(v + 1.0)
    full = F.concat_ws(",", F.when(kind == 0, "").otherwise(day), v, high, v - 1.0, v, F.lit(10))
    line = F.when(kind == 1, F.concat_ws(",", day, v)).when(kind == 2, "").otherwise(full)
    rows = table(spark, sf_dir, "events").select(key.alias("key"), F.col("event_id").alias("ord"), line.alias("line"))
    header = ",".join(EXPECTED_PRICE_CSV_HEADER)
    heads = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("key"), F.lit(-1).cast("long").alias("ord"),
        F.when(F.col("n_nationkey") % 5 == 0, header.lower()).otherwise(header).alias("line"))
    (rows.unionByName(heads).withColumn("symbol", F.concat(F.lit("s"), F.col("key").cast("string")))
     .repartition(25, "symbol").sortWithinPartitions("symbol", "ord").select("symbol", "line")
     .write.partitionBy("symbol").text(f"{folder}/parts"))
    fs, root = _fs(spark, f"{folder}/parts")
    _, landing = _fs(spark, f"{folder}/landing")
    fs.mkdirs(landing)
    for d in fs.listStatus(root):  # one folder a nation; the contract names files by symbol
        name = d.getPath().getName()
        if name.startswith("symbol="):
            for f in fs.listStatus(d.getPath()):
                if f.getPath().getName().startswith("part-"):
                    fs.rename(f.getPath(), _fs(spark, f"{folder}/landing/{name[7:]}.csv")[1])
    return f"{folder}/landing"


def symbol_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers of the landed symbols; every seventh symbol from the third on is unknown."""
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 7 != 3)
    key = F.col("n_nationkey").cast("string")
    return n.select(F.concat(F.lit("N"), key).alias("ticker"), F.concat(F.lit("s"), key).alias("stooq_symbol"))
