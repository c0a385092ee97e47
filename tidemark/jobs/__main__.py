"""Run one medallion job: ``spark-submit -m tidemark.jobs <job> --lake <root> ...``
(or ``python -m tidemark.jobs``).

Reference data (tickers, macro indicators) is read from JSON or CSV files
with declared schemas; ``--run-time`` is the UTC retrieval time stamped on
Bronze rows (default: now).
"""

from __future__ import annotations

import argparse
import datetime as dt

from tidemark.jobs import bronze, gold, landing, quality, rollups, silver
from tidemark.jobs.lake import Lake
from tidemark.session import get_session
from tidemark.sinks.upsert import vacuum
from tidemark.sources.reference import macro_indicators_table, tickers_table

JOBS = {
    "bronze_prices": lambda a, s, l: bronze.ingest_prices(s, l, a.landing, tickers_table(s, a.tickers), a.run_time),
    "bronze_fx_rates": lambda a, s, l: bronze.ingest_fx(s, l, a.landing, a.run_time),
    "bronze_macro": lambda a, s, l: bronze.ingest_macro(s, l, a.landing, macro_indicators_table(s, a.indicators),
                                                        a.run_time),
    "bronze_statements": lambda a, s, l: bronze.ingest_statements(s, l, a.landing, a.statement_type, a.run_time),
    "bronze_statement_payloads": lambda a, s, l: bronze.ingest_statement_payloads(s, l, a.landing, a.statement_type,
                                                                                  a.run_time),
    "bronze_prices_incremental": lambda a, s, l: landing.ingest_new_prices(s, l, a.landing, tickers_table(s, a.tickers), a.run_time),
    "bronze_fx_rates_incremental": lambda a, s, l: landing.ingest_new_fx(s, l, a.landing, a.run_time),
    "bronze_statement_payloads_incremental": lambda a, s, l: landing.ingest_new_statements(s, l, a.landing, a.statement_type,
                                                                                         a.run_time),
    "silver_prices": lambda a, s, l: silver.build_silver_prices(s, l, tickers_table(s, a.tickers), a.since),
    "silver_fx_rates": lambda a, s, l: silver.build_silver_fx_rates(s, l, a.since),
    "silver_fundamentals": lambda a, s, l: silver.build_silver_fundamentals(s, l, a.since),
    "silver_fundamentals_from_payloads": lambda a, s, l: silver.build_silver_fundamentals_from_payloads(s, l, a.since),
    "silver_macro": lambda a, s, l: silver.build_silver_macro(s, l, a.since),
    "gold_dim_company": lambda a, s, l: gold.build_dim_company(s, l, tickers_table(s, a.tickers)),
    "gold_dim_date": lambda a, s, l: gold.build_dim_date(s, l, a.start, a.end, from_silver=a.from_silver,
                                                         exclude_holidays=a.exclude_holidays),
    "gold_fact_prices": lambda a, s, l: gold.build_fact_prices(s, l),
    "gold_fact_fundamentals": lambda a, s, l: gold.build_fact_fundamentals(s, l),
    "gold_fact_macro": lambda a, s, l: gold.build_fact_macro(s, l),
    "gold_fact_prices_maintained": lambda a, s, l: rollups.advance_fact_prices(s, l, a.since),
    "quality_reconciliation": lambda a, s, l: quality.run_reconciliation(s, l),
    "quality_content": lambda a, s, l: quality.run_content_reconciliation(s, l),
    "stream_silver_prices": lambda a, s, l: _stream_prices(a, s, l),
    "maintenance_compact_bronze": lambda a, s, l: l.compact_bronze(s, a.table, a.day),
    "maintenance_vacuum": lambda a, s, l: vacuum(s, l.path(a.table), keep=a.keep),
}


def _stream_prices(a, spark, lake):
    """Tick files landing in ``--landing`` (JSON lines: ticker, ts, price, qty)
    -> daily bars -> Silver prices with stream precedence. Runs until stopped,
    or drains what has landed with ``--available-now``."""
    from pyspark.sql.types import StructType
    from tidemark.streaming.prices import file_stream
    schema = StructType.fromDDL("ticker string, ts timestamp, price double, qty bigint")
    ticks = file_stream(spark, a.landing, schema, fmt="json")
    q = silver.start_silver_prices_stream(spark, lake, ticks, tickers_table(spark, a.tickers), a.checkpoint,
                                          available_now=a.available_now, state_partitions=a.state_partitions)
    q.awaitTermination()


def parse_args(argv=None) -> argparse.Namespace:
    """Command-line arguments of a job run."""
    p = argparse.ArgumentParser(prog="tidemark.jobs", description=__doc__)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--lake", required=True, help="root folder of the tables (shared storage)")
    p.add_argument("--landing", help="landed payload folder (bronze jobs)")
    p.add_argument("--tickers", help="ticker reference file (.json or .csv)")
    p.add_argument("--indicators", help="macro indicator reference file (.json or .csv)")
    p.add_argument("--statement-type", choices=["balance_sheet", "income_statement", "cash_flow"])
    p.add_argument("--run-time", type=dt.datetime.fromisoformat,
                   default=dt.datetime.now(dt.timezone.utc).replace(microsecond=0))
    p.add_argument("--since", help="incremental Silver: retrievals on/after this day")
    p.add_argument("--start", default="2000-01-01")
    p.add_argument("--end", default="2035-12-31")
    p.add_argument("--from-silver", action="store_true", help="calendar bounds from Silver prices")
    p.add_argument("--exclude-holidays", action="store_true", help="public holidays are not trading days")
    p.add_argument("--partitioned", action="append", default=[], metavar="TABLE=COL[,COL]",
                   help="upsert TABLE partition by partition")
    p.add_argument("--table", help="table for maintenance jobs")
    p.add_argument("--day", help="one Bronze retrieval day to compact")
    p.add_argument("--keep", type=int, default=2, help="snapshot versions to keep (vacuum)")
    p.add_argument("--checkpoint", help="streaming checkpoint folder (shared storage)")
    p.add_argument("--available-now", action="store_true", help="stream: process what has landed, then stop")
    p.add_argument("--state-partitions", type=int, help="stream: state store partitions (first start only)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    """Run the job named on the command line."""
    a = parse_args(argv)
    spark = get_session(app_name=f"tidemark-{a.job}")
    layout = {t: c.split(",") for t, c in (x.split("=", 1) for x in a.partitioned)}
    JOBS[a.job](a, spark, Lake(a.lake, partitioned=layout))


if __name__ == "__main__":
    main()
