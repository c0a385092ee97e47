"""DuckDB SQL twins of the registered queries (same column names and types).

Tables are the driver's pre-registered views. Shared CTEs mirror
:mod:`tidemark.plans.derive`.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

K = "json_extract_string(props, '$.k')"

E = f"""E AS (
  SELECT 'T' || CAST(user_id AS VARCHAR) AS ticker,
         CASE WHEN {K} = '0' THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS date,
         value AS open, value + 1.0 AS high, value - 1.0 AS low, value AS close,
         CAST({K} AS BIGINT) AS volume, event_type AS source, ts AS retrieved_at
  FROM events)"""

FX = """FX AS (
  SELECT upper(source) AS currency_code, date AS effective_date, close AS mid_rate,
         'nbp' AS source, retrieved_at FROM E)"""

TICKERS = """TK AS (
  SELECT 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_mktsegment AS currency
  FROM customer WHERE c_acctbal >= 0)"""

MACRO = """M AS (
  SELECT o_orderpriority AS indicator_name, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS variable_id,
         CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS value, o_orderstatus AS unit,
         'gus' AS source, o_orderdate AS retrieved_at FROM orders)"""

FUND = """F AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS ticker, strftime(l_shipdate, '%Y-%m-%d') AS date,
         CASE WHEN l_returnflag = 'R' THEN 'FY' ELSE 'Q1' END AS period,
         l_linestatus AS statement_type, CAST(year(l_shipdate) AS VARCHAR) AS fiscalYear,
         'USD' AS reportedCurrency, 'fmp' AS source, l_shipdate AS retrieved_at,
         l_orderkey AS orderKey, l_suppkey AS suppKey, l_linenumber AS lineNumber,
         l_quantity AS quantity, l_extendedprice AS extendedPrice, l_discount AS discount, l_tax AS tax
  FROM lineitem)"""

PART_STMT = """PS AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS ticker, CAST(DATE '2000-01-01' + p_size AS DATE) AS period_end_date,
         p_type AS statement_type, CASE WHEN p_size > 25 THEN 'annual' ELSE 'quarter' END AS period_type,
         CAST(year(DATE '2000-01-01' + p_size) AS INTEGER) AS fiscal_year, 'USD' AS reported_currency,
         'fmp' AS source, TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at,
         CAST(p_size AS DOUBLE) AS part_size, p_retailprice AS retail_price,
         TRY_CAST(p_brand AS DOUBLE) AS brand_name
  FROM part)"""

UNPIVOT_PS = """UP AS (
  SELECT ticker, period_end_date, statement_type, period_type, fiscal_year, reported_currency, source,
         retrieved_at, 'part_size' AS metric_name, part_size AS metric_value FROM PS WHERE part_size IS NOT NULL
  UNION ALL
  SELECT ticker, period_end_date, statement_type, period_type, fiscal_year, reported_currency, source,
         retrieved_at, 'retail_price', retail_price FROM PS WHERE retail_price IS NOT NULL
  UNION ALL
  SELECT ticker, period_end_date, statement_type, period_type, fiscal_year, reported_currency, source,
         retrieved_at, 'brand_name', brand_name FROM PS WHERE brand_name IS NOT NULL)"""


def latest(src: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    """``row_number() = 1`` per key, every order column DESC NULLS LAST."""
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {o}) AS rn__ FROM {src}) WHERE rn__ = 1")


def strict_date(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
            f"THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END")


PRICE_COLS = ["ticker", "date", "open", "high", "low", "close", "volume", "source", "retrieved_at"]
DEDUP_P = latest("E", ["ticker", "date"], ["retrieved_at", "open", "high", "low", "close", "volume", "source"],
                 PRICE_COLS)
def _std_prices(src: str) -> str:
    return (f"SELECT * FROM (SELECT ticker, {strict_date('date')} AS date, open, high, low, close, volume, "
            f"source, retrieved_at FROM {src}) WHERE date IS NOT NULL")


SILVER_P = f"""WITH {E}, {TICKERS},
D AS ({DEDUP_P}),
S AS ({_std_prices('D')}),
SP AS (SELECT S.*, TK.currency FROM S LEFT JOIN TK USING (ticker))"""

FACT_P_COLS = "ticker, date, open, high, low, close, volume, currency, source, retrieved_at"

ORACLE_SQL["dedup_prices"] = f"WITH {E} {DEDUP_P}"
ORACLE_SQL["standardize_prices"] = f"WITH {E} {_std_prices('E')}"
ORACLE_SQL["lookup_left_join"] = f"""WITH {E}, {TICKERS}, S AS ({_std_prices('E')})
SELECT S.ticker, S.date, S.close, TK.currency FROM S LEFT JOIN TK USING (ticker)"""
ORACLE_SQL["fact_prices"] = f"{SILVER_P} SELECT {FACT_P_COLS} FROM SP"
ORACLE_SQL["fact_prices_monthly"] = f"""{SILVER_P}
SELECT currency, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       dayofweek(date) BETWEEN 1 AND 5 AS is_trading_day_gpw, count(*) AS n_rows,
       CAST(sum(CAST(close AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_close
FROM SP GROUP BY ALL"""

FX_COLS = ["currency_code", "effective_date", "mid_rate", "source", "retrieved_at"]
DEDUP_FX = latest("FX", ["currency_code", "effective_date"], ["retrieved_at", "mid_rate", "source"], FX_COLS)
ORACLE_SQL["dedup_fx_rates"] = f"WITH {E}, {FX} {DEDUP_FX}"
ORACLE_SQL["standardize_fx_rates"] = f"""WITH {E}, {FX}, D AS ({DEDUP_FX})
SELECT * FROM (SELECT currency_code, {strict_date('effective_date')} AS effective_date, mid_rate, source,
  retrieved_at FROM D) WHERE effective_date IS NOT NULL"""

MACRO_COLS = ["indicator_name", "variable_id", "year", "value", "unit", "source", "retrieved_at"]
DEDUP_M = latest("M", ["indicator_name", "year"], ["retrieved_at", "variable_id", "value", "unit", "source"],
                 MACRO_COLS)
STD_M = f"SELECT *, 'PL' AS country, make_date(year, 12, 31) AS reference_date FROM ({DEDUP_M})"
ORACLE_SQL["dedup_macro"] = f"WITH {MACRO} {DEDUP_M}"
ORACLE_SQL["standardize_macro"] = f"WITH {MACRO} {STD_M}"
ORACLE_SQL["fact_macro"] = (f"WITH {MACRO} SELECT country, reference_date, indicator_name, value, unit, source, "
                            f"retrieved_at FROM ({STD_M})")

FUND_COLS = ["ticker", "date", "period", "statement_type", "fiscalYear", "reportedCurrency", "source",
             "retrieved_at", "orderKey", "suppKey", "lineNumber", "quantity", "extendedPrice", "discount", "tax"]
DEDUP_F = latest("F", ["ticker", "date", "period", "statement_type"],
                 ["retrieved_at", "fiscalYear", "reportedCurrency", "source", "orderKey", "suppKey", "lineNumber",
                  "quantity", "extendedPrice", "discount", "tax"], FUND_COLS)
STD_F = (f"SELECT * REPLACE ({strict_date('date')} AS date), "
         f"CASE WHEN period = 'FY' THEN 'annual' ELSE 'quarter' END AS period_type FROM ({DEDUP_F})")
ORACLE_SQL["dedup_fundamentals"] = f"WITH {FUND} {DEDUP_F}"
ORACLE_SQL["standardize_fundamentals"] = f"WITH {FUND} SELECT * FROM ({STD_F}) WHERE date IS NOT NULL"

_METRICS_L = ["order_key", "supp_key", "line_number", "quantity", "extended_price", "discount", "tax"]
_METRICS_R = ["orderKey", "suppKey", "lineNumber", "quantity", "extendedPrice", "discount", "tax"]
ORACLE_SQL["silver_fundamentals_lineitem"] = f"WITH {FUND}, SF AS (SELECT * FROM ({STD_F}) WHERE date IS NOT NULL) " + \
    " UNION ALL ".join(
        f"SELECT ticker, date AS period_end_date, statement_type, period_type, TRY_CAST(fiscalYear AS INTEGER) AS "
        f"fiscal_year, reportedCurrency AS reported_currency, source, retrieved_at, '{n}' AS metric_name, "
        f"CAST({r} AS DOUBLE) AS metric_value FROM SF WHERE {r} IS NOT NULL"
        for n, r in zip(_METRICS_L, _METRICS_R))

SILVER_F_COLS = ("ticker, period_end_date, statement_type, period_type, fiscal_year, reported_currency, source, "
                 "retrieved_at, metric_name, metric_value")
ORACLE_SQL["unpivot_metrics"] = f"WITH {PART_STMT}, {UNPIVOT_PS} SELECT {SILVER_F_COLS} FROM UP"
ORACLE_SQL["variant_metrics"] = ORACLE_SQL["unpivot_metrics"]
ORACLE_SQL["fact_fundamentals"] = (f"WITH {PART_STMT}, {UNPIVOT_PS} SELECT ticker, period_end_date, statement_type, "
                                   "period_type, fiscal_year, metric_name, metric_value, reported_currency, source, "
                                   "retrieved_at FROM UP")

ORACLE_SQL["snake_case_keys"] = r"""WITH p AS (
  SELECT p_partkey, w[1] AS w1, array_to_string(w[2:], '') AS w2, p_type,
         array_to_string(list_transform(w[2:], lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), '') AS tail
  FROM (SELECT *, string_split(p_name, ' ') AS w FROM part)),
n AS (
  SELECT p_partkey, 0 AS pos, w1 || tail AS raw_name FROM p
  UNION ALL SELECT p_partkey, 1, p_type || upper(substr(w1, 1, 1)) || substr(w1, 2) FROM p
  UNION ALL SELECT p_partkey, 2, 'eps' || lower(w2) FROM p)
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, raw_name,
  lower(regexp_replace(regexp_replace(raw_name, '(.)([A-Z][a-z]+)', '\1_\2', 'g'),
                       '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake_name
FROM n"""

ORACLE_SQL["union_statements"] = """
SELECT *, 'balance_sheet' AS statement_type FROM customer
UNION ALL BY NAME SELECT *, 'income_statement' AS statement_type FROM supplier
UNION ALL BY NAME SELECT *, 'cash_flow' AS statement_type FROM part"""
ORACLE_SQL["union_by_name"] = "SELECT * FROM events"

# ---- sources --------------------------------------------------------------------------
ORACLE_SQL["csv_price_ingest"] = """
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS ticker, strftime(l_shipdate, '%Y-%m-%d') AS date,
       l_extendedprice AS open, l_extendedprice * (1.0 + l_tax) AS high, l_extendedprice * (1.0 - l_discount) AS low,
       l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume, 'stooq' AS source,
       TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at
FROM lineitem"""

ORACLE_SQL["csv_header_check"] = """
SELECT 's' || CAST(n_nationkey AS VARCHAR) AS symbol,
       CASE WHEN n_nationkey % 5 = 0 THEN 'date,open,high,low,close,volume' ELSE 'Date,Open,High,Low,Close,Volume' END
         AS first_line, n_nationkey % 5 <> 0 AS header_ok
FROM nation"""
_LANDED = """L AS (SELECT user_id % 25 AS key, event_id % 20 AS kind, strftime(ts, '%Y-%m-%d') AS date, value FROM events
  WHERE event_id % 20 <> 2),
R AS (SELECT *, CASE WHEN key % 5 = 0 THEN 'header' WHEN kind IN (0, 1) THEN 'row does not parse'
                     WHEN key % 7 = 3 THEN 'unknown symbol' WHEN kind = 3 THEN 'rules' ELSE 'accepted' END AS outcome
      FROM L)"""
ORACLE_SQL["csv_files_ingest"] = f"""WITH {_LANDED}
SELECT 'N' || CAST(key AS VARCHAR) AS ticker, date, value AS open, value + 1.0 AS high, value - 1.0 AS low,
       value AS close, CAST(10 AS BIGINT) AS volume, 'stooq' AS source, TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at
FROM R WHERE outcome = 'accepted'"""
# a file that holds a wrong header and no row is one entry of its own
ORACLE_SQL["bronze_quarantine"] = f"""WITH {_LANDED}
SELECT outcome, count(*) AS n_rows
FROM (SELECT outcome FROM R UNION ALL
      SELECT 'header' FROM nation WHERE n_nationkey % 5 = 0 AND n_nationkey NOT IN (SELECT key FROM L)) GROUP BY 1"""


def _status(body: str, expect: str) -> str:
    base = (f"CASE WHEN {body} IS NULL OR regexp_full_match({body}, '\\s*') THEN 'empty' "
            f"WHEN regexp_matches({body}, '^\\s*<') THEN 'html' ")
    if expect == "csv":
        return base + "ELSE 'ok' END"
    return base + (f"WHEN NOT json_valid({body}) THEN 'not_json' "
                   f"WHEN json_type({body}) <> 'ARRAY' THEN 'not_json_array' ELSE 'ok' END")


ORACLE_SQL["payload_quarantine"] = f"""
SELECT 'pages' AS origin, page_id AS item_id, {_status('html', 'csv')} AS payload_status FROM pages
UNION ALL SELECT 'documents', doc_id, {_status('text', 'csv')} FROM documents
UNION ALL SELECT 'events', event_id, {_status('props', 'json_array')} FROM events
UNION ALL SELECT 'conversations', conv_id * 1000 + turn, {_status('text', 'json_array')} FROM conversations"""

ORACLE_SQL["json_explode_rates"] = """
SELECT upper(event_type) AS currency_code, strftime(ts, '%Y-%m-%d') AS effective_date, value AS mid_rate,
       'nbp' AS source, TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at FROM events
UNION ALL
SELECT upper(event_type), strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d'), value + 0.5, 'nbp',
       TIMESTAMP '2024-02-01 06:00:00' FROM events"""

ORACLE_SQL["json_nested_explode"] = """
SELECT 'ind_' || o_orderpriority AS indicator_name, CAST(o_custkey AS INTEGER) AS variable_id,
       CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS value, '%' AS unit, 'gus' AS source,
       TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'ind_' || o_orderpriority, CAST(o_custkey AS INTEGER), CAST(year(o_orderdate) + 1 AS INTEGER),
       CAST(NULL AS DOUBLE), '%', 'gus', TIMESTAMP '2024-02-01 06:00:00' FROM orders WHERE o_orderstatus <> 'P'"""

ORACLE_SQL["json_schema_union"] = f"""
SELECT event_id,
       CASE WHEN event_type = 'view' THEN user_id END AS extra,
       CAST(CAST({K} AS BIGINT) + CASE WHEN event_type = 'view' THEN 0.5 ELSE 0 END AS DOUBLE) AS k,
       CAST(NULL AS VARCHAR) AS note,
       CASE WHEN event_type = 'click' THEN value END AS v
FROM events"""

# ---- generated ------------------------------------------------------------------------


def calendar_sql(lo: str, hi: str, src: str) -> str:
    return f"""B AS (SELECT {lo} AS lo, {hi} AS hi FROM {src}),
CAL AS (
  SELECT CAST(g AS DATE) AS date FROM B, unnest(generate_series(CAST(B.lo AS TIMESTAMP), CAST(B.hi AS TIMESTAMP),
         INTERVAL 1 DAY)) AS t(g) WHERE B.lo IS NOT NULL),
DIM AS (
  SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
         CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
         dayname(date) AS day_name, dayofweek(date) BETWEEN 1 AND 5 AS is_trading_day_gpw
  FROM CAL)"""


ORACLE_SQL["dim_date"] = ("WITH " + calendar_sql("CAST(min(o_orderdate) AS DATE)", "CAST(max(o_orderdate) AS DATE)",
                                                 "orders") + " SELECT * FROM DIM")
ORACLE_SQL["dim_date_from_data"] = ("WITH " + calendar_sql(
    "CAST(CAST(min(l_shipdate) AS DATE) - INTERVAL 12 MONTH AS DATE)",
    "CAST(CAST(max(l_shipdate) AS DATE) + INTERVAL 12 MONTH AS DATE)", "lineitem") + " SELECT * FROM DIM")

_EASTER = """make_date(y, ((h + l - 7 * m + 114) // 31), ((h + l - 7 * m + 114) % 31) + 1)"""
ORACLE_SQL["trading_day_holidays"] = "WITH " + calendar_sql(
    "CAST(min(o_orderdate) AS DATE)", "CAST(max(o_orderdate) AS DATE)", "orders") + """,
Y AS (SELECT DISTINCT year AS y FROM DIM),
E1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM Y),
E2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f FROM E1),
E3 AS (SELECT *, (b - f + 1) // 3 AS g FROM E2),
E4 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM E3),
E5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM E4),
E6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM E5),
EASTER AS (SELECT y, """ + _EASTER + """ AS easter FROM E6),
FIXED(mo, dd, since) AS (VALUES (1, 1, 1951), (1, 6, 2011), (5, 1, 1951), (5, 3, 1990), (8, 15, 1989),
  (11, 1, 1951), (11, 11, 1989), (12, 24, 2025), (12, 25, 1951), (12, 26, 1951)),
HOL AS (
  SELECT DIM.date FROM DIM JOIN EASTER ON DIM.year = EASTER.y
  WHERE date_diff('day', EASTER.easter, DIM.date) IN (0, 1, 49, 60)
     OR EXISTS (SELECT 1 FROM FIXED WHERE FIXED.mo = DIM.month AND FIXED.dd = day(DIM.date) AND DIM.year >= since))
SELECT DIM.* REPLACE (DIM.is_trading_day_gpw AND HOL.date IS NULL AS is_trading_day_gpw)
FROM DIM LEFT JOIN (SELECT DISTINCT date FROM HOL) HOL USING (date)"""

ORACLE_SQL["backfill_chunks"] = """
WITH R AS (SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE) AS range_start,
                  CAST(max(o_orderdate) AS DATE) AS range_end FROM orders GROUP BY 1)
SELECT o_orderpriority, range_start, range_end, CAST(g AS DATE) AS chunk_start,
       least(CAST(g AS DATE) + 366, range_end) AS chunk_end
FROM R, unnest(generate_series(CAST(range_start AS TIMESTAMP), CAST(range_end AS TIMESTAMP), INTERVAL 367 DAY)) AS t(g)
WHERE range_start <= range_end"""

ORACLE_SQL["backfill_grid"] = """
WITH R AS (
  SELECT r_name, CAST(min(year(o_orderdate)) AS INTEGER) AS y0, CAST(max(year(o_orderdate)) AS INTEGER) AS y1
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT r_name, CAST(y AS INTEGER) AS year FROM R, unnest(generate_series(y0, y1)) AS t(y)"""

ORACLE_SQL["dim_company"] = """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS company_name, n_name AS listing_currency,
       CASE WHEN s_acctbal >= 0 THEN 'F' || CAST(s_suppkey AS VARCHAR) END AS fmp_symbol
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

# ---- sinks ---------------------------------------------------------------------------
_RUN = "SELECT * REPLACE ('stooq' AS source, TIMESTAMP '{at}' AS retrieved_at) FROM E"
ORACLE_SQL["bronze_append_twice"] = (f"WITH {E} {_RUN.format(at='2024-02-01 06:00:00')} UNION ALL "
                                     f"{_RUN.format(at='2024-02-02 06:00:00')}")
ORACLE_SQL["append_schema_evolution"] = (
    f"WITH {E} {_RUN.format(at='2024-02-01 06:00:00')} UNION ALL BY NAME "
    f"SELECT *, close * 0.5 AS adj_close FROM ({_RUN.format(at='2024-02-02 06:00:00')})")
_UPS = """WITH T AS (SELECT event_id, user_id, event_type, value, ts FROM events WHERE event_type <> 'purchase'),
S AS (SELECT event_id, user_id, event_type, value + 1.0 AS value, ts FROM events
      WHERE event_type IN ('purchase', 'click'))
SELECT T.* FROM T ANTI JOIN S USING (event_id) UNION ALL SELECT * FROM S"""
ORACLE_SQL["upsert_merge"] = _UPS
ORACLE_SQL["upsert_idempotent"] = _UPS
ORACLE_SQL["upsert_partitioned"] = f"SELECT *, CAST(ts AS DATE) AS day FROM ({_UPS})"

# ---- reconciliation -------------------------------------------------------------------
_NULLS4 = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("source_min", "source_max", "target_min", "target_max"))


def count_check(name: str, kind: str, src: str, tgt: str, ordinal: int | None = None) -> str:
    passed = "t.n = s.n" if kind == "count_exact" else "t.n <= s.n"
    o = f", CAST({ordinal} AS INTEGER) AS ordinal" if ordinal is not None else ""
    return (f"SELECT '{name}' AS check_name, '{kind}' AS check_kind, {passed} AS passed, s.n AS source_count, "
            f"t.n AS target_count, s.n - t.n AS difference, {_NULLS4}, t.n = 0 AS target_empty{o} "
            f"FROM (SELECT count(*) AS n FROM {src}) s, (SELECT count(*) AS n FROM {tgt}) t")


def range_check(name: str, src: str, scol: str, tgt: str, tcol: str, typ: str, ordinal: int | None = None) -> str:
    o = f", CAST({ordinal} AS INTEGER) AS ordinal" if ordinal is not None else ""
    # the sources' dates are text where the column is called date or effective_date
    v = strict_date(f"CAST({scol} AS VARCHAR)") if typ == "DATE" else f"TRY_CAST({scol} AS {typ})"
    return (f"SELECT '{name}' AS check_name, 'range' AS check_kind, "
            f"(s.lo IS NOT DISTINCT FROM t.lo) AND (s.hi IS NOT DISTINCT FROM t.hi) AS passed, "
            f"s.n AS source_count, t.n AS target_count, s.n - t.n AS difference, "
            f"CAST(s.lo AS VARCHAR) AS source_min, CAST(s.hi AS VARCHAR) AS source_max, "
            f"CAST(t.lo AS VARCHAR) AS target_min, CAST(t.hi AS VARCHAR) AS target_max, t.n = 0 AS target_empty{o} "
            f"FROM (SELECT count(*) AS n, min({v}) AS lo, max({v}) AS hi "
            f"FROM {src}) s, (SELECT count(*) AS n, min({tcol}) AS lo, max({tcol}) AS hi FROM {tgt}) t")


_SF_WIDE = "SFW AS (SELECT * FROM (" + STD_F + ") WHERE date IS NOT NULL)"
_SF_LONG = "SFL AS (" + " UNION ALL ".join(
    f"SELECT ticker, date AS period_end_date, statement_type, period_type, TRY_CAST(fiscalYear AS INTEGER) AS "
    f"fiscal_year, reportedCurrency AS reported_currency, source, retrieved_at, '{n}' AS metric_name, "
    f"CAST({r} AS DOUBLE) AS metric_value FROM SFW WHERE {r} IS NOT NULL"
    for n, r in zip(_METRICS_L, _METRICS_R)) + ")"
ORACLE_SQL["silver_fundamentals_lineitem"] = f"WITH {FUND}, {_SF_WIDE}, {_SF_LONG} SELECT * FROM SFL"

_LAYERS = (f"{SILVER_P}, GP AS (SELECT {FACT_P_COLS} FROM SP), {FX}, "
           f"SFX AS (SELECT * FROM (SELECT currency_code, {strict_date('effective_date')} AS effective_date, "
           f"mid_rate, source, retrieved_at FROM ({DEDUP_FX})) WHERE effective_date IS NOT NULL), "
           f"{MACRO}, SM AS ({STD_M}), GM AS (SELECT country, reference_date, indicator_name, value, unit, source, "
           f"retrieved_at FROM SM), {FUND}, {_SF_WIDE}, {_SF_LONG}, GFL AS (SELECT * FROM SFL)")

ORACLE_SQL["recon_counts"] = (f"{_LAYERS} {count_check('prices_bronze_silver_count', 'count_loose', 'E', 'SP')} "
                              f"UNION ALL {count_check('prices_silver_gold_count', 'count_exact', 'SP', 'GP')}")
ORACLE_SQL["recon_ranges"] = (
    f"{_LAYERS} {range_check('prices_bronze_silver_date_range', 'E', 'date', 'SP', 'date', 'DATE')} "
    f"UNION ALL {range_check('prices_silver_gold_date_range', 'SP', 'date', 'GP', 'date', 'DATE')}")
ORACLE_SQL["recon_summary"] = f"""{_LAYERS}, R AS (
  SELECT *, 0 AS ordinal FROM ({count_check('prices_bronze_silver_count', 'count_loose', 'E', 'SP')}
    UNION ALL {count_check('prices_silver_gold_count', 'count_exact', 'SP', 'GP')})
  UNION ALL
  SELECT *, 1 AS ordinal FROM ({range_check('prices_bronze_silver_date_range', 'E', 'date', 'SP', 'date', 'DATE')}
    UNION ALL {range_check('prices_silver_gold_date_range', 'SP', 'date', 'GP', 'date', 'DATE')}))
SELECT coalesce(bool_and(passed), TRUE) AS all_passed, count(*) FILTER (WHERE NOT passed) AS n_failed,
       coalesce(list(check_name ORDER BY ordinal, check_name) FILTER (WHERE NOT passed), []::VARCHAR[]) AS failed
FROM R"""

_SUITE = [
    ("count", "prices_bronze_silver_count", "count_loose", "E", "SP"),
    ("range", "prices_bronze_silver_date_range", "E", "date", "SP", "date", "DATE"),
    ("count", "prices_silver_gold_count", "count_exact", "SP", "GP"),
    ("range", "prices_silver_gold_date_range", "SP", "date", "GP", "date", "DATE"),
    ("count", "fx_bronze_silver_count", "count_loose", "FX", "SFX"),
    ("range", "fx_bronze_silver_date_range", "FX", "effective_date", "SFX", "effective_date", "DATE"),
    ("count", "macro_bronze_silver_count", "count_loose", "M", "SM"),
    ("range", "macro_bronze_silver_year_range", "M", "year", "SM", "year", "INTEGER"),
    ("count", "macro_silver_gold_count", "count_exact", "SM", "GM"),
    ("range", "macro_silver_gold_date_range", "SM", "reference_date", "GM", "reference_date", "DATE"),
    ("count", "fundamentals_bronze_silver_count", "count_loose", "F", "SFW"),
    ("range", "fundamentals_bronze_silver_date_range", "F", "date", "SFW", "date", "DATE"),
    ("count", "fundamentals_silver_gold_count", "count_exact", "SFL", "GFL"),
    ("range", "fundamentals_silver_gold_date_range", "SFL", "period_end_date", "GFL", "period_end_date", "DATE"),
]
ORACLE_SQL["recon_suite"] = _LAYERS + " " + " UNION ALL ".join(
    (count_check(*c[1:], ordinal=i) if c[0] == "count" else range_check(*c[1:], ordinal=i))
    for i, c in enumerate(_SUITE))

# ---- Tier B ---------------------------------------------------------------------------
ORACLE_SQL["asof_fx_convert"] = f"""WITH {E}, {FX}, DP AS ({DEDUP_P}),
P AS (SELECT ticker, date, upper(source) AS currency, close FROM ({_std_prices('DP')})),
R AS (SELECT * FROM (SELECT currency_code, {strict_date('effective_date')} AS effective_date, mid_rate
                     FROM ({DEDUP_FX})) WHERE effective_date IS NOT NULL AND dayofweek(effective_date) IN (1, 4))
SELECT P.ticker, P.date, P.currency, P.close,
       CASE WHEN P.currency = 'SIGNUP' THEN 1.0 ELSE R.mid_rate END AS fx_rate,
       P.close * CASE WHEN P.currency = 'SIGNUP' THEN 1.0 ELSE R.mid_rate END AS close_pln
FROM P ASOF LEFT JOIN R ON P.currency = R.currency_code AND P.date >= R.effective_date"""

ORACLE_SQL["ref_integrity"] = """
SELECT 'orders_customer' AS check_name, count(*) AS fact_rows, count(*) FILTER (WHERE c.k IS NULL) AS orphan_rows,
       count(*) FILTER (WHERE c.k IS NULL) = 0 AS passed
FROM orders LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer) c ON o_custkey = c.k
UNION ALL
SELECT 'documents_labels', count(*), count(*) FILTER (WHERE l.k IS NULL), count(*) FILTER (WHERE l.k IS NULL) = 0
FROM documents LEFT JOIN (SELECT DISTINCT doc_id AS k FROM labels) l ON documents.doc_id = l.k"""

_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
ORACLE_SQL["null_rates"] = "WITH J AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS DOUBLE)) AS null_rate FROM J" for c in _DOC_COLS)

_RULES = [("quantity_positive", "l_quantity > 0"), ("quantity_at_most_50", "l_quantity <= 50"),
          ("discount_in_range", "l_discount BETWEEN 0.0 AND 0.1"), ("tax_non_negative", "l_tax >= 0"),
          ("price_positive", "l_extendedprice > 0")]
ORACLE_SQL["validate_ranges"] = " UNION ALL ".join(
    f"SELECT '{n}' AS rule_name, count(*) FILTER (WHERE NOT coalesce({c}, FALSE)) AS violations FROM lineitem"
    for n, c in _RULES)

ORACLE_SQL["schema_drift"] = f"""WITH P AS (
  SELECT CASE WHEN event_type IN ('click', 'view') THEN 'b1' ELSE 'b2' END AS batch, event_type, event_id,
         CAST({K} AS BIGINT) AS k, value, user_id FROM events),
FT AS (SELECT DISTINCT batch, field, type_class FROM (
  SELECT batch, 'event_id' AS field, 'integer' AS type_class FROM P WHERE event_id IS NOT NULL
  UNION ALL SELECT batch, 'k', CASE WHEN event_type = 'view' THEN 'double' ELSE 'integer' END FROM P
            WHERE k IS NOT NULL
  UNION ALL SELECT batch, 'v', 'double' FROM P WHERE event_type = 'click' AND value IS NOT NULL
  UNION ALL SELECT batch, 'extra', 'integer' FROM P WHERE event_type = 'view' AND user_id IS NOT NULL
  UNION ALL SELECT batch, 'note', 'null' FROM P WHERE event_type NOT IN ('click', 'view') OR event_type IS NULL))
SELECT field, type_class, 'added' AS change FROM (
  SELECT field, type_class FROM FT WHERE batch = 'b2' EXCEPT SELECT field, type_class FROM FT WHERE batch = 'b1')
UNION ALL
SELECT field, type_class, 'removed' FROM (
  SELECT field, type_class FROM FT WHERE batch = 'b1' EXCEPT SELECT field, type_class FROM FT WHERE batch = 'b2')"""

ORACLE_SQL["pivot_metrics"] = f"""WITH {PART_STMT}, {UNPIVOT_PS}
SELECT ticker, period_end_date, statement_type, period_type,
       max(metric_value) FILTER (WHERE metric_name = 'part_size') AS part_size,
       max(metric_value) FILTER (WHERE metric_name = 'retail_price') AS retail_price
FROM UP GROUP BY ALL"""

ORACLE_SQL["star_join_monthly"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       dayofweek(o_orderdate) BETWEEN 1 AND 5 AS is_trading_day_gpw, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DECIMAL(38,4))
         AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""

ORACLE_SQL["peer_rank"] = """
WITH R AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
           FROM orders GROUP BY 1)
SELECT c_custkey, c_mktsegment, revenue,
       rank() OVER (PARTITION BY c_mktsegment ORDER BY revenue DESC NULLS LAST) AS peer_rank
FROM R JOIN customer ON o_custkey = c_custkey"""

_CLOSES = f"{E}, DP AS ({DEDUP_P}), P AS (SELECT ticker, date, close, source FROM ({_std_prices('DP')}))"
ORACLE_SQL["cross_source_diff"] = f"""WITH {_CLOSES},
A AS (SELECT ticker, date, close AS value_a, TRUE AS fa FROM P WHERE source <> 'error'),
B AS (SELECT ticker, date, close + CASE WHEN source = 'click' THEN 0.5 ELSE 0.0 END AS value_b, TRUE AS fb
      FROM P WHERE source <> 'view')
SELECT ticker, date, value_a, value_b,
       CASE WHEN fb IS NULL THEN 'only_a' WHEN fa IS NULL THEN 'only_b'
            WHEN abs(value_a - value_b) <= 0.01 THEN 'match' ELSE 'mismatch' END AS status
FROM A FULL OUTER JOIN B USING (ticker, date)"""

ORACLE_SQL["merge_batch_stream"] = f"""WITH {E}, B AS ({_std_prices('E')}),
U AS (SELECT *, 1 AS source_priority FROM B
      UNION ALL SELECT * REPLACE (close * 2.0 AS close), 2 AS source_priority FROM B
      WHERE source IN ('click', 'purchase'))
""" + latest("U", ["ticker", "date"], ["source_priority", "retrieved_at", "open", "high", "low", "close", "volume",
                                       "source"], PRICE_COLS + ["source_priority"])

# ---- streaming ------------------------------------------------------------------------
ORACLE_SQL["stream_bronze_append"] = f"WITH {E} SELECT * FROM E"
_TICKS = f"""T AS (SELECT 'T' || CAST(user_id AS VARCHAR) AS ticker, ts, value AS price, CAST({K} AS BIGINT) AS qty
       FROM events)"""
_BARS = """B AS (SELECT ticker, CAST(ts AS DATE) AS date, arg_min(price, row(ts, price, qty)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, row(ts, price, qty)) AS close, CAST(sum(qty) AS BIGINT) AS volume, count(*) AS n_ticks
       FROM T GROUP BY 1, 2)"""
ORACLE_SQL["stream_ohlcv_daily"] = f"WITH {_TICKS}, {_BARS} SELECT * FROM B"
ORACLE_SQL["latest_quote"] = (f"WITH {_TICKS} SELECT ticker, arg_max(price, row(ts, price, qty)) AS price, max(ts) AS quote_ts "
                              "FROM T GROUP BY 1")
ORACLE_SQL["price_drop_alert"] = (f"WITH {_TICKS}, {_BARS} SELECT ticker, date, open, close, "
                                  "(open - close) / NULLIF(open, 0) AS drop_pct FROM B "
                                  "WHERE (open - close) / NULLIF(open, 0) >= 0.5")

ORACLE_SQL["variant_statements_silver"] = ORACLE_SQL["silver_fundamentals_lineitem"]

ORACLE_SQL["peer_metric_rank"] = f"""WITH {FUND}, {_SF_WIDE}, {_SF_LONG},
P AS (SELECT statement_type, period_end_date, ticker, max(metric_value) AS metric_value FROM SFL
      WHERE metric_name = 'extended_price' GROUP BY ALL)
SELECT statement_type, period_end_date, ticker, metric_value,
       rank() OVER (PARTITION BY statement_type, period_end_date ORDER BY metric_value DESC NULLS LAST) AS peer_rank
FROM P"""

ORACLE_SQL["field_presence_drift"] = f"""WITH P AS (
  SELECT CASE WHEN event_type IN ('click', 'view') THEN 'b1' ELSE 'b2' END AS batch, event_type, event_id,
         CAST({K} AS BIGINT) AS k, value, user_id FROM events),
N AS (
  SELECT batch, count(event_id) AS event_id, count(k) AS k,
         count(CASE WHEN event_type = 'click' THEN value END) AS v,
         count(CASE WHEN event_type = 'view' THEN user_id END) AS extra, 0 AS note
  FROM P GROUP BY batch),
L AS (UNPIVOT N ON event_id, k, v, extra, note INTO NAME field VALUE n),
W AS (SELECT field, coalesce(sum(n) FILTER (WHERE batch = 'b1'), 0) AS old_n,
             coalesce(sum(n) FILTER (WHERE batch = 'b2'), 0) AS new_n FROM L GROUP BY field)
SELECT field, CASE WHEN old_n = 0 AND new_n > 0 THEN 'added' ELSE 'removed' END AS change
FROM W WHERE (old_n = 0 AND new_n > 0) OR (old_n > 0 AND new_n = 0)"""

ORACLE_SQL["upsert_many_partitions"] = """
WITH O AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders),
T AS (SELECT * FROM O WHERE o_orderstatus <> 'P'),
S AS (SELECT * REPLACE (o_totalprice + 1.0 AS o_totalprice) FROM O WHERE o_orderstatus <> 'O')
SELECT T.* FROM T ANTI JOIN S USING (o_orderkey, day) UNION ALL SELECT * FROM S"""
ORACLE_SQL["compact_evolved"] = ORACLE_SQL["append_schema_evolution"]
ORACLE_SQL["append_type_drift"] = """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS revenue, CAST(1 AS INTEGER) AS run, CAST(NULL AS DOUBLE) AS margin
FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, 2, CAST(o_custkey AS DOUBLE) FROM orders
UNION ALL SELECT o_orderkey, NULL, 3, o_totalprice / 2 FROM orders"""
ORACLE_SQL["reference_labels"] = ORACLE_SQL["lookup_left_join"]
ORACLE_SQL["empty_batch_guard"] = f"""WITH {E}
SELECT source, count(*) AS n_rows, count(CASE WHEN close < 0 THEN 1 END) = 0 AS refused
FROM E WHERE source IS NOT NULL GROUP BY 1"""
ORACLE_SQL["union_widened"] = """
SELECT c_name AS name, CAST(c_nationkey AS DOUBLE) AS amount, CAST(NULL AS INTEGER) AS size FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
UNION ALL SELECT p_name, CAST(p_partkey AS DOUBLE), CAST(p_size AS INTEGER) FROM part"""
ORACLE_SQL["stream_ohlcv_multibatch"] = ORACLE_SQL["stream_ohlcv_daily"]


from tidemark.plans.advanced_sql import ADVANCED_SQL  # noqa: E402

ORACLE_SQL.update(ADVANCED_SQL)
