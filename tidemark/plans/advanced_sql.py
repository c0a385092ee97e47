"""DuckDB SQL of the queries in :mod:`tidemark.plans.advanced`."""

from __future__ import annotations

from tidemark.plans.oracle import DEDUP_P, E, _LANDED, _std_prices

ADVANCED_SQL: dict[str, str] = {}

ADVANCED_SQL["incremental_landing"] = f"""WITH {_LANDED}
SELECT 'N' || CAST(key AS VARCHAR) AS ticker, date, value AS open, value + 1.0 AS high, value - 1.0 AS low,
       value AS close, CAST(10 AS BIGINT) AS volume, 'stooq' AS source, TIMESTAMP '2024-02-01 06:00:00' AS retrieved_at,
       CAST(key % 2 AS INTEGER) AS landing_batch
FROM R WHERE outcome = 'accepted'"""

_CHANGED = """S AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
K AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS o_custkey,
             CASE WHEN o_orderkey % 83 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice, o_orderdate
      FROM S WHERE o_orderkey % 101 <> 0),
T AS (SELECT * FROM K UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM S WHERE o_orderkey % 103 = 0
      UNION ALL SELECT * FROM K WHERE o_orderkey % 107 = 0)"""

_COMPARED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_NAMES = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _COMPARED)
ADVANCED_SQL["content_diff"] = f"""WITH {_CHANGED},
SN AS (SELECT o_orderkey, count(*) AS n, {', '.join(f'min({c}) AS {c}' for c in _COMPARED)} FROM S GROUP BY 1),
TN AS (SELECT o_orderkey, count(*) AS n, {', '.join(f'min({c}) AS {c}' for c in _COMPARED)} FROM T GROUP BY 1)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
       coalesce(a.n, 0) AS n_source, coalesce(b.n, 0) AS n_target,
       CASE WHEN a.n = 1 AND b.n = 1 THEN concat_ws(',', {_NAMES}) END AS changed_columns
FROM SN a FULL OUTER JOIN TN b ON a.o_orderkey = b.o_orderkey
WHERE a.n IS DISTINCT FROM b.n OR {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in _COMPARED)}"""

ADVANCED_SQL["content_checks"] = """
WITH N AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 25 = 0) AS moved FROM orders)
SELECT 'same rows' AS check_name, 'content' AS check_kind, TRUE AS passed, n AS source_count, n AS target_count,
       n = 0 AS target_empty FROM N
UNION ALL SELECT 'prices moved', 'content', moved = 0, n, n, n = 0 FROM N
UNION ALL SELECT 'prices moved: counts', 'count_exact', TRUE, n, n, n = 0 FROM N
UNION ALL SELECT 'prices moved: key range', 'range', TRUE, n, n, n = 0 FROM N"""

ADVANCED_SQL["rollup_maintained"] = f"""WITH {E}, DP AS ({DEDUP_P}),
P AS (SELECT ticker, date, source, CAST(close AS DECIMAL(18, 2)) AS close, day(date) AS d FROM ({_std_prices('DP')})),
F AS (SELECT ticker, date, CASE WHEN d % 11 = 0 THEN 'moved' ELSE source END AS source,
             CASE WHEN d % 11 = 0 THEN close WHEN d % 7 = 0 THEN close + 2 WHEN d % 5 = 0 THEN close + 1 ELSE close END AS close
      FROM P)
SELECT source, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows,
       CAST(sum(close) AS DECIMAL(38, 2)) AS sum_close FROM F GROUP BY 1, 2, 3"""

_QUOTES = """V AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'T' || CAST(user_id % 20 AS VARCHAR) END AS book,
                 event_id, event_type, ts, value FROM events),
L AS (SELECT book, event_id, ts, value AS price FROM V WHERE event_type <> 'view'),
R AS (SELECT book, ts AS quoted_at, value AS bid FROM V WHERE event_type = 'view')"""
ADVANCED_SQL["asof_quotes"] = f"""WITH {_QUOTES}
SELECT L.book, event_id, ts, price, bid, quoted_at AS matched_quoted_at
FROM L ASOF LEFT JOIN R ON L.book = R.book AND L.ts >= R.quoted_at"""
ADVANCED_SQL["asof_quotes_tolerance"] = f"""WITH {_QUOTES},
J AS (SELECT L.book, event_id, ts, price, bid, quoted_at FROM L ASOF LEFT JOIN R ON L.book = R.book AND L.ts >= R.quoted_at)
SELECT book, event_id, ts, price, CASE WHEN quoted_at >= ts - INTERVAL 30 MINUTE THEN bid END AS bid,
       CASE WHEN quoted_at >= ts - INTERVAL 30 MINUTE THEN quoted_at END AS matched_quoted_at FROM J"""

ADVANCED_SQL["cross_source_nearest"] = f"""WITH {E}, DP AS ({DEDUP_P}),
P AS (SELECT ticker, date, source, close FROM ({_std_prices('DP')})),
A AS (SELECT ticker, date, close FROM P WHERE source <> 'error'),
B AS (SELECT ticker, CAST(date + CAST(day(date) % 4 AS INTEGER) AS DATE) AS date, max(close) AS close FROM P
      WHERE source <> 'view' GROUP BY 1, 2),
J AS (SELECT A.ticker, A.date AS date_a, A.close AS value_a, B.date AS date_b, B.close AS value_b,
             row_number() OVER (PARTITION BY A.ticker, A.date ORDER BY abs(A.date - B.date), B.date) AS nth
      FROM A JOIN B ON A.ticker = B.ticker AND B.date BETWEEN A.date - 2 AND A.date + 2)
SELECT A.ticker, A.date AS date_a, A.close AS value_a, J.date_b, J.value_b,
       CASE WHEN J.ticker IS NULL THEN 'only_a' WHEN abs(A.close - J.value_b) <= 0.5 THEN 'match' ELSE 'mismatch' END AS status
FROM A LEFT JOIN J ON A.ticker = J.ticker AND A.date = J.date_a AND J.nth = 1
UNION ALL
SELECT B.ticker, NULL, NULL, B.date, B.close, 'only_b' FROM B ANTI JOIN J ON B.ticker = J.ticker AND B.date = J.date_b"""

_QS = ", ".join(f"quantile_disc(l_extendedprice, {q}) AS q{i}" for i, q in enumerate((0.0, 0.25, 0.5, 0.75, 1.0)))
ADVANCED_SQL["peer_medians"] = f"""
SELECT CASE WHEN l_partkey % 3 = 0 THEN 'large' ELSE 'P' || CAST(l_partkey % 40 AS VARCHAR) END AS peer_group,
       count(l_extendedprice) AS n, {_QS} FROM lineitem GROUP BY 1"""

ADVANCED_SQL["stream_first_deliveries"] = "SELECT * FROM events"
ADVANCED_SQL["stream_converted_ticks"] = """
WITH V AS (SELECT event_id, upper(event_type) AS currency, ts, value AS price FROM events),
R AS (SELECT currency, CAST(ts AS DATE) AS day, max(price) AS rate FROM V WHERE day(ts) % 4 <> 0 GROUP BY 1, 2)
SELECT event_id, V.currency, ts, price, rate, price * rate AS converted
FROM V JOIN R ON V.currency = R.currency AND CAST(V.ts AS DATE) = R.day"""

ADVANCED_SQL["upsert_bucketed"] = """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('P', 'F') THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate FROM orders"""

# the structure of each batch is merged by DuckDB and opened member by member
ADVANCED_SQL["nested_drift"] = """
WITH RECURSIVE P AS (
  SELECT CASE WHEN day(ts) <= 15 THEN 'old' ELSE 'new' END AS batch,
         CASE WHEN day(ts) <= 15 THEN
           json_object('id', event_id, 'user', json_object('id', user_id, 'rank', json_object('score', value)),
                       'tags', json_array(json_object('name', event_type, 'weight', 1)))
         ELSE json_object('id', CAST(event_id AS VARCHAR),
                'user', json_object('id', user_id, 'rank', json_object('score', CAST(value AS VARCHAR), 'live', TRUE)),
                'tags', json_array(json_object('name', event_type, 'marks', json_array(1.5)))) END AS payload
  FROM events),
T AS (
  SELECT batch, '$' AS path, json_group_structure(payload) AS node FROM P GROUP BY batch
  UNION ALL
  SELECT batch, path || step, node FROM (
    SELECT batch, path, unnest(CASE json_type(node)
      WHEN 'OBJECT' THEN list_transform(json_keys(node), lambda k: {'step': '.' || k, 'node': json_extract(node, '$."' || k || '"')})
      WHEN 'ARRAY' THEN [{'step': '[]', 'node': json_extract(node, '$[0]')}] ELSE [] END, recursive := true) FROM T)),
C AS (SELECT batch, path, CASE json_type(node) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE
        CASE json_extract_string(node, '$') WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null'
             WHEN 'JSON' THEN 'mixed' ELSE 'number' END END AS class FROM T)
SELECT coalesce(a.path, b.path) AS path, a.class AS old_class, b.class AS new_class,
       CASE WHEN a.path IS NULL THEN 'added' WHEN b.path IS NULL THEN 'removed' ELSE 'retyped' END AS change
FROM (SELECT * FROM C WHERE batch = 'old') a FULL OUTER JOIN (SELECT * FROM C WHERE batch = 'new') b ON a.path = b.path
WHERE a.class IS DISTINCT FROM b.class"""
