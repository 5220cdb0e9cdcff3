"""DuckDB formulations of the registered queries, written independently of the
Spark operators (islands by running sums, joins on maxima, stacked snapshots),
over the views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations``.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["first_per_key"] = """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
                           ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) = 1
"""

ORACLE_SQL["latest_per_key"] = """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
                           ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1
"""

ORACLE_SQL["scd1_changes"] = """
SELECT e.* FROM events e
JOIN (SELECT user_id, max(ts) AS m FROM events WHERE ts IS NOT NULL GROUP BY user_id) x
  ON e.user_id IS NOT DISTINCT FROM x.user_id AND e.ts = x.m
"""


def _islands(source: str, key: str, seq: str, tracked: str, out_cols: str) -> str:
    """Versions of a change feed with unique (key, seq): islands of equal tracked
    values by a running sum; untracked columns from the island's last row."""
    return f"""
WITH src AS ({source}),
flag AS (
  SELECT *, CASE WHEN row_number() OVER w = 1
                   OR ({tracked}) IS DISTINCT FROM (lag({tracked}) OVER w) THEN 1 ELSE 0 END AS opens
  FROM src WINDOW w AS (PARTITION BY {key} ORDER BY {seq})
),
isl AS (
  SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY {seq} ROWS UNBOUNDED PRECEDING) AS island FROM flag
),
ver AS (
  SELECT *, min({seq}) OVER (PARTITION BY {key}, island) AS start_at FROM isl
  QUALIFY row_number() OVER (PARTITION BY {key}, island ORDER BY {seq} DESC) = 1
)
SELECT {out_cols}, start_at AS __START_AT,
       lead(start_at) OVER (PARTITION BY {key} ORDER BY start_at) AS __END_AT
FROM ver
"""


ORACLE_SQL["scd2_changes"] = _islands(
    "SELECT user_id, ts, event_type FROM events WHERE ts IS NOT NULL",
    "user_id", "ts", "event_type", "user_id, ts, event_type",
)

ORACLE_SQL["scd2_changes_untracked"] = _islands(
    "SELECT user_id, ts, event_type, value FROM events WHERE ts IS NOT NULL",
    "user_id", "ts", "event_type", "user_id, ts, event_type, value",
)

ORACLE_SQL["scd2_changes_except"] = _islands(
    "SELECT * FROM events WHERE ts IS NOT NULL",
    "user_id", "ts", "event_type", "event_id, ts, user_id, event_type, value, props",
)

# Several orders of a customer on one day: only the one with the greatest
# order key forms a version; then islands over the order date.
ORACLE_SQL["scd2_changes_composite"] = _islands(
    """SELECT * FROM orders WHERE o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""",
    "o_custkey", "o_orderdate", "o_orderstatus",
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
)

ORACLE_SQL["scd2_current"] = f"""
SELECT * FROM ({ORACLE_SQL["scd2_changes"]}) WHERE __END_AT IS NULL
"""


# Snapshots stacked with their version; islands break on a change of status or
# when the customer is missing from the snapshot right before.
_SNAPSHOTS = """
cut AS (SELECT * FROM (VALUES (DATE '1995-01-01'), (DATE '1997-01-01'), (DATE '1999-01-01'), (DATE '2100-01-01')) v(version)),
gv AS (SELECT version, lag(version) OVER (ORDER BY version) AS prev_v,
              lead(version) OVER (ORDER BY version) AS next_v FROM cut),
snap AS (
  SELECT o.*, c.version FROM orders o JOIN gv c
    ON (c.prev_v IS NULL OR o.o_orderdate >= c.prev_v) AND o.o_orderdate < c.version
  QUALIFY row_number() OVER (PARTITION BY o.o_custkey, c.version
                             ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) = 1
)"""

ORACLE_SQL["scd2_snapshots"] = f"""
WITH {_SNAPSHOTS},
flag AS (
  SELECT s.*, g.prev_v, g.next_v,
         CASE WHEN (lag(s.version) OVER w) IS NULL
                OR (lag(s.version) OVER w) IS DISTINCT FROM g.prev_v
                OR s.o_orderstatus IS DISTINCT FROM (lag(s.o_orderstatus) OVER w) THEN 1 ELSE 0 END AS opens
  FROM snap s JOIN gv g ON s.version = g.version
  WINDOW w AS (PARTITION BY s.o_custkey ORDER BY s.version)
),
isl AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY version ROWS UNBOUNDED PRECEDING) AS island
        FROM flag),
ver AS (
  SELECT *, min(version) OVER (PARTITION BY o_custkey, island) AS start_at FROM isl
  QUALIFY row_number() OVER (PARTITION BY o_custkey, island ORDER BY version DESC) = 1
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       start_at AS __START_AT, next_v AS __END_AT
FROM ver
"""

ORACLE_SQL["scd2_snapshots_stacked"] = ORACLE_SQL["scd2_snapshots"]

ORACLE_SQL["scd1_snapshots"] = f"""
WITH {_SNAPSHOTS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM snap WHERE version = (SELECT max(version) FROM cut)
"""


ORACLE_SQL["gold_flatten"] = """
WITH day AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT l_orderkey AS id_weatherstation, l_partkey AS id_weatherstationsensor, d AS observation_date,
       l_quantity AS mean, l_discount AS min, l_tax AS max, l_extendedprice AS total
FROM day WHERE l_linestatus = 'F'
UNION ALL
SELECT l_orderkey, l_partkey, d, l_quantity + 1, l_tax, l_discount, l_extendedprice FROM day WHERE l_linestatus = 'F'
UNION ALL
SELECT l_orderkey, l_partkey, d + 1, l_quantity, l_discount, l_tax, l_extendedprice FROM day WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, l_partkey, d + 1, NULL, NULL, NULL, NULL FROM day WHERE l_returnflag = 'R'
"""

ORACLE_SQL["gold_flatten_api"] = ORACLE_SQL["gold_flatten"]

ORACLE_SQL["gold_sql_file"] = """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0
"""

ORACLE_SQL["gold_sql_file_agg"] = """
SELECT s_nationkey, count(*) AS suppliers, round(sum(s_acctbal), 2) AS total_acctbal FROM supplier GROUP BY s_nationkey
"""

ORACLE_SQL["gold_project"] = f"""
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate
FROM ({ORACLE_SQL["scd2_changes_composite"]}) WHERE __END_AT IS NULL
"""


ORACLE_SQL["bronze_file_date"] = r"""
WITH n AS (
  SELECT event_id,
         event_type || '_' || CASE WHEN event_id % 10 = 0 THEN strftime(ts, '%Y%m%d')
                                   ELSE strftime(ts, '%Y%m%d_%H%M%S') END || '.json' AS file_name
  FROM events
)
SELECT event_id, file_name,
       try_strptime(regexp_extract(file_name, '_(\d{8})_\d{6}\.json$', 1), '%Y%m%d') AS file_date
FROM n
"""

ORACLE_SQL["bronze_ingest"] = """
SELECT event_id, ts, user_id, event_type, value, props, date_trunc('day', ts)::TIMESTAMP AS file_date FROM events
"""

ORACLE_SQL["bronze_decimal"] = """
SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(38,2)) AS p_retailprice FROM part
"""

# Landed arrays: events of one day and of eight consecutive ids.
_ARRAYS = """
arrays AS (
  SELECT date_trunc('day', ts) AS landed, floor(event_id / 8) AS part, bool_or(event_id % 10 = 0) AS poisoned
  FROM events GROUP BY ALL
)"""

ORACLE_SQL["bronze_quarantine"] = f"""
WITH {_ARRAYS}
SELECT event_id, ts, user_id, event_type, value, props, NULL::VARCHAR AS _quarantine_reason FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'null_element' FROM arrays WHERE poisoned
"""

ORACLE_SQL["bronze_quarantine_native"] = f"""
WITH {_ARRAYS}
SELECT event_id, ts, user_id, event_type, value, props, NULL::VARCHAR AS _quarantine_reason
FROM events JOIN arrays ON landed = date_trunc('day', ts) AND part = floor(event_id / 8) WHERE NOT poisoned
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'corrupt_record' FROM arrays WHERE poisoned
"""

ORACLE_SQL["bronze_quarantine_missing"] = """
SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS event_id, user_id, event_type, value,
       CASE WHEN event_id % 7 = 0 THEN 'missing:event_id' END AS _quarantine_reason FROM events
"""

ORACLE_SQL["bronze_wrong_type"] = """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id, event_type,
       NULL::VARCHAR AS _quarantine_reason FROM events
"""

ORACLE_SQL["bronze_csv"] = """
SELECT event_id, ts, user_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 5 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN 'a, quoted' END AS props,
       CASE WHEN event_id % 5 = 0 THEN 'short_row' END AS _quarantine_reason FROM events
"""

ORACLE_SQL["bronze_lineage"] = """
SELECT event_id, 'events' AS file_key, strftime(ts, '%Y%m%d') AS file_day, true AS named, true AS sized, true AS stamped
FROM events
"""

ORACLE_SQL["table_scans"] = """
SELECT scan, event_id, user_id, event_type, value FROM events, (VALUES ('batch'), ('stream')) s(scan)
"""

ORACLE_SQL["rank_within_keys"] = """
SELECT o_custkey, o_orderdate, o_orderkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders
"""

ORACLE_SQL["scd2_stream"] = ORACLE_SQL["scd2_changes"]
ORACLE_SQL["silver_change_feed"] = ORACLE_SQL["scd2_changes"]


ORACLE_SQL["payload_extract"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type IS DISTINCT FROM 'error'
"""

ORACLE_SQL["request_plan"] = """
SELECT s_suppkey, 'readings' AS resource_key,
       '/readings/summarized/station/' || CAST(s_suppkey AS VARCHAR) || '/year/2024?month=12' AS endpoint,
       'https://api.example.test/meteo/readings/summarized/station/' || CAST(s_suppkey AS VARCHAR)
         || '/year/2024?month=12' AS url
FROM supplier
"""

ORACLE_SQL["child_concat"] = """
SELECT conv_id, turn * f AS turn, role FROM conversations, (VALUES (1), (-1)) s(f) WHERE turn % 4 <> 3
"""

ORACLE_SQL["resource_keys"] = """
SELECT s_suppkey,
       CASE s_suppkey % 4 WHEN 0 THEN '/measures' || s_suppkey WHEN 1 THEN '/stations' || s_suppkey || '/{idWeatherstation}/sensors'
         WHEN 2 THEN '/readings' || s_suppkey || '/station/{idWeatherstation}/year/{year}' ELSE 'plain' || s_suppkey END AS endpoint,
       CASE s_suppkey % 4 WHEN 0 THEN 'measures' || s_suppkey WHEN 1 THEN 'sensors'
         WHEN 2 THEN 'readings' || s_suppkey ELSE 'plain' || s_suppkey END AS resource_key
FROM supplier
"""

ORACLE_SQL["dependent_requests"] = """
SELECT n_nationkey * 10 + k AS area, 'sensors' AS resource_key, '/areas/' || (n_nationkey * 10 + k) || '/sensors' AS endpoint,
       'https://api.example.test/meteo/areas/' || (n_nationkey * 10 + k) || '/sensors' AS url
FROM nation, (VALUES (0), (1)) s(k)
"""


ORACLE_SQL["control_active"] = """
SELECT 'suppliers_1' AS operation_name, 'api_' || s_name AS ingestion_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'api' WHEN 1 THEN 'bronze' WHEN 2 THEN 'silver' ELSE 'gold' END
         AS operation_type,
       'bronze.t' || CAST(s_suppkey AS VARCHAR) AS target_table,
       '/landing/s' || CAST(s_suppkey AS VARCHAR) AS source_path,
       'json' AS file_format, '2' AS scd_type
FROM supplier WHERE s_nationkey % 3 = 1 AND s_acctbal > 0
"""

ORACLE_SQL["control_run"] = ORACLE_SQL["scd2_current"]

ORACLE_SQL["scd2_changes_segmented"] = ORACLE_SQL["scd2_changes"]

ORACLE_SQL["control_delete"] = """
SELECT 'suppliers_' || (s_nationkey % 3) AS operation_name,
       CASE WHEN k % 2 = 0 OR k % 5 <> 0 THEN 'api_' || s_name END AS ingestion_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'api' WHEN 1 THEN 'bronze' WHEN 2 THEN 'silver' ELSE 'gold' END AS operation_type,
       s_acctbal > 0 AS is_active
FROM (SELECT *, CAST(regexp_extract(s_name, '(\\d+)$', 1) AS INT) AS k FROM supplier)
WHERE k % 3 <> 0 OR (k % 2 = 1 AND k % 5 = 0)
"""

ORACLE_SQL["control_run_snapshot"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, '2025010' || (o_orderkey % 3 + 1) AS landed,
       (o_orderkey % 3 + 1)::INT AS __START_AT, NULL::INT AS __END_AT
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3, o_orderkey) = 1
"""

_NEWEST = """
SELECT o.*, v.version FROM orders o JOIN (VALUES (1), (2), (3)) v(version) ON o.o_orderkey % 3 + 1 <= v.version
QUALIFY row_number() OVER (PARTITION BY o_custkey, v.version ORDER BY o_orderkey % 3 DESC, o_orderkey DESC) = 1
"""

ORACLE_SQL["control_run_versions"] = f"""
WITH snap AS ({_NEWEST}),
flag AS (
  SELECT *, CASE WHEN o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS opens
  FROM snap WINDOW w AS (PARTITION BY o_custkey ORDER BY version)
), isl AS (
  SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY version ROWS UNBOUNDED PRECEDING) AS island FROM flag
), ver AS (
  SELECT *, min(version) OVER (PARTITION BY o_custkey, island) AS start_at FROM isl
  QUALIFY row_number() OVER (PARTITION BY o_custkey, island ORDER BY version DESC) = 1
)
SELECT o_orderkey, o_custkey, o_orderstatus, start_at::INT AS __START_AT,
       (lead(start_at) OVER (PARTITION BY o_custkey ORDER BY start_at))::INT AS __END_AT FROM ver
"""

ORACLE_SQL["control_run_scd1"] = f"""
SELECT kept_in, o_orderkey, o_custkey, o_orderstatus
FROM ({_NEWEST}), (VALUES ('table'), ('view')) s(kept_in) WHERE version = 3
"""

ORACLE_SQL["scd2_two_targets"] = f"""
SELECT 'by_user' AS target, user_id, event_type, __START_AT, __END_AT FROM ({ORACLE_SQL["scd2_changes"]})
UNION ALL
SELECT 'by_type', user_id, event_type, __START_AT, __END_AT FROM ({_islands(
    """SELECT * FROM events WHERE ts IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) = 1""",
    "event_type", "ts", "user_id", "user_id, event_type",
)})
"""

ORACLE_SQL["null_sequence"] = """
SELECT event_id, user_id, event_type, 'null_sequence' AS _quarantine_reason FROM events WHERE event_id % 9 = 0
"""

ORACLE_SQL["gold_stations"] = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"
ORACLE_SQL["gold_measures"] = "SELECT p_partkey, p_name, p_brand FROM part"
ORACLE_SQL["gold_sensors"] = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"

ORACLE_SQL["bronze_csv_lengths"] = """
SELECT event_id, user_id,
       CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'x, y, z, and, more' ELSE event_type END AS event_type,
       CASE event_id % 10 WHEN 0 THEN 'short_row' WHEN 1 THEN 'short_row' WHEN 2 THEN 'long_row' END AS _quarantine_reason
FROM events
"""

ORACLE_SQL["gold_cte_names"] = """
SELECT n.s_nationkey AS nation, n.suppliers, count(*) AS customers, round(sum(c_acctbal), 2) AS acctbal
FROM (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey) n
JOIN customer ON c_nationkey = n.s_nationkey AND c_acctbal > 0 AND c_acctbal <> n.s_nationkey
GROUP BY n.s_nationkey, n.suppliers
"""

ORACLE_SQL["schema_change"] = """
WITH feed AS (
  SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events
), marked AS (
  SELECT *, (lag(event_type) OVER w IS DISTINCT FROM event_type OR lag(value) OVER w IS DISTINCT FROM value OR lag(ts) OVER w IS NULL)::INT AS opens
  FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS version FROM marked
), versions AS (
  SELECT user_id, version, min(ts) AS since, arg_max(event_id, ts) AS event_id, min(event_type) AS event_type, min(value) AS value
  FROM numbered GROUP BY user_id, version
)
SELECT 'history' AS target, user_id, event_id, event_type, value, since, lead(since) OVER (PARTITION BY user_id ORDER BY since) AS until FROM versions
UNION ALL
SELECT 'now', user_id, event_id, event_type, value, ts, NULL FROM feed QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
"""

ORACLE_SQL["gold_readings"] = """
WITH measured AS (
  SELECT o_orderkey, o_custkey, o_orderdate::DATE + d AS day, k, o_totalprice, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS shift
  FROM orders, (VALUES (0, 1), (0, 2), (1, 3)) AS m(d, k)
  WHERE CASE WHEN d = 0 THEN o_orderstatus = 'F' ELSE o_orderkey % 2 = 0 END
)
SELECT o_orderkey AS id_weatherstation, o_custkey AS id_weatherstationsensor, day AS observation_date,
       o_totalprice * k + shift AS mean, o_totalprice AS min, o_totalprice * 2 AS max, k::DOUBLE AS total
FROM measured
"""


ORACLE_SQL["control_rejected"] = """
SELECT 'row_' || s_suppkey AS ingestion_name, f.operation_type, f.reason
FROM supplier JOIN (VALUES
    (3, 'bronze', 'no source_path'), (4, 'bronze', 'no schema'), (5, 'silver', 'no cdc_parameters'), (6, 'silver', 'unknown cdc_type'),
    (7, 'silver', 'no keys'), (8, 'silver', 'unknown scd_type'), (9, 'silver', 'no sequence_by'), (10, 'silver', 'no order_keys'),
    (11, 'gold', 'no sql_file_path'), (12, 'gold', 'parameters are no JSON object'), (13, 'silver', 'no sequence_by'),
    (14, 'silver', 'parameters are no JSON object')
) f(form, operation_type, reason) ON s_suppkey % 16 = f.form
"""
