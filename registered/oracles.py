"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from registered.relations import FIRST_RUN, RUN_TS, with_relations

USER_COLUMNS = (
    "surrogate_user_key, user_id, user_name, country, subscription_type, source_start_date, "
    "source_end_date, source_updated_at, start_date, end_date, is_current, attribute_hash, "
    "record_start_ts, record_end_ts"
)
ARTIST_COLUMNS = (
    "surrogate_artist_key, artist_id, artist_name, genre, country, source_updated_at, start_date, "
    "end_date, is_current, attribute_hash, record_start_ts, record_end_ts"
)

CALENDAR = """
  CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, CAST(day(date) AS INTEGER) AS day,
  CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
  dayname(date) AS weekday"""


def fact(users: str, artists: str) -> str:
    """The resolved fact over the given dimensions."""
    return f"""
SELECT f.stream_id, f.user_id, f.track_id, t.artist_id, f.date_key, f.listen_duration,
       f.device_type, f.stream_timestamp, f.event_date, u.surrogate_user_key AS user_key,
       a.surrogate_artist_key AS artist_key,
       CASE WHEN t.track_id IS NOT NULL THEN sha256(CAST(t.track_id AS VARCHAR) || '||' || CAST(t.updated_at AS VARCHAR)) END AS track_key,
       sha256(CAST(f.date_key AS VARCHAR)) AS date_dim_key
FROM streams f
LEFT JOIN tracks t ON f.track_id = t.track_id
LEFT JOIN {users} u ON f.user_id = u.user_id AND u.is_current
LEFT JOIN {artists} a ON t.artist_id = a.artist_id AND a.is_current"""


CHECKED = """
, checked_streams AS (
  SELECT * REPLACE (CASE WHEN device_type <> 'error' THEN user_id END AS user_id) FROM streams),
checked_users AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal >= 0),
checked_tracks AS (SELECT track_id FROM tracks WHERE artist_id > 5),
null_counts AS (
  SELECT 'FactStream' AS table_name, 'stream_id' AS k, count(*) FILTER (stream_id IS NULL) AS n, count(*) AS total FROM checked_streams
  UNION ALL SELECT 'FactStream', 'user_id', count(*) FILTER (user_id IS NULL), count(*) FROM checked_streams
  UNION ALL SELECT 'DimUser', 'user_id', count(*) FILTER (user_id IS NULL), count(*) FROM checked_users
  UNION ALL SELECT 'DimTrack', 'track_id', count(*) FILTER (track_id IS NULL), count(*) FROM checked_tracks),
pk_nulls AS (
  SELECT table_name, 'pk_null_rate_' || k AS check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
         'column=' || k || ', null_rows=' || n || ', total_rows=' || total || ', null_rate='
         || CAST(round(CASE WHEN total = 0 THEN 0 ELSE n * 100.0::DOUBLE / total END, 4) AS VARCHAR) || '%' AS details
  FROM null_counts),
previous AS (
  SELECT 'FactStream' AS table_name, count(*) FILTER (device_type IN ('view', 'click')) AS p FROM streams
  UNION ALL SELECT 'DimUser', 0),
drift AS (
  SELECT c.table_name, c.total, p.p, abs(c.total - p.p) / nullif(p.p, 0)::DOUBLE * 100 AS pct
  FROM (SELECT DISTINCT table_name, total FROM null_counts) c LEFT JOIN previous p ON c.table_name = p.table_name),
row_drift AS (
  SELECT table_name, 'row_count_delta_check' AS check_name, CASE WHEN pct > 50 THEN 'WARNING' ELSE 'PASS' END AS status,
         'current_count=' || total || ', previous_count=' || coalesce(CAST(p AS VARCHAR), 'None')
         || CASE WHEN pct IS NULL THEN '' ELSE ', delta_pct=' || CAST(round(pct, 2) AS VARCHAR) END AS details
  FROM drift),
orphan_users AS (
  SELECT DISTINCT user_id FROM checked_streams s
  WHERE NOT EXISTS (SELECT 1 FROM checked_users u WHERE u.user_id = s.user_id)),
orphan_tracks AS (
  SELECT DISTINCT track_id FROM checked_streams s
  WHERE NOT EXISTS (SELECT 1 FROM checked_tracks u WHERE u.track_id = s.track_id)),
fk_checks AS (
  SELECT 'FactStream' AS table_name, 'referential_integrity_user_id' AS check_name,
         CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'orphan_user_ids=' || count(*) AS details FROM orphan_users
  UNION ALL
  SELECT 'FactStream', 'referential_integrity_track_id',
         CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 'orphan_track_ids=' || count(*) FROM orphan_tracks)
"""

ALL_CHECKS = """
SELECT * FROM pk_nulls UNION ALL SELECT * FROM row_drift UNION ALL SELECT * FROM fk_checks"""

# Without earlier runs every user and artist is new in the full run.
FRESH = f"""
, fresh_users AS (
  SELECT user_id, sha256(CAST(user_id AS VARCHAR) || '||{RUN_TS}') AS surrogate_user_key, true AS is_current FROM users),
fresh_artists AS (
  SELECT artist_id, sha256(CAST(artist_id AS VARCHAR) || '||{RUN_TS}') AS surrogate_artist_key, true AS is_current FROM artists)
"""

RUN_LOG = """
SELECT ts AS event_timestamp, 'silver_ingestion' AS notebook_name, event_type AS table_name,
       user_id AS rows_read, user_id AS rows_written, value AS duration_seconds,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(NULL AS VARCHAR) AS error_message, CAST(event_id AS VARCHAR) AS batch_id,
       'interactive' AS run_id
FROM events"""

WINDOWS = """
SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end,
       count(*) AS failed_runs
FROM events WHERE event_type = 'error' GROUP BY ALL"""

TRACK_KEY = "sha256(CAST(track_id AS VARCHAR) || '||' || CAST(updated_at AS VARCHAR))"

ORACLES: dict[str, str] = {
    "incremental_extract": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
    "extract_watermark": """
SELECT max(o_orderdate) AS max_cdc, count(*) AS row_count
FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'""",
    # The watermark text has whole seconds, so the later runs find the rows of the last
    # second whose time has a fraction.
    "extract_to_bronze": """
SELECT 'orders' AS table_name, max(o_orderdate) AS last_load_timestamp,
       count(*) FILTER (o_orderdate > (SELECT date_trunc('second', max(o_orderdate)) FROM orders)) AS last_row_count,
       'SUCCESS' AS load_status,
       count(*) + 2 * count(*) FILTER (o_orderdate > (SELECT date_trunc('second', max(o_orderdate)) FROM orders)) AS landed_rows
FROM orders
UNION ALL
SELECT 'events', max(ts), count(*) FILTER (ts > (SELECT date_trunc('second', max(ts)) FROM events)), 'SUCCESS',
       count(*) + 2 * count(*) FILTER (ts > (SELECT date_trunc('second', max(ts)) FROM events))
FROM events""",
    "equal_depth_ranges": "SELECT 16 AS ranges, count(*) AS orders, count(*) AS in_ranges, true AS within_two FROM orders",
    "ingest_work_list": with_relations("""
SELECT c_mktsegment AS schema_name, c_name AS table_name, 'o_orderdate' AS cdc_column,
       strftime(coalesce(w.last_load_timestamp, TIMESTAMP '1900-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S') AS watermark_date
FROM customer LEFT JOIN watermarks w ON c_name = w.table_name WHERE c_acctbal >= 0 ORDER BY 2"""),
    "watermark_upsert": with_relations(f"""
, updates AS (
  SELECT table_name, CASE WHEN orders > 1 THEN newest END AS ts, CASE WHEN orders <> 2 THEN orders END AS n,
         CASE WHEN largest > 400000 THEN 'FAILED' ELSE 'SUCCESS' END AS st
  FROM loads WHERE status = 'O')
SELECT coalesce(w.table_name, u.table_name) AS table_name,
       CASE WHEN u.st = 'SUCCESS' AND u.ts IS NOT NULL THEN u.ts ELSE w.last_load_timestamp END AS last_load_timestamp,
       CASE WHEN u.st = 'SUCCESS' AND u.n IS NOT NULL THEN u.n ELSE w.last_row_count END AS last_row_count,
       coalesce(u.st, w.load_status) AS load_status,
       CASE WHEN u.st IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE w.last_updated_at END AS last_updated_at,
       w.table_row_count
FROM watermarks w FULL JOIN updates u ON w.table_name = u.table_name"""),
    "config_upsert": """
SELECT c_mktsegment AS schema_name, c_name AS table_name,
       CASE WHEN c_acctbal > -500 THEN 'o_orderkey' ELSE 'o_orderdate' END AS cdc_column,
       c_acctbal > -500 OR c_acctbal >= 0 AS is_active
FROM customer WHERE c_acctbal < 5000 OR c_acctbal > -500""",
    "seed_absent_watermarks": with_relations(f"""
SELECT * FROM watermarks UNION ALL
SELECT c_name, TIMESTAMP '1900-01-01 00:00:00', 0, 'PENDING', TIMESTAMP '{RUN_TS}', NULL
FROM customer WHERE c_name NOT IN (SELECT table_name FROM watermarks)"""),
    "conform_user": with_relations("""
SELECT user_id, upper(user_name) AS user_name, country, subscription_type,
       source_start_date AS start_date, source_end_date AS end_date, source_updated_at AS updated_at
FROM users"""),
    "conform_track": with_relations(
        "SELECT * REPLACE (regexp_replace(track_name, '-', ' ', 'g') AS track_name) FROM tracks"
    ),
    "conform_fact": with_relations("SELECT * FROM streams"),
    "latest_lineitem": with_relations("SELECT * FROM latest_lines"),
    "latest_order_per_customer": """
SELECT * FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "keyed_upsert": with_relations("SELECT * FROM merged_lines"),
    "keyed_upsert_guarded": with_relations("""
SELECT * FROM (SELECT * FROM stored_lines UNION ALL SELECT * FROM incoming_lines)
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_linestatus DESC) = 1"""),
    "merge_metrics": with_relations("""
SELECT count(*) FILTER (s.l_orderkey IS NULL) AS rows_inserted,
       count(s.l_orderkey) AS rows_updated, count(*) AS rows_written
FROM incoming_lines i LEFT JOIN stored_lines s
  ON i.l_orderkey = s.l_orderkey AND i.l_linenumber = s.l_linenumber"""),
    "expire_matched": """
SELECT o_orderkey, o_custkey,
       CASE WHEN hit THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN hit THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, o_orderstatus = 'O' AND o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS hit FROM orders)""",
    "upsert_moves_partition": with_relations(
        "SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM merged_lines"
    ),
    "upsert_bucketed": with_relations("SELECT * FROM merged_lines"),
    "last_operation_metrics": with_relations("""
SELECT 'lines' AS table_name, 2 AS version, 'UPSERT' AS operation, count(*) AS rows_read,
       count(*) FILTER (s.l_orderkey IS NULL) AS rows_inserted, count(s.l_orderkey) AS rows_updated
FROM incoming_lines i LEFT JOIN stored_lines s
  ON i.l_orderkey = s.l_orderkey AND i.l_linenumber = s.l_linenumber
UNION ALL SELECT 'closed_lines', 1, 'CREATE', count(*), count(*), 0 FROM stored_lines"""),
    "stream_replayed": with_relations("""
SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F') AS rows_read,
       (SELECT count(*) FROM stored_lines) AS rows_written, 'SUCCESS' AS status, '0' AS batch_id, 1 AS snapshots"""),
    "stream_upsert": with_relations("SELECT * FROM merged_lines"),
    "stream_batch_cuts": with_relations("SELECT * FROM latest_lines"),
    "stream_schema_guard": with_relations("""
SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F') AS rows_read,
       (SELECT count(*) FROM stored_lines) AS rows_written, 'SUCCESS' AS status, false AS names_column
UNION ALL SELECT 'lineitem', 0, 0, 'FAILED', true"""),
    "rescued_rows": """
SELECT * EXCLUDE (bad) REPLACE (CASE WHEN bad THEN NULL ELSE o_custkey END AS o_custkey),
       CASE WHEN bad THEN '{"o_custkey":"C' || o_custkey || '"}' END AS _rescued_data
FROM (SELECT *, o_orderstatus = 'O' AND o_totalprice > 250000 AS bad FROM orders)""",
    "config_specs": """
SELECT 'orders' AS table_name, 'shop' AS schema_name, 'o_orderdate' AS order_column, max(o_orderdate) AS newest,
       count(DISTINCT o_orderkey) AS distinct_keys FROM orders
UNION ALL SELECT 'lineitem', 'dbo', 'l_shipdate', max(l_shipdate), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'events', 'dbo', 'value', max(ts), count(DISTINCT event_id) FROM events""",
    "seed_upsert": """
SELECT r_regionkey, r_name FROM region WHERE r_regionkey NOT IN (1, 9)
UNION ALL SELECT 1, 'AMERICAS' UNION ALL SELECT 9, 'ATLANTIS'""",
    "rescued_lossy": """
SELECT event_id, CASE WHEN NOT ts_bad THEN CAST(ts AS DATE) END AS ts, CASE WHEN NOT value_bad THEN CAST(value AS BIGINT) END AS value,
       CASE WHEN NOT amount_bad THEN CAST(wide AS DOUBLE) END AS amount,
       ts_bad AS ts_rescued, value_bad AS value_rescued, amount_bad AS amount_rescued
FROM (SELECT *, coalesce(ts <> CAST(ts AS DATE), false) AS ts_bad, coalesce(value <> trunc(value), false) AS value_bad,
             coalesce(wide <> CAST(wide AS DECIMAL(14,1)), false) AS amount_bad
      FROM (SELECT *, CAST(value AS DECIMAL(14,3)) AS wide FROM events))""",
    "user_attribute_hash": with_relations("""
SELECT user_id, sha256(concat_ws('||', user_name, country, subscription_type)) AS attribute_hash FROM users"""),
    "artist_attribute_hash": with_relations("""
SELECT artist_id, sha256(concat_ws('||', artist_name, genre, country)) AS attribute_hash FROM artists"""),
    "scd2_changes_user": with_relations(f"SELECT {USER_COLUMNS} FROM dim_user_changes"),
    "scd2_changes_artist": with_relations(f"SELECT {ARTIST_COLUMNS} FROM dim_artist_changes"),
    "scd2_user": with_relations(f"SELECT {USER_COLUMNS} FROM dim_user_second"),
    "scd2_artist": with_relations(f"SELECT {ARTIST_COLUMNS} FROM dim_artist_second"),
    "scd2_second_run_noop": with_relations(f"SELECT {USER_COLUMNS} FROM dim_user_second"),
    "scd2_published": with_relations(f"SELECT {USER_COLUMNS} FROM dim_user_second"),
    "scd2_published_missing": with_relations(f"""
SELECT u.user_id, u.subscription_type, DATE '{FIRST_RUN[:10]}' AS start_date,
       CASE WHEN e.user_id IS NULL OR e.subscription_type IS DISTINCT FROM u.subscription_type THEN DATE '{RUN_TS[:10]}' END AS end_date,
       e.user_id IS NOT NULL AND e.subscription_type IS NOT DISTINCT FROM u.subscription_type AS is_current
FROM users u LEFT JOIN earlier_users e ON u.user_id = e.user_id
UNION ALL
SELECT e.user_id, e.subscription_type, DATE '{RUN_TS[:10]}', NULL, true
FROM users u JOIN earlier_users e ON u.user_id = e.user_id
WHERE e.subscription_type IS DISTINCT FROM u.subscription_type"""),
    "dim_user_history": with_relations(f"SELECT {USER_COLUMNS} FROM dim_user_second"),
    "dim_artist_history": with_relations(f"SELECT {ARTIST_COLUMNS} FROM dim_artist_second"),
    "dim_track_flag": with_relations("""
SELECT *, CASE WHEN duration_sec < 150 THEN 'low' WHEN duration_sec < 300 THEN 'medium' ELSE 'high' END AS "durationFlag"
FROM tracks"""),
    "dim_date_calendar": f"""
SELECT {CALENDAR}, CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS fiscal_year,
       CAST(weekofyear(date) AS INTEGER) AS week_number, dayofweek(date) IN (0, 6) AS is_weekend,
       CAST(dayofyear(date) AS INTEGER) AS day_of_year
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)""",
    "track_keys": with_relations(f"SELECT track_id, artist_id, {TRACK_KEY} AS track_key FROM tracks"),
    "date_keys": """
SELECT CAST(k AS INTEGER) AS date_key, sha256(k) AS date_dim_key
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS k FROM orders)""",
    "fact_resolved": with_relations(fact("dim_user_second", "dim_artist_second")),
    "fact_required": with_relations("SELECT * FROM streams WHERE user_id IS NOT NULL AND listen_duration > 0"),
    "fact_expectations": with_relations("""
, shortened AS (SELECT * REPLACE (nullif(listen_duration - 2, 5) AS listen_duration) FROM streams)
SELECT 'user_id_not_null' AS expectation, count(*) FILTER (user_id IS NULL) AS violations FROM shortened
UNION ALL SELECT 'listen_duration_positive', count(*) FILTER (NOT coalesce(listen_duration > 0, false)) FROM shortened
UNION ALL SELECT 'track_id_small', count(*) FILTER (NOT coalesce(track_id < 50, false)) FROM shortened"""),
    "declared_join": with_relations("""
SELECT factstream.stream_id, factstream.listen_duration, dimuser.user_id, dimuser.user_name,
       dimtrack.track_id, dimtrack.track_name
FROM streams AS factstream
LEFT JOIN users AS dimuser ON factstream.user_id = dimuser.user_id
LEFT JOIN tracks AS dimtrack ON factstream.track_id = dimtrack.track_id"""),
    "declared_range_join": with_relations("""
SELECT f.stream_id, f.listen_duration, t.track_name, t.duration_sec
FROM streams f LEFT JOIN tracks t ON f.track_id = t.track_id AND f.listen_duration < t.duration_sec"""),
    "declared_or_join": with_relations("""
SELECT f.stream_id, f.device_type, t.track_id, t.album_name
FROM streams f LEFT JOIN tracks t ON f.track_id = t.track_id
  AND (f.listen_duration > t.duration_sec OR f.device_type = 'or' OR t.album_name LIKE '%1')"""),
    "fact_refreshed": with_relations(fact("dim_user_second", "dim_artist_second")),
    "full_run_fact": with_relations(FRESH + fact("fresh_users", "fresh_artists")),
    "pk_null_checks": with_relations(CHECKED + "SELECT * FROM pk_nulls"),
    "row_drift": with_relations(CHECKED + "SELECT * FROM row_drift"),
    "fk_checks": with_relations(CHECKED + "SELECT * FROM fk_checks"),
    "fk_orphans": with_relations(CHECKED + "SELECT user_id AS orphan_key FROM orphan_users"),
    "quality_log": with_relations(CHECKED + ALL_CHECKS),
    "quality_incremental": with_relations(CHECKED + ALL_CHECKS),
    "quality_run": with_relations(CHECKED + ALL_CHECKS),
    "run_log_listing": RUN_LOG + " ORDER BY event_timestamp DESC",
    "run_log_recent": RUN_LOG + " ORDER BY event_timestamp DESC, table_name, batch_id LIMIT 20",
    "failed_run_windows": f"SELECT * FROM ({WINDOWS}) WHERE failed_runs > 1",
    "failure_alerts_stream": f"SELECT window_start, window_end FROM ({WINDOWS}) WHERE failed_runs > 1",
    "failed_run_windows_stream": f"""
SELECT * FROM ({WINDOWS})
WHERE window_end <= (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 10 MINUTES""",
}
