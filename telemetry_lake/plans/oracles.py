"""The same results as ``queries`` in SQL over the tables, for comparison."""

from __future__ import annotations

# The telemetry view of ``events``.
TELEMETRY = """
raw_events AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events
), tel AS (
  SELECT
    CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "timestamp",
    CAST(event_id AS VARCHAR) AS event_id,
    '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS src_ip,
    '172.16.0.' || CAST(event_id % 20 AS VARCHAR) AS dst_ip,
    CAST(1024 + k AS INTEGER) AS src_port,
    CAST(CASE WHEN event_type = 'purchase' AND value >= 100 THEN 53
              WHEN event_type = 'view' THEN 20 + k ELSE 443 END AS INTEGER) AS dst_port,
    CASE WHEN event_type = 'purchase' AND value >= 100 THEN 'UDP' ELSE 'TCP' END AS protocol,
    CAST(round(value * 100) AS BIGINT) * 1000 AS bytes_sent,
    CAST(k AS BIGINT) * 100 AS bytes_received,
    CAST(CASE WHEN event_type = 'error' THEN 2000 + 50 * k ELSE 10 + k % 40 END AS INTEGER) AS latency_ms,
    CAST(k + 5 AS INTEGER) AS packets_sent,
    CASE WHEN event_type = 'error' THEN 'RST,ACK' WHEN event_type = 'view' THEN 'SYN'
         ELSE 'ACK,PSH' END AS flags,
    'HTTP/1.1' AS app_protocol,
    'GET' AS method,
    event_type AS host,
    CAST(CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS INTEGER) AS status_code,
    'prod' AS env,
    'us-east-1' AS region,
    '' AS security_group,
    ts, k, event_type
  FROM raw_events
)"""

FLAT = """"timestamp", event_id, src_ip, dst_ip, src_port, dst_port, protocol, bytes_sent, bytes_received,
latency_ms, packets_sent, flags, app_protocol, method, host, status_code, env, region, security_group"""

SILVER = """
silver AS (
  SELECT "timestamp", event_id, src_ip, dst_ip, bytes_sent, latency_ms, ts AS parsed_timestamp,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day
  FROM tel
)"""

GOLD = """
gold AS (
  SELECT year, month, day, src_ip, CAST(SUM(bytes_sent) AS BIGINT) AS total_bytes_transferred,
         COUNT(event_id) AS total_connections
  FROM silver GROUP BY year, month, day, src_ip
)"""

# Windows of a day sliding by four hours: every event lies in six.
WINDOWS = """
spread AS (
  SELECT src_ip, bytes_sent,
         time_bucket(INTERVAL '4 hours', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '4 hours' AS window_start
  FROM {source}, range(6) r(i)
), windows AS (
  SELECT src_ip, window_start, window_start + INTERVAL '24 hours' AS window_end,
         CAST(SUM(bytes_sent) AS BIGINT) AS total_bytes, COUNT(*) AS packet_count,
         CAST(SUM(bytes_sent) AS BIGINT) / 86400 AS avg_bytes_per_sec
  FROM spread GROUP BY src_ip, window_start
), alerts AS (
  SELECT *, 'DATA EXFILTRATION DETECTED! IP: ' || src_ip || ' transferred '
            || CAST(total_bytes AS VARCHAR) || ' bytes in 86400s.' AS message
  FROM windows WHERE total_bytes > 50000000
)"""

# The chain of sent alerts per source; {ok} tells whether a delivery at time t sets the lock.
FIRES = """
fires AS (
  SELECT src_ip, MIN(window_end) AS t FROM alerts GROUP BY src_ip
  UNION ALL
  SELECT a.src_ip, MIN(a.window_end) AS t
  FROM fires f JOIN alerts a ON a.src_ip = f.src_ip
   AND a.window_end > f.t AND (NOT ({ok}) OR a.window_end >= f.t + INTERVAL '8 hours')
  GROUP BY a.src_ip
), fired AS (
  SELECT a.* FROM alerts a JOIN fires f ON a.src_ip = f.src_ip AND a.window_end = f.t
)"""

TRAFFIC = """
traffic AS (
  SELECT event_id, src_ip, ts, bytes_sent, CAST(latency_ms AS BIGINT) AS latency_ms FROM tel
), spine AS (
  SELECT ts + INTERVAL '15 minutes' AS event_timestamp, src_ip,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS label_is_anomaly
  FROM tel
)"""

LATEST = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src_ip ORDER BY ts DESC, event_id DESC) AS rn
  FROM traffic WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-20'
), latest AS (
  SELECT src_ip, ts AS event_timestamp, bytes_sent, latency_ms FROM ranked WHERE rn = 1
)"""

# What the injected defects (told by k) mean for validation.
REASONS = """
CASE k WHEN 0 THEN 'not_json' WHEN 1 THEN 'src_ip: missing' WHEN 2 THEN 'bytes_sent: missing'
       WHEN 3 THEN 'src_ip: wrong type' {text_number} WHEN 5 THEN 'bytes_sent: wrong type'
       WHEN 6 THEN 'flags: wrong type' WHEN 7 THEN 'app_layer.status_code: missing'
       WHEN 9 THEN 'timestamp: wrong type' WHEN 11 THEN 'tags: missing' END"""
LAX = REASONS.format(text_number="")
STRICT = REASONS.format(text_number="WHEN 4 THEN 'bytes_sent: wrong type'")

_VALID = f"""
SELECT CASE WHEN k = 10 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE "timestamp" END AS "timestamp",
       {FLAT.replace('"timestamp", ', '')}
FROM tel WHERE {LAX} IS NULL"""


def _with(select: str, *parts: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {','.join((TELEMETRY, *parts))} {select}"


def _windows(source: str = "tel") -> str:
    return WINDOWS.format(source=source)


def _rejects(reasons: str) -> str:
    return _with(f"SELECT event_id, {reasons} AS reasons FROM tel WHERE {reasons} IS NOT NULL")


def _fired(select: str, ok: str = "TRUE") -> str:
    return _with(select, _windows(), FIRES.format(ok=ok), recursive=True)


def _rates() -> str:
    return _with("""
SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS events,
       AVG(CASE WHEN latency_ms >= 2000 THEN 1 ELSE 0 END) AS latency_spike_rate,
       AVG(CASE WHEN bytes_sent >= 10000000 AND dst_port = 53 AND protocol = 'UDP' THEN 1 ELSE 0 END)
         AS exfiltration_rate,
       AVG(CASE WHEN flags LIKE '%RST%' OR status_code >= 500 THEN 1 ELSE 0 END) AS connection_reset_rate
FROM tel GROUP BY 1""")


_SCAN = _with("""
SELECT src_ip, '172.16.0' AS dst_ip, date_trunc('day', ts)::TIMESTAMP AS window_start,
       date_trunc('day', ts)::TIMESTAMP + INTERVAL '1 day' AS window_end,
       COUNT(DISTINCT dst_port) AS distinct_ports, COUNT(*) AS packets
FROM tel WHERE flags = 'SYN' GROUP BY 1, 2, 3, 4 HAVING COUNT(DISTINCT dst_port) >= 3""")

_EPS = _with("SELECT date_trunc('second', ts) AS \"second\", COUNT(*) AS events FROM tel GROUP BY 1")

_TALKERS = """
SELECT src_ip, CAST(SUM(bytes_sent) AS BIGINT) AS total_bytes FROM tel
GROUP BY src_ip ORDER BY total_bytes DESC, src_ip LIMIT 10"""

_PIT = _with("""
SELECT s.*,
  CASE WHEN f.ts >= s.event_timestamp - INTERVAL '1 day' THEN f.bytes_sent END AS bytes_sent,
  CASE WHEN f.ts >= s.event_timestamp - INTERVAL '1 day' THEN f.latency_ms END AS latency_ms
FROM spine s ASOF LEFT JOIN traffic f ON s.src_ip = f.src_ip AND s.event_timestamp >= f.ts""", TRAFFIC)


def _lookup(condition: str) -> str:
    return _with(f"""
SELECT q.src_ip, CASE WHEN {condition} THEN l.bytes_sent END AS bytes_sent,
       CASE WHEN {condition} THEN l.latency_ms END AS latency_ms
FROM (SELECT DISTINCT src_ip FROM spine UNION ALL SELECT DISTINCT 'x' || src_ip FROM spine) q
LEFT JOIN latest l ON q.src_ip = l.src_ip""", TRAFFIC, LATEST)


_GOLD = _with("SELECT * FROM gold", SILVER, GOLD)
_ALERTS = _with("SELECT * FROM alerts", _windows())
_WINDOWS = _with("SELECT * FROM windows", _windows())
_FLAT = _with(f"SELECT {FLAT} FROM tel")
_SILVER = _with("SELECT * FROM silver", SILVER)
_LATEST = _with("SELECT * FROM latest", TRAFFIC, LATEST)

ORACLES: dict[str, str] = {
    "telemetry_view": _FLAT,
    "ingest_valid": _with(_VALID),
    "ingest_rejects": _rejects(LAX),
    "ingest_rejects_strict": _rejects(STRICT),
    "reject_reason_counts": _with(
        f"SELECT {LAX} AS reason, COUNT(*) AS records FROM tel WHERE {LAX} IS NOT NULL GROUP BY 1"
    ),
    "landing_stream": _with(_VALID),
    "landing_restart": _with(_VALID),
    "landing_archived": _with("SELECT event_id, src_ip, bytes_sent, day(ts) <= 20 AS archived FROM tel"),
    "landing_stream_rejects": _rejects(LAX),
    "scalar_functions": _with("""
SELECT event_id, ts AS from_iso, date_trunc('second', ts) AS from_epoch, date_trunc('millisecond', ts) AS from_millis,
       make_timestamp(CAST(event_id AS BIGINT) * 1000000) AS from_id, CAST(NULL AS TIMESTAMP) AS from_text,
       "timestamp" AS iso, epoch_us(ts) // 1000 AS millis, ts - INTERVAL '15 minutes' AS quarter_before,
       'alert:throttle:' || src_ip AS lock_key, host AS decoded
FROM tel"""),
    "json_records": _with("""
SELECT '{"timestamp":"' || "timestamp" || '","event_id":"' || event_id || '","src_ip":"' || src_ip
       || '","bytes_sent":' || CAST(bytes_sent AS VARCHAR) || ',"flags":["' || replace(flags, ',', '","')
       || '"],"tags":{"env":"prod","region":"us-east-1","security_group":""}}' AS value
FROM tel"""),
    "raw_json_roundtrip": _FLAT,
    "bronze_incremental": _FLAT,
    "silver": _SILVER,
    "silver_dedupe": _SILVER,
    "silver_partition_prune": _with(
        "SELECT * FROM silver WHERE parsed_timestamp >= TIMESTAMP '2024-01-10' "
        "AND parsed_timestamp < TIMESTAMP '2024-01-17'",
        SILVER,
    ),
    "silver_dynamic_overwrite": _with(
        "SELECT * REPLACE (CASE WHEN day = 15 THEN bytes_sent * 2 ELSE bytes_sent END AS bytes_sent) FROM silver",
        SILVER,
    ),
    "gold_daily_ip": _GOLD,
    "lake_gold": _GOLD,
    "lake_touched_refresh": _GOLD,
    "lake_daily_refresh": _with("SELECT * FROM gold", SILVER.replace(
        "FROM tel", "FROM tel WHERE NOT ends_with(event_id, '7') OR day(ts) BETWEEN 10 AND 20"), GOLD),
    "gold_upsert": _with("""
SELECT COALESCE(n.year, o.year) AS year, COALESCE(n.month, o.month) AS month, COALESCE(n.day, o.day) AS day,
       COALESCE(n.src_ip, o.src_ip) AS src_ip,
       COALESCE(n.total_bytes_transferred * 2, o.total_bytes_transferred) AS total_bytes_transferred,
       COALESCE(n.total_connections, o.total_connections) AS total_connections
FROM (SELECT * FROM gold WHERE day <= 15) o FULL JOIN (SELECT * FROM gold WHERE day >= 10) n
  ON o.year = n.year AND o.month = n.month AND o.day = n.day AND o.src_ip = n.src_ip""", SILVER, GOLD),
    "top_ip_days": _with(
        "SELECT * FROM gold ORDER BY total_bytes_transferred DESC, year, month, day, src_ip LIMIT 5", SILVER, GOLD
    ),
    "top_talkers": _with(_TALKERS),
    "top_talkers_raw_json": _with(_TALKERS),
    "top10_per_day": _with("""
SELECT *, CAST(row_number() OVER (PARTITION BY year, month, day ORDER BY total_bytes_transferred DESC, src_ip)
          AS INTEGER) AS rank
FROM gold QUALIFY rank <= 10""", SILVER, GOLD),
    "top10_anomalous_per_day": _with("""
SELECT *, CAST(row_number() OVER (PARTITION BY year, month, day ORDER BY anomalies DESC, src_ip) AS INTEGER) AS rank
FROM (
  SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         src_ip, COUNT(*) AS anomalies, CAST(SUM(bytes_sent) AS BIGINT) AS anomalous_bytes
  FROM tel
  WHERE latency_ms >= 2000 OR (bytes_sent >= 10000000 AND dst_port = 53 AND protocol = 'UDP')
     OR flags LIKE '%RST%' OR status_code >= 500
  GROUP BY 1, 2, 3, 4
) QUALIFY rank <= 10"""),
    "sliding_bandwidth": _WINDOWS,
    "sliding_bandwidth_panes": _WINDOWS,
    "sliding_bandwidth_minute": _with("""
SELECT src_ip, window_start, window_start + INTERVAL '60 seconds' AS window_end,
       CAST(SUM(bytes_sent) AS BIGINT) AS total_bytes, COUNT(*) AS packet_count,
       CAST(SUM(bytes_sent) AS BIGINT) / 60 AS avg_bytes_per_sec
FROM (
  SELECT src_ip, bytes_sent,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '10 seconds' AS window_start
  FROM tel, range(6) r(i)
) GROUP BY src_ip, window_start"""),
    "exfil_alerts": _ALERTS,
    "exfil_alerts_stream": _ALERTS,
    "detect_text_stream": _with("SELECT * FROM alerts", """
parsed AS (
  SELECT CASE k WHEN 3 THEN '12' ELSE src_ip END AS src_ip,
         CASE k WHEN 2 THEN 0 ELSE bytes_sent END AS bytes_sent,
         CASE k WHEN 10 THEN date_trunc('second', ts) ELSE ts END AS ts
  FROM tel WHERE k NOT IN (0, 1, 9)
)""", _windows("parsed")),
    "alert_throttle": _fired("SELECT * FROM fired"),
    "alert_throttle_ordered": _fired("SELECT * FROM fired"),
    "alert_throttle_stream": _fired("SELECT * FROM fired"),
    "alert_throttle_retry": _fired(
        "SELECT *, hour(window_end) >= 8 AS delivered FROM fired", "hour(f.t) >= 8"
    ),
    "alert_lock_check": _with("""
SELECT a.* FROM alerts a JOIN (SELECT src_ip, MIN(window_end) AS fired_at FROM alerts GROUP BY src_ip) k
  ON a.src_ip = k.src_ip AND a.window_end >= k.fired_at + INTERVAL '8 hours'""", _windows()),
    "alert_outbox": _fired("""
SELECT src_ip, window_end, total_bytes, message, 'alert:throttle:' || src_ip AS lock_key,
       '{"content":"🚨 **' || message || '**"}' AS payload, 'pending' AS status
FROM fired"""),
    "alert_delivery": _fired("""
SELECT src_ip, window_end, total_bytes, '{"content":"🚨 **' || message || '**"}' AS payload, TRUE AS delivered
FROM fired"""),
    "pit_features": _PIT,
    "pit_features_bucketed": _PIT,
    "pit_features_two_views": _with("""
SELECT s.*, CASE WHEN f.ts >= s.event_timestamp - INTERVAL '6 hours' THEN f.bytes_sent END AS bytes_sent,
       CAST(g.latency_ms AS INTEGER) AS latency_ms
FROM spine s ASOF LEFT JOIN traffic f ON s.src_ip = f.src_ip AND s.event_timestamp >= f.ts
     ASOF LEFT JOIN slow g ON s.src_ip = g.src_ip AND s.event_timestamp >= g.ts""",
        TRAFFIC, " slow AS (SELECT * FROM traffic WHERE latency_ms >= 30)"),
    "pit_features_silver": _PIT.replace(
        "FROM spine s", "FROM (FROM spine WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17') s"
    ),
    "materialize_views": _with("""
SELECT src_ip, l.event_timestamp, l.bytes_sent, s.ts AS slow_at, CAST(s.latency_ms AS INTEGER) AS slow_latency_ms
FROM latest l FULL JOIN (
  SELECT * FROM traffic WHERE latency_ms >= 30 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY src_ip ORDER BY ts DESC, event_id DESC) = 1) s USING (src_ip)""", TRAFFIC, LATEST),
    "materialize_latest": _LATEST,
    "online_table_upsert": _LATEST,
    "online_lookup": _lookup("TRUE"),
    "online_lookup_ttl": _lookup("l.event_timestamp >= TIMESTAMP '2024-01-20' - INTERVAL '1 day'"),
    "online_lookup_now": _lookup("l.event_timestamp >= CAST(current_timestamp AS TIMESTAMP) - INTERVAL '1 day'"),
    "late_rows_dropped": _with("""
SELECT 'hour' AS kind, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS place, COUNT(*) AS n
FROM tel WHERE NOT (ends_with(event_id, '3') AND ts < TIMESTAMP '2024-01-15') GROUP BY 2
UNION ALL SELECT 'arrival', 0, 0
UNION ALL SELECT 'arrival', 1, COUNT(*) FROM tel WHERE ends_with(event_id, '3') AND ts < TIMESTAMP '2024-01-15'"""),
    "eps": _EPS,
    "eps_stream": _EPS,
    "anomaly_labels": _with("""
SELECT event_id, latency_ms >= 2000 AS latency_spike,
       bytes_sent >= 10000000 AND dst_port = 53 AND protocol = 'UDP' AS exfiltration,
       flags LIKE '%RST%' OR status_code >= 500 AS connection_reset,
       concat_ws(',', CASE WHEN latency_spike THEN 'latency_spike' END, CASE WHEN exfiltration THEN 'exfiltration' END,
                 CASE WHEN connection_reset THEN 'connection_reset' END) AS labels
FROM tel"""),
    "anomaly_rates": _rates(),
    "anomaly_rates_stream": _rates(),
    "port_scan": _SCAN,
    "port_scan_stream": _SCAN,
}
