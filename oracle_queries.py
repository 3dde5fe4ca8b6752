"""DuckDB statements of the registered queries (the correctness oracle).

Each is written independently of the Spark code, from the definitions in
FIXTURES.md and the operator semantics, over the pre-registered views of the
given tables.  Column names equal the Spark query's.
"""

from __future__ import annotations

# Consumer groups are named <topic>_<suffix>; written out, not taken from the engine.
GROUP_SUFFIX = "_spillway"

# The topic log derived from `events` (FIXTURES.md).
LOG = """
log AS (
  SELECT event_type AS topic,
         CAST(user_id % 24 AS INTEGER) AS "partition",
         CAST(ROW_NUMBER() OVER (PARTITION BY event_type, user_id % 24 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS "key",
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE props END AS "value",
         ts AS "timestamp", event_id
  FROM events)"""

SNAP = """
snap AS (
  SELECT topic, "partition", MAX("offset") + 1 AS start_offset
  FROM log WHERE "timestamp" < TIMESTAMP '2024-01-20 00:00:00'
  GROUP BY topic, "partition")"""

STORED = f"""
stored_rows AS (
  SELECT topic || '{GROUP_SUFFIX}' AS "group", CAST(0 AS INTEGER) AS generation, topic, "partition",
         CAST(dayofmonth("timestamp") - 1 AS BIGINT) AS batch_id, MAX("offset") + 1 AS next_offset
  FROM log WHERE "timestamp" < TIMESTAMP '2024-01-20 00:00:00'
  GROUP BY topic, "partition", dayofmonth("timestamp")),
stored AS (
  SELECT "group", generation, topic, "partition", MAX(next_offset) AS next_offset
  FROM stored_rows GROUP BY "group", generation, topic, "partition")"""

PARTS = """
parts AS (
  SELECT t.topic, CAST(r.range AS INTEGER) AS "partition"
  FROM (SELECT DISTINCT topic FROM log) t CROSS JOIN range(0, 27) r),
ends AS (
  SELECT topic, "partition", MAX("offset") + 1 AS newest_offset FROM log GROUP BY topic, "partition")"""

LAG = f"""
lagrows AS (
  SELECT p.topic || '{GROUP_SUFFIX}' AS "group", p.topic, p."partition",
         CAST(COALESCE(c.next_offset, 0) AS BIGINT) AS current_offset,
         CAST(COALESCE(e.newest_offset, 0) AS BIGINT) AS newest_offset,
         CAST(COALESCE(e.newest_offset, 0) - COALESCE(c.next_offset, 0) AS BIGINT) AS lag,
         c.next_offset IS NOT NULL AS has_position
  FROM parts p
  LEFT JOIN ends e ON e.topic = p.topic AND e."partition" = p."partition"
  LEFT JOIN stored c ON c.topic = p.topic AND c."partition" = p."partition")"""

REJECT = """COALESCE(length("value") > 8, false)"""

# Each record read at its time, sent at the next 10 s flush tick unless rejected.
AUDIT = f"""
audit AS (
  SELECT topic, 'consumer' AS client_type, CAST(1 AS BIGINT) AS n,
         CAST(CASE WHEN {REJECT} THEN 1 ELSE 0 END AS BIGINT) AS rejected, "timestamp" AS "at" FROM log
  UNION ALL
  SELECT topic, 'producer' AS client_type, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS rejected,
         make_timestamp(epoch_us("timestamp") + ((-epoch_us("timestamp")) % 10000000 + 10000000) % 10000000) AS at
  FROM log WHERE NOT {REJECT})"""


def _bucket(col: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"((epoch_us({col}) - epoch_us({col}) % {us}) // 1000000)"


THROUGHPUT = f"""
tp AS (
  SELECT topic, client_type, make_timestamp(b * 1000000) AS "time", CAST(SUM(n) AS BIGINT) AS records
  FROM (SELECT *, {_bucket('"at"', 1)} AS b FROM audit) GROUP BY topic, client_type, b)"""

COPY = """
SELECT l.topic, CAST((l."offset" + l."partition") % 24 AS INTEGER) AS "partition",
       COALESCE(l."key", '') AS "key", COALESCE(l."value", '') AS "value"
FROM log l"""

POINTS = f"""
WITH {LOG}, {STORED}, {PARTS}, {LAG}, {AUDIT}, {THROUGHPUT}
SELECT 'kafka_stats' AS measurement,
       'kafka_stats,consumer_group_name=' || "group" || ',host=spillway-host,partition=' || CAST("partition" AS VARCHAR)
         || ',topic=' || topic AS series,
       'currentOffset' AS field, current_offset AS value, TIMESTAMP '2024-01-20 00:00:00' AS "time"
FROM lagrows
UNION ALL
SELECT 'kafka_stats',
       'kafka_stats,consumer_group_name=' || "group" || ',host=spillway-host,partition=' || CAST("partition" AS VARCHAR)
         || ',topic=' || topic,
       'newestOffset', newest_offset, TIMESTAMP '2024-01-20 00:00:00'
FROM lagrows
UNION ALL
SELECT 'rps_stats', 'rps_stats,clientType=' || client_type || ',host=spillway-host,topic=' || topic,
       'rps', records, "time"
FROM tp
UNION ALL
SELECT 'system_stats', 'system_stats,host=' || CAST(user_id AS VARCHAR), 'value',
       CAST(floor(max_by(value, event_id)) AS BIGINT), make_timestamp(b * 1000000)
FROM (SELECT *, {_bucket('ts', 60)} AS b FROM events)
GROUP BY user_id, b"""


def _dense(counts_sql: str, keys: list[str], seconds: int) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"g.{c} = c.{c}" for c in keys)
    return f"""
counts AS ({counts_sql}),
span AS (SELECT MIN(b) AS lo, MAX(b) AS hi FROM counts),
keyset AS (SELECT DISTINCT {k} FROM counts),
grid AS (SELECT {k}, UNNEST(generate_series(lo, hi, {seconds})) AS b FROM keyset, span),
dense AS (
  SELECT {", ".join("g." + c for c in keys)}, g.b, COALESCE(c.records, 0) AS records
  FROM grid g LEFT JOIN counts c ON {on} AND g.b = c.b)"""


TOPIC_SINK = f"""WITH {LOG},
rng AS (SELECT topic, "partition", MIN("offset") AS f, MAX("offset") + 1 AS u FROM log GROUP BY topic, "partition"),
slots AS (
  SELECT topic, "partition", f,
         COALESCE(SUM((u - f + 23) // 24) OVER (PARTITION BY topic ORDER BY "partition"
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS slot
  FROM rng)
SELECT l.topic, CAST((l."offset" + l."partition") % 24 AS INTEGER) AS "partition",
       CAST(s.slot + (l."offset" - s.f) // 24 AS BIGINT) AS "offset",
       COALESCE(l."key", '') AS "key", COALESCE(l."value", '') AS "value"
FROM log l JOIN slots s ON l.topic = s.topic AND l."partition" = s."partition\""""


ORACLE: dict[str, str] = {
    "topic_source": f"""WITH {LOG}
SELECT topic, "partition", "offset", "key", "value", "timestamp" FROM log""",

    "start_position": f"""WITH {LOG}, {SNAP}
SELECT l.topic, l."partition", l."offset", l."key", l."value"
FROM log l LEFT JOIN snap s ON l.topic = s.topic AND l."partition" = s."partition"
WHERE l."offset" >= COALESCE(s.start_offset, 0)""",

    "reset_position": f"""WITH {LOG}, {STORED},
snap2 AS (
  SELECT topic, "partition", MAX("offset") + 1 AS newest_offset
  FROM log WHERE "timestamp" < TIMESTAMP '2024-01-25 00:00:00' GROUP BY topic, "partition")
SELECT s.topic, s."partition", CAST(1 AS INTEGER) AS generation, s.newest_offset AS start_offset,
       CAST(GREATEST(s.newest_offset - COALESCE(c.next_offset, 0), 0) AS BIGINT) AS skipped
FROM snap2 s LEFT JOIN stored c ON s.topic = c.topic AND s."partition" = c."partition\"""",

    "newest_offsets": f"""WITH {LOG}, {PARTS}
SELECT p.topic, p."partition", CAST(COALESCE(e.newest_offset, 0) AS BIGINT) AS newest_offset
FROM parts p LEFT JOIN ends e ON e.topic = p.topic AND e."partition" = p."partition\"""",

    "committed_offsets": f"""WITH {LOG}, {STORED}
SELECT "group", generation, topic, "partition", next_offset FROM stored""",

    "topic_filter": f"""WITH {LOG}
SELECT topic, "partition", "offset", "key", "value" FROM log WHERE topic = 'click'""",

    "record_projection": f"""WITH {LOG}
SELECT topic, "key", "value" FROM log""",

    "null_to_empty": f"""WITH {LOG}
SELECT topic, COALESCE("key", '') AS "key", COALESCE("value", '') AS "value" FROM log""",

    "group_name": f"""WITH {LOG}
SELECT DISTINCT topic, topic || '{GROUP_SUFFIX}' AS "group" FROM log""",

    "truncate_time": f"""WITH {LOG}
SELECT topic, "partition", "offset", date_trunc('second', "timestamp") AS "time" FROM log""",

    "round_robin_partition": f"""WITH {LOG}
SELECT l.topic, l."partition" AS source_partition, l."offset",
       CAST((l."offset" + l."partition") % 24 AS INTEGER) AS "partition"
FROM log l""",

    "fan_out": f"WITH {LOG}{COPY}",

    "topic_sink": TOPIC_SINK,

    "failed_records": f"""WITH {LOG}
SELECT topic, CAST(SUM(CASE WHEN {REJECT} THEN 0 ELSE 1 END) AS BIGINT) AS sent,
       CAST(SUM(CASE WHEN {REJECT} THEN 1 ELSE 0 END) AS BIGINT) AS rejected
FROM log GROUP BY topic""",

    "commit_position": f"""WITH {LOG}, {SNAP},
after AS (
  SELECT l.topic, l."partition", MAX(l."offset") + 1 AS next_offset
  FROM log l LEFT JOIN snap s ON l.topic = s.topic AND l."partition" = s."partition"
  WHERE l."offset" >= COALESCE(s.start_offset, 0) GROUP BY l.topic, l."partition")
SELECT topic || '{GROUP_SUFFIX}' AS "group", topic, "partition", CAST(-1 AS BIGINT) AS batch_id,
       start_offset AS next_offset, CAST(0 AS INTEGER) AS generation FROM snap
UNION ALL
SELECT topic || '{GROUP_SUFFIX}', topic, "partition", CAST(0 AS BIGINT), next_offset, CAST(0 AS INTEGER) FROM after""",

    "error_budget": """
SELECT user_id, event_id, CAST(11 AS BIGINT) AS nth
FROM (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
      FROM events WHERE event_type = 'error')
WHERE rn = 11""",

    "client_budgets": """
SELECT user_id, event_id, CAST(11 AS BIGINT) AS nth
FROM (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
      FROM events WHERE event_type = 'error')
WHERE rn = 11""",

    "drain_stop": f"""WITH {LOG}
SELECT topic, COUNT(*) AS consumed, COUNT(*) AS produced, CAST(0 AS BIGINT) AS waiting, false AS running FROM log GROUP BY topic""",

    "read_limit": f"""WITH {LOG}
SELECT topic, COUNT(*) AS records, COUNT(DISTINCT "partition") AS partitions FROM log GROUP BY topic, dayofyear("timestamp") // 5""",

    "flush_policy": f"""WITH {LOG}
SELECT topic, COUNT(*) AS records, true AS one_batch_an_interval FROM log GROUP BY topic""",

    "flush_interval": f"""WITH {LOG}
SELECT topic, COUNT(*) AS records, COUNT(DISTINCT dayofyear("timestamp") // 5) AS batches, true AS one_batch_an_interval
FROM log GROUP BY topic""",

    "flush_groups": f"""WITH {LOG},
placed AS (
  SELECT topic, "partition", "offset", epoch_us("timestamp") // 86400000000 * 86400 AS "interval",
         ROW_NUMBER() OVER (PARTITION BY topic, epoch_us("timestamp") // 86400000000 ORDER BY "partition", "offset") - 1 AS place
  FROM log)
SELECT topic, CAST("interval" AS BIGINT) AS "interval", CAST(place // 20 AS BIGINT) AS flush_group, COUNT(*) AS records,
       ARG_MIN("partition", place) AS first_partition, ARG_MIN("offset", place) AS first_offset
FROM placed GROUP BY topic, "interval", place // 20""",

    "record_limit": f"""WITH {LOG},
lim AS (SELECT COUNT(*) // 12 + 1 AS n FROM log),
total AS (SELECT topic, COUNT(*) AS records FROM log GROUP BY topic)
SELECT topic, CAST(b AS BIGINT) AS batch_id, CAST(LEAST(n, records - b * n) AS BIGINT) AS records
FROM total, lim, LATERAL (SELECT UNNEST(generate_series(0, (records - 1) // n)) AS b)""",

    "drain_signal": f"""WITH {LOG},
lim AS (SELECT COUNT(*) // 12 + 1 AS n FROM log)
SELECT topic, false AS failed, CAST(LEAST(ANY_VALUE(n), COUNT(*)) AS BIGINT) AS read, CAST(LEAST(ANY_VALUE(n), COUNT(*)) AS BIGINT) AS committed,
       true AS sent_is_committed, false AS running, COUNT(*) AS at_last
FROM log, lim GROUP BY topic
UNION ALL
SELECT topic, true, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false, false, CAST(SUM(CASE WHEN {REJECT} THEN 0 ELSE 1 END) AS BIGINT)
FROM log GROUP BY topic""",

    "monitor_lag": f"""WITH {LOG}
SELECT topic, "partition", CAST(COUNT(*) FILTER (WHERE "timestamp" < TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) AS current_offset,
       COUNT(*) AS newest_offset
FROM log GROUP BY topic, "partition\"""",

    "fold_chain": f"""WITH {LOG}
SELECT topic, COALESCE("key", '') AS "key", COALESCE("value", '') AS "value" FROM log""",

    "delivery_options": f"""WITH {LOG}
SELECT topic, 'gz' AS codec, COUNT(*) AS records FROM log GROUP BY topic""",

    "copy_replay": TOPIC_SINK,

    "retry_records": f"""WITH {LOG},
fate AS (
  SELECT topic, CASE WHEN {REJECT} THEN second("timestamp") % 5 ELSE 0 END AS failures FROM log),
totals AS (
  SELECT topic, CAST(SUM(CASE WHEN failures < 3 THEN 1 ELSE 0 END) AS BIGINT) AS sent,
         CAST(SUM(CASE WHEN failures < 3 THEN 0 ELSE 1 END) AS BIGINT) AS rejected FROM fate GROUP BY topic)
SELECT f.topic, CAST(LEAST(failures + 1, 3) AS INTEGER) AS attempts, failures >= 3 AS dead, COUNT(*) AS records,
       ANY_VALUE(sent) AS sent, ANY_VALUE(sent) AS sent_offsets, ANY_VALUE(sent) AS produced, ANY_VALUE(rejected) AS rejected
FROM fate f JOIN totals t ON f.topic = t.topic GROUP BY f.topic, LEAST(failures + 1, 3), failures >= 3""",

    "copy_lag": f"""WITH {LOG}, {SNAP}
SELECT topic || '{GROUP_SUFFIX}' AS "group", l.topic, l."partition", COALESCE(ANY_VALUE(s.start_offset), 0) AS current_offset,
       COUNT(*) AS newest_offset, COUNT(*) - COALESCE(ANY_VALUE(s.start_offset), 0) AS lag, ANY_VALUE(s.start_offset) IS NOT NULL AS has_position
FROM log l LEFT JOIN snap s USING (topic, "partition") GROUP BY l.topic, l."partition\"""",

    "copy_points": f"""WITH {LOG}, c(client) AS (VALUES ('consumer'), ('producer'))
SELECT 'rps_stats,clientType=' || client || ',host=spillway-host,topic=' || topic AS series, COUNT(*) AS records,
       true AS no_duplicate, true AS no_gap
FROM log, c GROUP BY topic, client""",

    "copy_audit": f"""WITH {LOG}
SELECT topic || '{GROUP_SUFFIX}' AS "group", 'consumer' AS client_type, COUNT(*) AS n,
       CAST(SUM(CASE WHEN {REJECT} THEN 1 ELSE 0 END) AS BIGINT) AS rejected
FROM log GROUP BY topic
UNION ALL
SELECT topic || '{GROUP_SUFFIX}', 'producer', CAST(SUM(CASE WHEN {REJECT} THEN 0 ELSE 1 END) AS BIGINT),
       CAST(0 AS BIGINT)
FROM log GROUP BY topic""",

    "copy_commits": f"""WITH {LOG}
SELECT topic || '{GROUP_SUFFIX}' AS "group", topic, "partition", MAX("offset") + 1 AS next_offset
FROM log GROUP BY topic, "partition\"""",

    "throughput": f"""WITH {LOG}, {AUDIT}, {THROUGHPUT}
SELECT topic, client_type, "time", records FROM tp""",

    "dense_throughput": f"""WITH {LOG}, {AUDIT}, {_dense(
        f"SELECT topic, client_type, {_bucket('"at"', 1)} AS b, SUM(n) AS records FROM audit GROUP BY ALL",
        ["topic", "client_type"], 1)}
SELECT topic, client_type, make_timestamp((b - b % 60) * 1000000) AS "start",
       string_agg(CAST(CAST(records AS BIGINT) AS VARCHAR), ',' ORDER BY b) AS records
FROM dense GROUP BY topic, client_type, b - b % 60""",

    "stream_throughput": f"""WITH {LOG}, {AUDIT},
counts AS (SELECT topic, client_type, {_bucket('"at"', 1)} AS b, SUM(n) AS records FROM audit GROUP BY ALL),
span AS (SELECT MIN(b) // 60 * 60 AS lo, MAX(b) // 60 * 60 + 59 AS hi FROM counts),
grid AS (SELECT topic, client_type, UNNEST(generate_series(lo, hi)) AS b FROM (SELECT DISTINCT topic, client_type FROM counts), span)
SELECT topic, client_type, make_timestamp((b - b % 60) * 1000000) AS "start",
       string_agg(CAST(CAST(COALESCE(records, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY b) AS records
FROM grid LEFT JOIN counts USING (topic, client_type, b) GROUP BY topic, client_type, b - b % 60""",

    "partition_lag": f"""WITH {LOG}, {STORED}, {PARTS}, {LAG}
SELECT * FROM lagrows""",

    "total_lag": f"""WITH {LOG}, {STORED}, {PARTS}, {LAG}
SELECT "group", topic, CAST(SUM(lag) AS BIGINT) AS total_lag, COUNT(*) AS partitions
FROM lagrows GROUP BY "group", topic""",

    "in_flight": f"""WITH {LOG}, {AUDIT}, {_dense(
        f"SELECT topic, {_bucket('"at"', 30)} AS b, "
        "SUM(CASE WHEN client_type = 'consumer' THEN n - rejected ELSE -n END) AS records FROM audit GROUP BY ALL",
        ["topic"], 30)}
SELECT topic, make_timestamp(b * 1000000) AS "time",
       CAST(SUM(records) OVER (PARTITION BY topic ORDER BY b
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS in_flight
FROM dense""",

    "gauge_sample": f"""
SELECT CAST(user_id AS VARCHAR) AS host, make_timestamp(b * 1000000) AS "time", max_by(value, event_id) AS value
FROM (SELECT *, {_bucket('ts', 60)} AS b FROM events)
GROUP BY user_id, b""",

    "to_points": POINTS,

    "metric_sink": POINTS,
}
