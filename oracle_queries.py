"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain SQL over the pre-registered driver views; every query re-derives its
inputs from ``events`` exactly as the Spark side does. Doubles from sums and
averages are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from tsquality.plans import catalog as C
from tsquality.sources.events import READINGS_SQL
from tsquality.sources.messages import PARSE_ERROR
from tsquality.sources.synth import faulty_messages_sql, inject_faults_sql

I = C.CFG.interval_us
G = C.CFG.grace_us
TTL = C.CFG.ttl_us
LATE = C.CFG.lateness_us
BOUND = C.CFG.bound_us
THRESH = C.CFG.gap_tolerance * I
BUCKET_US = C.BUCKET_SECONDS * 1_000_000
MAXKWH = C.CFG.max_kwh
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
T_FROM = "TIMESTAMP '2024-01-01 00:00:00'"
T_TO = NOW

VALIDATION = f"""CASE WHEN meter_id IS NULL THEN 'Missing required field: meter_id'
  WHEN timestamp IS NULL THEN 'Missing required field: timestamp'
  WHEN consumption_kwh IS NULL THEN 'Missing required field: consumption_kwh'
  WHEN meter_id = '' THEN 'Invalid meter_id'
  WHEN isnan(consumption_kwh) THEN 'Invalid consumption_kwh value'
  WHEN consumption_kwh < 0 THEN 'Consumption cannot be negative'
  WHEN consumption_kwh > {MAXKWH} THEN 'Consumption value too large'
  ELSE 'OK' END"""

# Of parsed payloads: a field that is there but cannot be read is not a missing one.
VALIDATION_PARSED = VALIDATION.replace("WHEN timestamp IS NULL", "WHEN timestamp IS NULL AND kind <> 'bad_time'") \
    .replace("WHEN consumption_kwh IS NULL", "WHEN consumption_kwh IS NULL AND kind <> 'bad_kwh'") \
    .replace("WHEN isnan(consumption_kwh) THEN 'Invalid consumption_kwh value'",
             "WHEN timestamp IS NULL THEN 'Invalid timestamp type' "
             "WHEN consumption_kwh IS NULL OR isnan(consumption_kwh) THEN 'Invalid consumption_kwh value'")

PARSED = f"""({faulty_messages_sql(inject_faults_sql(READINGS_SQL, **C.FAULTS), **C.PAYLOAD_FAULTS)})"""

CLEAN = f"""clean AS (SELECT * FROM ({READINGS_SQL}) r WHERE ({VALIDATION.replace(chr(10), ' ')}) = 'OK')"""

ROUTED = f"""
raw AS {PARSED},
v AS (SELECT *, {VALIDATION_PARSED} AS validation,
        epoch_us(arrival_ts) // {BUCKET_US} AS _bucket, epoch_us(timestamp) AS _us FROM raw),
per AS (SELECT _bucket, max(CASE WHEN validation = 'OK' THEN _us // 1000 END) AS _max_ms FROM v GROUP BY _bucket),
bt AS (SELECT _bucket, _max_ms,
        max(_max_ms) OVER (ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) * 1000 - {BOUND} AS wm_us
       FROM per),
batches AS (SELECT *, lag(wm_us) OVER (ORDER BY _bucket) AS pred_wm_us FROM bt),
fin AS (SELECT max(_max_ms) * 1000 - {BOUND} AS final_wm FROM per),
c AS (SELECT v.*, b.wm_us, b.pred_wm_us,
        CASE WHEN b.wm_us IS NULL OR b.wm_us - v._us <= 0 THEN 'ON_TIME'
             WHEN b.wm_us - v._us <= {LATE} THEN 'LATE' ELSE 'TOO_LATE' END AS timing,
        CASE WHEN b.wm_us - v._us > 0 THEN CAST((b.wm_us - v._us) // 1000000 AS INTEGER) END AS delay_seconds
      FROM v JOIN batches b USING (_bucket) WHERE v.validation = 'OK'),
too_late AS (SELECT * FROM c WHERE timing = 'TOO_LATE'),
acc0 AS (SELECT *, max(_us) OVER (PARTITION BY meter_id ORDER BY _bucket, _us, seq
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _prev_max
         FROM c WHERE timing <> 'TOO_LATE'),
acc AS (SELECT *, COALESCE(_prev_max IS NOT NULL AND _prev_max + {TTL} <= pred_wm_us, false) AS _expired,
          CASE WHEN timing = 'LATE' THEN 'LATE' ELSE 'OK' END AS status FROM acc0),
resume AS (SELECT meter_id, _bucket, _us, seq, arrival_ts,
             make_timestamp(_prev_max + {I}) AS missing_from, timestamp AS missing_to,
             CAST((_us - _prev_max - {I}) // 60000000 AS INTEGER) AS gap_minutes
           FROM acc WHERE NOT _expired AND _prev_max IS NOT NULL
             AND CAST(_us - _prev_max AS DOUBLE) > {THRESH} AND (_us - _prev_max - {I}) // 60000000 > 0),
arm AS (SELECT meter_id, _bucket, _us, seq,
          lead(_bucket) OVER (PARTITION BY meter_id ORDER BY _bucket, _us, seq) AS _next_bucket
        FROM acc WHERE _prev_max IS NULL OR _us > _prev_max),
arm2 AS (SELECT arm.*, CASE WHEN arm._next_bucket IS NULL THEN (SELECT final_wm FROM fin)
                            WHEN arm._next_bucket = arm._bucket THEN NULL
                            ELSE b.pred_wm_us END AS _limit
         FROM arm LEFT JOIN batches b ON b._bucket = arm._next_bucket),
arm3 AS (SELECT *, CASE WHEN _limit IS NOT NULL
                        THEN (least(_limit, _us + {TTL}) - _us - {G}) // {I} END AS _kmax FROM arm2),
steps AS (SELECT meter_id, _bucket, _us, seq, unnest(generate_series(1, _kmax)) AS _k FROM arm3 WHERE _kmax >= 1),
timers AS (SELECT meter_id, _bucket, _us, seq, _k, make_timestamp(_us + _k * {I}) AS missing_from,
             make_timestamp(_us + _k * {I} + {G}) AS missing_to, CAST({C.CFG.grace_seconds // 60} AS INTEGER) AS gap_minutes
           FROM steps),
alerts AS (SELECT missing_from AS time, meter_id, missing_from, missing_to, gap_minutes, 'timer' AS detected_by,
             missing_to AS arrival_ts, _bucket, 0 AS _kind, seq FROM timers
           UNION ALL
           SELECT missing_from AS time, meter_id, missing_from, missing_to, gap_minutes, 'event' AS detected_by,
             arrival_ts, _bucket, 1 AS _kind, seq FROM resume),
validated AS (SELECT timestamp AS time, meter_id, consumption_kwh, status, arrival_ts, _bucket, seq FROM acc),
late_events AS (SELECT timestamp AS time, meter_id, timestamp AS event_timestamp, consumption_kwh,
                  COALESCE(delay_seconds, 0) AS delay_seconds, arrival_ts, _bucket, seq FROM too_late),
metrics AS (
  SELECT arrival_ts AS time, 'invalid_event' AS metric_type, meter_id, 1.0::DOUBLE AS value,
         '{{"error":"' || validation || '"}}' AS tags, _bucket, seq FROM v WHERE validation <> 'OK' AND kind <> 'malformed'
  UNION ALL SELECT arrival_ts, 'processing_error', 'unknown', 1.0, '{{"error":"{PARSE_ERROR}"}}', _bucket, seq
            FROM v WHERE kind = 'malformed'
  UNION ALL SELECT arrival_ts, 'too_late_event', meter_id, 1.0, '{{}}', _bucket, seq FROM too_late
  UNION ALL SELECT arrival_ts, 'gap_detected', meter_id, gap_minutes::DOUBLE, '{{}}', _bucket, seq FROM resume
  UNION ALL SELECT arrival_ts, 'event_processed', meter_id, 1.0, '{{"status":"' || status || '"}}', _bucket, seq FROM acc
  UNION ALL SELECT missing_to, 'gap_detected_timer', meter_id, gap_minutes::DOUBLE, '{{}}', _bucket, seq FROM timers),
t_validated AS (SELECT time, meter_id, arg_max(consumption_kwh, [_bucket, seq]) AS consumption_kwh,
                  arg_max(status, [_bucket, seq]) AS status, arg_max(arrival_ts, [_bucket, seq]) AS arrival_ts
                FROM validated GROUP BY time, meter_id),
t_gap_alerts AS (SELECT time, meter_id, missing_from,
                   arg_min(missing_to, [_bucket, _kind, seq]) AS missing_to,
                   arg_min(gap_minutes, [_bucket, _kind, seq]) AS gap_minutes,
                   arg_min(detected_by, [_bucket, _kind, seq]) AS detected_by,
                   arg_min(arrival_ts, [_bucket, _kind, seq]) AS arrival_ts
                 FROM alerts GROUP BY time, meter_id, missing_from),
t_late_events AS (SELECT time, meter_id, event_timestamp,
                    arg_min(consumption_kwh, [_bucket, seq]) AS consumption_kwh,
                    arg_min(delay_seconds, [_bucket, seq]) AS delay_seconds,
                    arg_min(arrival_ts, [_bucket, seq]) AS arrival_ts
                  FROM late_events GROUP BY time, meter_id, event_timestamp)
"""


def _routed(select: str) -> str:
    return f"WITH {ROUTED.strip()}\n{select}"


def _iso(sql: str) -> str:
    """ISO_OF(column) written out: as Python prints a UTC time."""
    import re
    return re.sub(r"ISO_OF\((\w+)\)", r"(strftime(\1, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(\1) % 1000000 <> 0 "
                  r"THEN strftime(\1, '.%f') ELSE '' END || '+00:00')", sql)


def _clean(select: str) -> str:
    return f"WITH {CLEAN}\n{select}"


GAPS_CLEAN = f"""
g0 AS (SELECT meter_id, timestamp, epoch_us(timestamp) AS _us,
         lag(epoch_us(timestamp)) OVER (PARTITION BY meter_id ORDER BY epoch_us(timestamp), seq) AS _prev
       FROM clean),
gaps AS (SELECT make_timestamp(_prev + {I}) AS time, meter_id, make_timestamp(_prev + {I}) AS missing_from,
           timestamp AS missing_to, CAST((_us - _prev - {I}) // 60000000 AS INTEGER) AS gap_minutes
         FROM g0 WHERE _prev IS NOT NULL AND CAST(_us - _prev AS DOUBLE) > {THRESH}
           AND (_us - _prev - {I}) // 60000000 > 0)"""

METER_STATE = f"""
SELECT p.meter_id, make_timestamp(p._last) AS last_seen, make_timestamp(p._last + {I}) AS expected_next,
  {C.CFG.interval_minutes} AS interval_minutes,
  CAST((SELECT count(*) FROM (SELECT meter_id, _bucket, _us, seq FROM resume UNION ALL
                              SELECT meter_id, _bucket, _us, seq FROM timers) x
        WHERE x.meter_id = p.meter_id AND [x._bucket, x._us, x.seq] >= p._r0) AS BIGINT) AS gap_count,
  CAST((SELECT count(*) FROM too_late t WHERE t.meter_id = p.meter_id AND [t._bucket, t._us, t.seq] > p._r0)
       AS BIGINT) AS late_count
FROM (SELECT meter_id, max(_us) AS _last,
        max(CASE WHEN _prev_max IS NULL OR _expired THEN [_bucket, _us, seq] END) AS _r0
      FROM acc GROUP BY meter_id) p
WHERE p._last + {TTL} > (SELECT final_wm FROM fin)"""

RANGE = f"time BETWEEN {T_FROM} AND {T_TO}"

def _u(salt: str, key: str) -> str:
    from tsquality.functions.hashing import uniform01_sql
    return uniform01_sql(42, salt, key)


SQL = {
    "csv_alias_parse": f"""SELECT seq, meter_id,
        CASE WHEN {_u('ts_format', 'seq')} < 1/3 THEN date_trunc('second', timestamp) ELSE timestamp END AS timestamp,
        consumption_kwh FROM ({READINGS_SQL}) r
        WHERE {_u('csv_bad', 'seq')} >= 0.01 AND {_u('csv_bad', 'seq')} < 0.99""",
    "stream_batch_counts": f"""WITH c AS (SELECT {_u('csv_bad', 'seq')} AS u FROM ({READINGS_SQL}) r),
          m AS (SELECT seq % {C.COUNTED_BATCHES} AS batch, kind = 'malformed' AS unparsed, kind = 'malformed' OR validation <> 'OK' AS invalid
                FROM (SELECT *, {VALIDATION_PARSED} AS validation FROM {PARSED} p) v)
        SELECT 'csv_rows' AS metric_type, -1 AS batch, count(*)::DOUBLE AS value FROM c
        UNION ALL SELECT 'csv_dropped', -1, count(*) FILTER (u < 0.01 OR u >= 0.99) FROM c
        UNION ALL SELECT 'validation_rows', batch, count(*) FROM m GROUP BY batch
        UNION ALL SELECT 'validation_invalid', batch, count(*) FILTER (invalid) FROM m GROUP BY batch
        UNION ALL SELECT 'validation_unparsed', batch, count(*) FILTER (unparsed) FROM m GROUP BY batch""",
    "format_convert": f"""SELECT seq, CASE WHEN {_u('no_id', 'seq')} < 0.1 THEN 'UNKNOWN' ELSE meter_id END AS meter_id,
        strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, consumption_kwh FROM ({READINGS_SQL}) r""",
    "json_parse": f"""SELECT seq, meter_id, timestamp, consumption_kwh, validation,
          CASE WHEN kind = 'malformed' THEN 'processing_error' WHEN validation <> 'OK' THEN validation END AS error,
          CASE WHEN kind = 'malformed' THEN '{PARSE_ERROR}' END AS parse_error
        FROM (SELECT *, {VALIDATION_PARSED} AS validation FROM {PARSED} p) v""",
    "synth_readings": f"""WITH per AS (SELECT user_id AS m, date_trunc('day', min(ts)) AS d0, date_trunc('day', max(ts)) AS d1
                          FROM events GROUP BY user_id),
        g AS (SELECT m, d0, unnest(generate_series(0, ((epoch_us(d1) - epoch_us(d0)) // 60000000 + 1440) // 30 - 1)) AS k
              FROM per)
        SELECT printf('METER_%04d', m) AS meter_id, make_timestamp(epoch_us(d0) + k * 1800000000) AS timestamp,
          round(greatest(0.0, (0.5 + {_u('base', 'm')} * 4.5) + (-0.3 + {_u('noise', "m * 4294967296 + k")} * 0.6)), 3)
            AS consumption_kwh,
          m * 4294967296 + k AS seq FROM g""",
    "validate": f"""SELECT seq, meter_id, timestamp, consumption_kwh, {VALIDATION} AS validation FROM {PARSED} p""",
    "quarantine_metrics": f"""SELECT seq, 'invalid_event' AS metric_type, meter_id, 1.0::DOUBLE AS value,
          '{{"error":"' || validation || '"}}' AS tags
        FROM (SELECT *, {VALIDATION_PARSED} AS validation FROM {PARSED} p) v
        WHERE validation <> 'OK' AND kind <> 'malformed'""",
    "inject_faults": f"""SELECT seq, meter_id, timestamp, consumption_kwh, arrival_ts
        FROM ({inject_faults_sql(READINGS_SQL, **C.FAULTS)}) f""",
    "batch_watermark": _routed(f"""SELECT make_timestamp(_bucket * {BUCKET_US}) AS arrival_bucket,
        make_timestamp(wm_us) AS watermark FROM batches"""),
    "classify_lateness": _routed("""SELECT seq, meter_id, timestamp, arrival_ts, make_timestamp(wm_us) AS watermark,
        timing, delay_seconds FROM c"""),
    "late_events": _routed("SELECT time, meter_id, event_timestamp, consumption_kwh, delay_seconds FROM late_events"),
    "validated_readings": _routed("SELECT time, meter_id, consumption_kwh, status FROM validated"),
    "gap_events": f"WITH {CLEAN}, {GAPS_CLEAN.strip()}\nSELECT * FROM gaps",
    "expected_next": _clean(f"SELECT seq, meter_id, timestamp, make_timestamp(epoch_us(timestamp) + {I}) AS expected_next FROM clean"),
    "missing_intervals": f"""WITH {CLEAN}, {GAPS_CLEAN.strip()},
        s AS (SELECT meter_id, missing_from AS gap_from, missing_to,
                unnest(generate_series(epoch_us(missing_from), epoch_us(missing_to) - 1, {I})) AS _s
              FROM gaps WHERE missing_from < missing_to)
        SELECT meter_id, gap_from, make_timestamp(_s) AS slot_from,
          make_timestamp(least(_s + {I}, epoch_us(missing_to))) AS slot_to,
          CAST((least(_s + {I}, epoch_us(missing_to)) - _s) // 60000000 AS INTEGER) AS slot_minutes
        FROM s WHERE (least(_s + {I}, epoch_us(missing_to)) - _s) // 60000000 > 0""",
    "missing_intervals_as_written": f"""WITH {CLEAN}, {GAPS_CLEAN.strip()},
        s AS (SELECT meter_id, missing_from AS gap_from, missing_to,
                unnest(generate_series(epoch_us(missing_from), epoch_us(missing_to) - 1, {2 * I})) AS _s
              FROM gaps WHERE missing_from < missing_to)
        SELECT meter_id, gap_from, make_timestamp(_s) AS slot_from,
          make_timestamp(least(_s + {I}, epoch_us(missing_to))) AS slot_to,
          CAST((least(_s + {I}, epoch_us(missing_to)) - _s) // 60000000 AS INTEGER) AS slot_minutes
        FROM s WHERE (least(_s + {I}, epoch_us(missing_to)) - _s) // 60000000 > 0""",
    "silence_alerts": _clean(f""", fw AS (SELECT max(epoch_us(timestamp)) - {BOUND} AS w FROM clean),
        n AS (SELECT meter_id, epoch_us(timestamp) AS _us,
                lead(epoch_us(timestamp)) OVER (PARTITION BY meter_id ORDER BY epoch_us(timestamp), seq) AS _next
              FROM clean),
        k AS (SELECT meter_id, _us, (least(least(COALESCE(_next - 1, (SELECT w FROM fw)), (SELECT w FROM fw)),
                                        _us + {TTL}) - _us - {G}) // {I} AS _kmax FROM n),
        s AS (SELECT meter_id, _us, unnest(generate_series(1, _kmax)) AS _k FROM k WHERE _kmax >= 1)
        SELECT make_timestamp(_us + _k * {I}) AS time, meter_id, make_timestamp(_us + _k * {I}) AS missing_from,
          make_timestamp(_us + _k * {I} + {G}) AS missing_to, CAST({C.CFG.grace_seconds // 60} AS INTEGER) AS gap_minutes
        FROM s""".replace("WITH clean AS", "WITH clean AS", 1)),
    "resume_alerts": _routed("SELECT missing_from AS time, meter_id, missing_from, missing_to, gap_minutes FROM resume"),
    "timer_alerts": _routed("SELECT missing_from AS time, meter_id, missing_from, missing_to, gap_minutes FROM timers"),
    "meter_state": _routed(METER_STATE),
    "metrics_stream": _routed("SELECT metric_type, meter_id, value, tags, seq FROM metrics"),
    "validated_table": _routed("SELECT time, meter_id, consumption_kwh, status, arrival_ts FROM t_validated"),
    "gap_alerts_table": _routed("SELECT time, meter_id, missing_from, missing_to, gap_minutes, detected_by FROM t_gap_alerts"),
    "late_events_table": _routed("""SELECT time, meter_id, event_timestamp, consumption_kwh, delay_seconds, arrival_ts
        FROM t_late_events"""),
    "gap_summary_hourly": _routed("""SELECT date_trunc('hour', time) AS hour, meter_id, count(*) AS gap_count,
        CAST(sum(gap_minutes) AS BIGINT) AS total_gap_minutes, round(avg(gap_minutes), 6) AS avg_gap_minutes
        FROM t_gap_alerts GROUP BY 1, 2"""),
    "late_summary_hourly": _routed("""SELECT date_trunc('hour', time) AS hour, meter_id, count(*) AS late_count,
        round(avg(delay_seconds), 6) AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds
        FROM t_late_events GROUP BY 1, 2"""),
    "metrics_summary_hourly": _routed("""SELECT date_trunc('hour', time) AS hour, metric_type, count(*) AS event_count,
        round(sum(value), 6) AS total_value, round(avg(value), 6) AS avg_value FROM metrics GROUP BY 1, 2"""),
    "rollup_refreshed": _routed("""SELECT date_trunc('hour', time) AS hour, meter_id, count(*) AS late_count,
        round(avg(delay_seconds), 6) AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds
        FROM t_late_events WHERE arrival_ts < date_trunc('hour', time) + INTERVAL 3 HOUR GROUP BY 1, 2"""),
    "rollup_streamed": _routed("""SELECT date_trunc('hour', time) AS hour, meter_id, count(*) AS late_count,
        round(avg(delay_seconds), 6) AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds
        FROM t_late_events WHERE arrival_ts < date_trunc('hour', time) + INTERVAL 3 HOUR GROUP BY 1, 2"""),
    "rollup_refresh": _routed(f"""SELECT date_trunc('hour', time) AS hour, meter_id, count(*) AS late_count,
          round(avg(delay_seconds), 6) AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds
        FROM t_late_events, (SELECT unnest([{', '.join(f"TIMESTAMP '{t}'" for t in C.REFRESH_AT)}]) AS now) n
        WHERE arrival_ts < now AND time >= date_trunc('hour', now - INTERVAL 3 HOUR)
          AND time < date_trunc('hour', now - INTERVAL 1 HOUR)
          AND now = (SELECT max(m) FROM (SELECT unnest([{', '.join(f"TIMESTAMP '{t}'" for t in C.REFRESH_AT)}]) AS m) x
                     WHERE time >= date_trunc('hour', m - INTERVAL 3 HOUR) AND time < date_trunc('hour', m - INTERVAL 1 HOUR))
        GROUP BY 1, 2"""),
    "tables_incremental": _routed("SELECT time, meter_id, consumption_kwh, status, arrival_ts FROM t_validated"),
    "stream_pipeline": _routed("""
        SELECT 'validated_readings' AS route, time, meter_id, status AS detail, CAST(NULL AS BIGINT) AS number,
          consumption_kwh AS value FROM t_validated
        UNION ALL SELECT 'late_events', time, meter_id, NULL, CAST(delay_seconds AS BIGINT), consumption_kwh FROM t_late_events
        UNION ALL SELECT 'gap_alerts', time, meter_id, detected_by, CAST(gap_minutes AS BIGINT),
          CAST(epoch_us(missing_to) AS DOUBLE) FROM t_gap_alerts
        UNION ALL SELECT 'metrics', NULL, meter_id,
          concat_ws(':', metric_type, COALESCE(json_extract_string(tags, '$.error'), json_extract_string(tags, '$.status'))),
          NULL, value FROM metrics"""),
    "stream_handover": _routed("""
        SELECT 'validated_readings' AS route, time, meter_id, status AS detail, CAST(NULL AS BIGINT) AS number,
          consumption_kwh AS value FROM t_validated
        UNION ALL SELECT 'late_events', time, meter_id, NULL, CAST(delay_seconds AS BIGINT), consumption_kwh FROM t_late_events
        UNION ALL SELECT 'gap_alerts', time, meter_id, detected_by, CAST(gap_minutes AS BIGINT),
          CAST(epoch_us(missing_to) AS DOUBLE) FROM t_gap_alerts
        UNION ALL SELECT 'metrics', NULL, meter_id,
          concat_ws(':', metric_type, COALESCE(json_extract_string(tags, '$.error'), json_extract_string(tags, '$.status'))),
          NULL, value FROM metrics"""),
    "consume_results": _routed("""
        SELECT 'validated_readings' AS route, time, meter_id, status AS detail, CAST(NULL AS BIGINT) AS number,
          consumption_kwh AS value FROM t_validated
        UNION ALL SELECT 'late_events', time, meter_id, NULL, CAST(delay_seconds AS BIGINT), consumption_kwh FROM t_late_events
        UNION ALL SELECT 'gap_alerts', time, meter_id, NULL, CAST(gap_minutes AS BIGINT),
          CAST(epoch_us(missing_to) AS DOUBLE) FROM t_gap_alerts
        UNION ALL SELECT 'metrics', NULL, meter_id,
          concat_ws(':', metric_type, COALESCE(json_extract_string(tags, '$.error'), json_extract_string(tags, '$.status'))),
          NULL, value FROM metrics"""),
    "stream_state": _routed(f"SELECT meter_id, last_seen, gap_count, late_count FROM ({METER_STATE}) s"),
    "result_payloads": _routed(_iso("""
        SELECT 'smartmeter_validated' AS topic, meter_id AS key, '{"meter_id":"' || meter_id || '","timestamp":"' ||
          ISO_OF(time) || '","consumption_kwh":' || CAST(consumption_kwh AS VARCHAR) || ',"status":"' || status || '"}' AS value
          FROM validated
        UNION ALL SELECT 'smartmeter_gap_alerts', meter_id, '{"meter_id":"' || meter_id || '","missing_from":"' ||
          ISO_OF(missing_from) || '","missing_to":"' || ISO_OF(missing_to) || '","gap_minutes":' || gap_minutes || '}' FROM alerts
        UNION ALL SELECT 'smartmeter_late_events', meter_id, '{"meter_id":"' || meter_id || '","timestamp":"' || ISO_OF(time) ||
          '","consumption_kwh":' || CAST(consumption_kwh AS VARCHAR) || ',"delay_seconds":' || delay_seconds || '}' FROM late_events
        UNION ALL SELECT 'smartmeter_metrics', meter_id, '{"metric_type":"' || metric_type || '",' ||
          CASE WHEN meter_id IS NULL THEN '' ELSE '"meter_id":"' || meter_id || '",' END || '"timestamp":"' || ISO_OF(time) ||
          '","value":' || CAST(value AS VARCHAR) || ',"tags":' || tags || '}' FROM metrics""")),
    "active_meter_count": _routed(f"""SELECT value, CASE WHEN value >= 50 THEN 'green' WHEN value >= 10 THEN 'yellow'
        ELSE 'red' END AS status FROM (SELECT count(DISTINCT meter_id) AS value FROM t_validated
        WHERE time >= {NOW} - INTERVAL 24 HOUR) x"""),
    "events_per_minute": _routed(f"""SELECT date_trunc('minute', time) AS minute, count(*) AS events
        FROM t_validated WHERE {RANGE} GROUP BY 1"""),
    "gaps_per_hour": _routed(f"""SELECT date_trunc('hour', time) AS hour, count(*) AS gaps
        FROM t_gap_alerts WHERE {RANGE} GROUP BY 1"""),
    "late_pct_hourly": _routed(f"""SELECT l.hour, round(CAST(l.n AS DOUBLE) / NULLIF(v.d, 0) * 100, 6) AS late_pct
        FROM (SELECT date_trunc('hour', time) AS hour, count(*) AS n FROM t_late_events WHERE {RANGE} GROUP BY 1) l
        LEFT JOIN (SELECT date_trunc('hour', time) AS hour, count(*) AS d FROM t_validated GROUP BY 1) v
        ON l.hour = v.hour"""),
    "top_gap_meters": _routed(f"""SELECT meter_id, count(*) AS gap_count, CAST(sum(gap_minutes) AS BIGINT) AS total_gap_minutes
        FROM t_gap_alerts WHERE {RANGE} GROUP BY meter_id ORDER BY gap_count DESC, meter_id LIMIT 10"""),
    "status_counts": _routed(f"""SELECT count(*) FILTER (WHERE status = 'OK') AS ok_count,
        count(*) FILTER (WHERE status = 'LATE') AS late_count FROM t_validated WHERE time >= {NOW} - INTERVAL 1 HOUR"""),
    "meter_list": _routed("SELECT DISTINCT meter_id FROM t_validated"),
    "consumption_series": _routed(f"SELECT time, consumption_kwh FROM t_validated WHERE {RANGE}"),
    "gap_series": _routed(f"SELECT missing_from AS gap_start, gap_minutes AS value FROM t_gap_alerts WHERE {RANGE}"),
    "late_series": _routed(f"SELECT event_timestamp AS event_time, delay_seconds AS value FROM t_late_events WHERE {RANGE}"),
    "meter_drill_down": _routed(f"SELECT time, consumption_kwh FROM t_validated WHERE {RANGE} AND meter_id = 'METER_0007'"),
    "meter_stats": _routed(f"""SELECT meter_id, count(*) AS total_readings, count(*) FILTER (WHERE status = 'LATE') AS late_readings,
        max(time) AS last_reading FROM t_validated WHERE {RANGE} GROUP BY meter_id"""),
    "processing_series": _routed(f"""SELECT DISTINCT time, value FROM metrics
        WHERE metric_type = 'event_processed' AND {RANGE}"""),
    "error_rate": _routed(f"""SELECT date_trunc('minute', time) AS minute, count(*) AS errors FROM metrics
        WHERE metric_type IN ('processing_error', 'invalid_event') AND {RANGE} GROUP BY 1"""),
    "gap_rate": _routed(f"""SELECT date_trunc('minute', time) AS minute, count(*) AS gaps FROM metrics
        WHERE metric_type LIKE 'gap_%' AND {RANGE} GROUP BY 1"""),
    "late_rate": _routed(f"""SELECT date_trunc('minute', time) AS minute, count(*) AS late_events FROM metrics
        WHERE metric_type = 'too_late_event' AND {RANGE} GROUP BY 1"""),
    "metric_types": _routed(f"""SELECT metric_type, count(*) AS count, round(sum(value), 6) AS total_value,
        round(avg(value), 6) AS avg_value FROM metrics WHERE {RANGE} GROUP BY metric_type"""),
    "active_meters": _routed(f"""SELECT meter_id, max(time) AS last_seen, count(*) AS reading_count
        FROM t_validated WHERE time >= {NOW} - INTERVAL 24 HOUR GROUP BY meter_id"""),
    "active_meters_sql": _routed(f"""SELECT meter_id, max(time) AS last_seen, count(*) AS reading_count
        FROM t_validated WHERE time >= {NOW} - INTERVAL 24 HOUR GROUP BY meter_id"""),
}

SQL["csv_alias_streamed"] = SQL["csv_alias_parse"]  # the same rows, as a stream

# Double columns rounded to 6 digits on the Spark side as in the SQL above.
ROUND6 = {
    "gap_summary_hourly": ["avg_gap_minutes"],
    "late_summary_hourly": ["avg_delay_seconds"],
    "rollup_refresh": ["avg_delay_seconds"],
    "rollup_refreshed": ["avg_delay_seconds"],
    "rollup_streamed": ["avg_delay_seconds"],
    "metrics_summary_hourly": ["total_value", "avg_value"],
    "late_pct_hourly": ["late_pct"],
    "metric_types": ["total_value", "avg_value"],
}
