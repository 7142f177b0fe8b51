"""The same results in SQL, over the same tables.

The statements number the rows of a device, cut them into windows and, for the spectrum, evaluate the
discrete Fourier transform by its definition.
"""

from __future__ import annotations

SAMPLES = """
s AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, ts, event_id AS seq, value AS x, event_type = 'error' AS truth,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
  FROM events
)"""

CROWDED = """
r AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'gateway' ELSE CAST(user_id AS VARCHAR) END AS device_id,
         ts, event_id AS seq, value AS x, event_type IN ('error', 'click') AS truth
  FROM events
),
s AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts, seq) - 1 AS pos FROM r
)"""

AGGREGATES = """count(*) AS n, sqrt(avg(x * x)) AS rms, avg(x) AS mean, stddev_pop(x) AS std,
         min(ts) AS t0, max(ts) AS t1, arg_max(truth, pos) AS truth"""

WINDOWS = f"""
w AS (
  SELECT device_id, pos // 16 AS window_id, {AGGREGATES}
  FROM s GROUP BY 1, 2 HAVING count(*) = 16
)"""

ROLLING = f"""
e AS (
  SELECT s.*, k FROM s, unnest(range(pos // 8 + 1, (pos + 32) // 8 + 1)) u(k)
),
w AS (
  SELECT device_id, k - 1 AS window_id, {AGGREGATES}
  FROM e GROUP BY device_id, k HAVING max(pos) + 1 = k * 8
)"""

FLAGGED = """
f AS (
  SELECT *, (rms > 80 AND NOT isnan(rms)) OR (std > 55 AND NOT isnan(std)) AS flag FROM w
)"""

SPECTRUM = """
m AS (
  SELECT s.device_id, w.window_id, k,
         sqrt(power(sum(x * cos(2 * pi() * k * (pos % 16) / 16)), 2)
            + power(sum(x * sin(2 * pi() * k * (pos % 16) / 16)), 2)) AS magnitude
  FROM s JOIN w ON s.device_id = w.device_id AND s.pos // 16 = w.window_id, unnest(range(0, 9)) u(k)
  GROUP BY 1, 2, 3
)"""

RATE = """
rate AS (
  SELECT device_id, window_id,
         CASE WHEN t1 > t0 THEN n / ((epoch_us(t1) - epoch_us(t0)) / 1e6) ELSE 1000.0 END AS hz
  FROM w
)"""

DOMINANT = """
d AS (
  SELECT m.device_id, m.window_id, hz, k, k * (1.0 / (16 * (1.0 / hz))) AS freq
  FROM m JOIN rate USING (device_id, window_id) WHERE k > 0
  QUALIFY row_number() OVER (PARTITION BY m.device_id, m.window_id ORDER BY round(magnitude, 9) DESC, k) = 1
)"""

BATCHES = """
b AS (
  SELECT *, printf('batch_%019d_%010d.json.gz', epoch_us(t1) * 1000, window_id) AS batch_id FROM f
)"""

def metric_counts(by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
c AS (
  SELECT {key}count(*) FILTER (flag AND truth) AS tp, count(*) FILTER (flag AND NOT truth) AS fp,
         count(*) FILTER (NOT flag AND truth) AS fn, count(*) FILTER (NOT flag AND NOT truth) AS tn
  FROM f {group}
),
p AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec, tp + fp + fn + tn AS total
  FROM c
)"""


METRICS = """tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
  total AS total_windows, round(prec, 4) AS "precision", round(rec, 4) AS recall,
  round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 4) AS f1_score,
  round(CASE WHEN total > 0 THEN (tp + tn) / total ELSE 0.0 END, 4) AS accuracy"""

WINDOW_COLUMNS = """device_id, window_id, n, round(rms, 9) AS rms, round(mean, 9) AS mean, round(std, 9) AS std,
  round(epoch_us(t0) / 1e6, 6) AS window_start, round(epoch_us(t1) / 1e6, 6) AS window_end,
  truth AS ground_truth"""

PAYLOAD_COLUMNS = """device_id, batch_id, round(epoch_us(t1) / 1e6, 6) AS "timestamp", round(rms, 9) AS rms,
  round(mean, 9) AS mean, round(std, 9) AS std, round(freq, 12) AS dominant_freq_hz,
  flag AS anomaly_detected, truth AS ground_truth"""

DETECTED_COLUMNS = """device_id, window_id, n, round(rms, 9) AS rms, round(mean, 9) AS mean,
  round(std, 9) AS std, round(freq, 12) AS dominant_freq_hz, round(epoch_us(t1) / 1e6, 6) AS window_end,
  flag AS anomaly_detected, truth AS ground_truth"""

PARTITIONS = "strftime(t1, '%Y') AS year, strftime(t1, '%m') AS month, strftime(t1, '%d') AS day"


def sql(parts: list[str], query: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + query


WINDOWED = [SAMPLES, WINDOWS]
JUDGED = [SAMPLES, WINDOWS, FLAGGED]
QUEUED = [SAMPLES, WINDOWS, FLAGGED, BATCHES]
FULL = [SAMPLES, WINDOWS, SPECTRUM, RATE, DOMINANT, FLAGGED, BATCHES]
SCORED = [SAMPLES, WINDOWS, FLAGGED, metric_counts()]

NOT_SYNCED = "NOT (t1 < TIMESTAMP '2024-01-16')"
PAYLOADS = sql(FULL, f"SELECT {PAYLOAD_COLUMNS} FROM b JOIN d USING (device_id, window_id)")
LAKE = sql(FULL, f"SELECT {PARTITIONS}, {PAYLOAD_COLUMNS} FROM b JOIN d USING (device_id, window_id)")
DETECTED = sql(FULL, f"SELECT {DETECTED_COLUMNS} FROM f JOIN d USING (device_id, window_id)")
ROLLED = sql([SAMPLES, ROLLING], f"SELECT {WINDOW_COLUMNS} FROM w")
SCORES = sql(SCORED, f"SELECT {METRICS} FROM p")

#: Windows of five days by time, numbered from the epoch; the transform has as many points as the window has readings.
TIMED = [
    """
s AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, epoch_us(ts) // 432000000000 AS window_id, ts, value AS x,
         event_type = 'error' AS truth,
         row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 432000000000 ORDER BY ts, event_id) - 1 AS pos
  FROM events
)""",
    f"""
w AS (SELECT device_id, window_id, {AGGREGATES} FROM s GROUP BY 1, 2)""",
    """
m AS (
  SELECT s.device_id, s.window_id, n, k,
         sqrt(power(sum(x * cos(2 * pi() * k * pos / n)), 2) + power(sum(x * sin(2 * pi() * k * pos / n)), 2)) AS magnitude
  FROM s JOIN w USING (device_id, window_id), unnest(range(0, n // 2 + 1)) u(k) GROUP BY ALL
)""",
    RATE,
    """
d AS (
  SELECT device_id, window_id, k * (1.0 / (n * (1.0 / hz))) AS freq FROM m JOIN rate USING (device_id, window_id)
  WHERE k > 0 OR n = 1
  QUALIFY row_number() OVER (PARTITION BY device_id, window_id ORDER BY round(magnitude, 9) DESC, k) = 1
)""",
    FLAGGED,
]

CROWDED_TIMED = [
    TIMED[0].replace("CAST(user_id AS VARCHAR) AS device_id", "g AS device_id").replace("event_type = 'error'", "event_type IN ('error', 'click')")
    .replace("PARTITION BY user_id", "PARTITION BY g")
    .replace("FROM events", """FROM (SELECT *,
    CASE WHEN event_type IN ('view', 'click') THEN 'gateway' ELSE CAST(user_id AS VARCHAR) END AS g FROM events)"""),
    *TIMED[1:],
]

DAILY = """SELECT CAST(user_id AS VARCHAR) AS device_id,
            round(epoch_us(date_trunc('day', ts)) / 1e6, 6) AS interval_start, count(*) AS n,
            round(sqrt(avg(value * value)), 9) AS rms, round(avg(value), 9) AS mean,
            round(stddev_pop(value), 9) AS std,
            arg_max(event_type = 'error', struct_pack(ts := ts, e := event_id)) AS ground_truth
            FROM events GROUP BY user_id, date_trunc('day', ts)
            HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAYS"""

#: Samples by the part of the stream they come with, and those that are late: three days older than the newest before.
ARRIVED = """
a AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, ts, event_id AS seq, value AS x, event_type = 'error' AS truth,
         CASE WHEN event_type = 'signup' AND ts < TIMESTAMP '2024-01-06' THEN 2
              WHEN ts + to_days(CAST(event_id % 3 AS INTEGER)) < TIMESTAMP '2024-01-11' THEN 0
              WHEN ts + to_days(CAST(event_id % 3 AS INTEGER)) < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS part
  FROM events
),
o AS (
  SELECT a.*, coalesce(ts <= (SELECT max(b.ts) FROM a b WHERE b.device_id = a.device_id AND b.part < a.part) - INTERVAL 3 DAYS, FALSE) AS late
  FROM a
),
s AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts, seq) - 1 AS pos,
         max(ts) OVER (PARTITION BY device_id) - INTERVAL 3 DAYS AS horizon
  FROM o WHERE NOT late
)"""

LISTED = "listed AS (SELECT CAST(c_custkey AS VARCHAR) AS device_id FROM customer)"
KNOWN = "known AS (SELECT device_id, rms, mean, std, freq FROM w JOIN d USING (device_id, window_id))"

RECORDS = """
t AS (
  SELECT event_id, CASE event_type
    WHEN 'error' THEN left(props, length(props) - 1)
    WHEN 'signup' THEN '{}'
    WHEN 'purchase' THEN '[' || props || ']'
    WHEN 'view' THEN props
    ELSE printf('{"timestamp": %.6f, "anomaly_detected": true}', epoch_us(ts) / 1e6) END AS record
  FROM events
),
j AS (SELECT *, CASE WHEN json_valid(record) THEN CAST(record AS JSON) END AS js FROM t)"""


def all_oracles() -> dict[str, str]:
    return {
        "samples": sql([SAMPLES], """SELECT device_id, round(epoch_us(ts) / 1e6, 6) AS ts, seq,
            round(x, 9) AS acceleration, truth AS ground_truth FROM s"""),
        "latest_n": """SELECT CAST(user_id AS VARCHAR) AS device_id, round(epoch_us(ts) / 1e6, 6) AS ts,
            event_id AS seq, round(value, 9) AS acceleration FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10""",
        "latest_n_large": sql([CROWDED], """SELECT device_id, round(epoch_us(t) / 1e6, 6) AS ts, seq,
            round(x, 9) AS acceleration FROM (SELECT *, CASE WHEN seq % 7 <> 0 THEN ts END AS t FROM r)
            QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY t DESC NULLS LAST, seq DESC) <= 1500"""),
        "missing_features": """SELECT event_id,
            (event_type NOT IN ('view', 'click') AND value > 80)
            OR (event_type NOT IN ('signup', 'error') AND value / 2 > 55) AS anomaly_detected FROM events""",
        "labels_missing_device": """SELECT CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS device_id,
            event_id AS seq, event_type <> 'view' AND EXISTS (
              SELECT 1 FROM events f WHERE f.event_type = 'error' AND f.user_id = e.user_id
                AND e.ts >= f.ts AND e.ts <= f.ts + INTERVAL 12 HOURS) AS ground_truth
            FROM events e""",
        "detect_time_windows": sql(TIMED, f"SELECT {DETECTED_COLUMNS} FROM f JOIN d USING (device_id, window_id)"),
        "crowded_time_windows": sql(CROWDED_TIMED, """SELECT device_id, window_id, n, round(rms, 9) AS rms,
            round(mean, 9) AS mean, round(std, 9) AS std, round(freq, 12) AS dominant_freq_hz, truth AS ground_truth
            FROM f JOIN d USING (device_id, window_id)"""),
        "stream_detect_time_windows": sql(TIMED, f"""SELECT {DETECTED_COLUMNS} FROM f JOIN d USING (device_id, window_id)
            WHERE make_timestamp((window_id + 1) * 432000000000)
              <= (SELECT max(ts) FROM events) - INTERVAL 2 DAYS"""),
        "publish_twice": LAKE,
        "sync_redelivered": LAKE,
        "stream_queue": PAYLOADS,
        "stream_late_data": DAILY.replace("FROM events GROUP", """FROM events
            WHERE NOT (event_type = 'signup' AND ts < TIMESTAMP '2024-01-06') GROUP"""),
        "buffer_depth": """SELECT CAST(user_id AS VARCHAR) AS device_id, least(count(*), 64) AS depth,
            count(*) >= 64 AS is_full FROM events GROUP BY user_id""",
        "rolling_count_window": ROLLED,
        "time_window_features": f"""SELECT CAST(user_id AS VARCHAR) AS device_id,
            round(epoch_us(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')) / 1e6, 6) AS interval_start,
            count(*) AS n, round(sqrt(avg(value * value)), 9) AS rms, round(avg(value), 9) AS mean,
            round(stddev_pop(value), 9) AS std,
            round(CASE WHEN max(ts) > min(ts) THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)
              ELSE 1000.0 END, 12) AS sample_rate_hz,
            arg_max(event_type = 'error', struct_pack(ts := ts, e := event_id)) AS ground_truth
            FROM events GROUP BY user_id, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')""",
        "count_window_features": sql(WINDOWED, f"SELECT {WINDOW_COLUMNS} FROM w"),
        "magnitude_spectrum": sql([*WINDOWED, SPECTRUM, RATE], """SELECT device_id, window_id,
            CAST(k AS INTEGER) AS bin, round(k * (1.0 / (16 * (1.0 / hz))), 12) AS frequency_hz,
            round(magnitude, 6) AS magnitude FROM m JOIN rate USING (device_id, window_id)"""),
        "dominant_frequency": sql(FULL, """SELECT device_id, window_id, round(hz, 12) AS sample_rate_hz,
            CAST(k AS INTEGER) AS dominant_bin, round(freq, 12) AS dominant_freq_hz FROM d"""),
        "device_feature_defaults": sql([*FULL, LISTED, KNOWN], """SELECT device_id,
              round(coalesce(rms, 0.0), 9) AS rms, round(coalesce(mean, 0.0), 9) AS mean,
              round(coalesce(std, 0.0), 9) AS std, round(coalesce(freq, 0.0), 12) AS dominant_freq_hz
            FROM listed FULL JOIN known USING (device_id)"""),
        "detect_anomalies": DETECTED,
        "confusion_classes": sql(JUDGED, """SELECT device_id, window_id, CASE WHEN flag AND truth THEN 'TP'
            WHEN flag THEN 'FP' WHEN truth THEN 'FN' ELSE 'TN' END AS outcome FROM f"""),
        "confusion_counts": sql(JUDGED, """SELECT device_id, count(*) FILTER (flag AND truth) AS true_positives,
            count(*) FILTER (flag AND NOT truth) AS false_positives,
            count(*) FILTER (NOT flag AND truth) AS false_negatives,
            count(*) FILTER (NOT flag AND NOT truth) AS true_negatives FROM f GROUP BY device_id"""),
        "confusion_metrics": SCORES,
        "device_metrics": sql([*JUDGED, metric_counts("device_id")], f"SELECT device_id, {METRICS} FROM p"),
        "metrics_report": sql(SCORED, f"""SELECT printf('%.2f%%', "precision" * 100) AS "precision",
            printf('%.2f%%', recall * 100) AS recall, printf('%.2f%%', f1_score * 100) AS f1_score, total_windows,
            printf('precision %.2f%%, recall %.2f%%, F1 %.2f%% over %d windows: '
                || '%d hits, %d false alarms, %d missed, %d quiet',
              "precision" * 100, recall * 100, f1_score * 100, total_windows, true_positives, false_positives,
              false_negatives, true_negatives) AS report FROM (SELECT {METRICS} FROM p)"""),
        "fault_labels": """SELECT CAST(user_id AS VARCHAR) AS device_id, event_id AS seq, EXISTS (
              SELECT 1 FROM events f WHERE f.event_type = 'error' AND f.user_id = e.user_id
                AND e.ts >= f.ts AND e.ts <= f.ts + INTERVAL 12 HOURS) AS ground_truth
            FROM events e""",
        "labelled_evaluation": SCORES.replace("event_type = 'error' AS truth", """EXISTS (
              SELECT 1 FROM events g WHERE g.event_type = 'error' AND g.user_id = events.user_id
                AND events.ts >= g.ts AND events.ts <= g.ts + INTERVAL 12 HOURS) AS truth"""),
        "crowded_device_features": sql([CROWDED, WINDOWS, SPECTRUM, RATE, DOMINANT], """SELECT device_id,
            window_id, n, round(rms, 9) AS rms, round(mean, 9) AS mean, round(std, 9) AS std,
            round(freq, 12) AS dominant_freq_hz, truth AS ground_truth
            FROM w JOIN d USING (device_id, window_id)"""),
        "crowded_rolling_window": sql([CROWDED, ROLLING], f"SELECT {WINDOW_COLUMNS} FROM w"),
        "crowded_fault_labels": sql([CROWDED], """SELECT device_id, seq, EXISTS (
              SELECT 1 FROM s f WHERE f.truth AND f.device_id = s.device_id
                AND s.ts >= f.ts AND s.ts <= f.ts + INTERVAL 10 MINUTES) AS ground_truth FROM s"""),
        "payload_json": PAYLOADS,
        "partition_keys": sql(QUEUED, f"""SELECT device_id, window_id, batch_id, {PARTITIONS},
            strftime(t1, 'year=%Y/month=%m/day=%d/device_id=') || device_id || '/' || batch_id AS object_key
            FROM b"""),
        "json_decode": """SELECT event_id, CASE WHEN json_valid(t) THEN CAST(json_extract(t, '$.k') AS BIGINT) END
            AS k, CASE WHEN NOT json_valid(t) THEN t END AS corrupt FROM (SELECT event_id,
            CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END AS t FROM events)""",
        "archive_quarantine": "WITH " + RECORDS + """
            SELECT event_id, CASE WHEN js IS NULL THEN 'not json' WHEN json_type(js) <> 'OBJECT' THEN 'not an object'
              WHEN len(json_keys(js)) = 0 THEN 'no fields'
              WHEN json_extract(js, '$.timestamp') IS NULL THEN 'no timestamp' END AS reason,
              round(CAST(json_extract(js, '$.timestamp') AS DOUBLE), 6) AS "timestamp",
              CAST(json_extract(js, '$.anomaly_detected') AS BOOLEAN) AS anomaly_detected FROM j""",
        "archive_layout": """SELECT file_name, reason, 'edge' AS device_id, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_records,
              CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_dated, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_anomalies
            FROM (SELECT strftime(ts, 'batch_%Y%m%d_') || event_type || '.json.gz' AS file_name, count(*) AS n,
              CASE event_type WHEN 'error' THEN 'not gzip'
                WHEN 'purchase' THEN CASE WHEN any_value(day(ts)) % 2 = 0 THEN 'zero bytes' ELSE 'empty' END END AS reason
              FROM events WHERE event_type <> 'view' GROUP BY strftime(ts, 'batch_%Y%m%d_'), event_type)""",
        "archive_scan": PAYLOADS,
        "archive_audit": PAYLOADS,
        "fifo_order": sql(QUEUED, """SELECT device_id, batch_id,
            row_number() OVER (PARTITION BY device_id ORDER BY batch_id) AS queue_position FROM b"""),
        "fifo_foreign_ids": sql([CROWDED], """, b AS (
              SELECT device_id, strftime(ts, 'batch_%Y-%m-%d') || '_' || seq AS batch_id FROM r)
            SELECT device_id, batch_id, row_number() OVER (PARTITION BY device_id ORDER BY batch_id) AS queue_position FROM b"""),
        "peek_oldest": sql(QUEUED, """SELECT device_id, batch_id, round(epoch_us(t1) / 1e6, 6) AS "timestamp",
            flag AS anomaly_detected FROM b
            QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY batch_id) = 1"""),
        "pending_batches": sql(QUEUED, f"SELECT device_id, batch_id FROM b WHERE {NOT_SYNCED}"),
        "queue_depth": sql(QUEUED, f"SELECT device_id, count(*) AS depth FROM b WHERE {NOT_SYNCED} GROUP BY 1"),
        "dedupe_redelivery": sql(QUEUED, """SELECT device_id, batch_id,
            CASE WHEN flag THEN 3 ELSE 1 END AS delivery FROM b"""),
        "backlog_view": sql(QUEUED, f"""SELECT device_id, batch_id,
            row_number() OVER (PARTITION BY device_id ORDER BY batch_id) AS queue_position
            FROM b WHERE {NOT_SYNCED}"""),
        "lake_roundtrip": LAKE,
        "pruned_read": sql(QUEUED, f"""SELECT * FROM (SELECT {PARTITIONS}, count(*) AS n_windows,
            count(*) FILTER (flag) AS n_anomalies FROM b GROUP BY ALL) WHERE day BETWEEN '10' AND '20'
            AND month = '01' AND year = '2024'"""),
        "lake_listing": sql(QUEUED, f"""SELECT {PARTITIONS}, device_id, CAST(ceil(count(*) / 3) AS BIGINT) AS n_files,
            TRUE AS sizes_agree FROM b GROUP BY ALL"""),
        "stream_count_window": ROLLED,
        "stream_count_window_unordered": sql([ARRIVED, """
            e AS (SELECT s.*, k FROM s, unnest(range(pos // 8 + 1, (pos + 16) // 8 + 1)) u(k)),
            w AS (SELECT device_id, k - 1 AS window_id, any_value(horizon) AS horizon, """ + AGGREGATES + """
              FROM e GROUP BY device_id, k HAVING max(pos) + 1 = k * 8)"""],
            f"SELECT {WINDOW_COLUMNS} FROM w WHERE t1 <= horizon"),
        "stream_late_samples": sql([ARRIVED], """SELECT device_id, round(epoch_us(ts) / 1e6, 6) AS ts, seq,
            round(x, 9) AS acceleration, truth AS ground_truth FROM o WHERE late"""),
        "stream_fault_labels": """SELECT CAST(user_id AS VARCHAR) AS device_id, event_id AS seq, EXISTS (
              SELECT 1 FROM events f WHERE f.event_type = 'error' AND f.user_id = e.user_id
                AND e.ts >= f.ts AND e.ts <= f.ts + INTERVAL 12 HOURS) AS ground_truth
            FROM events e WHERE ts < TIMESTAMP '2024-01-26'""",
        "stream_window_batches": sql(WINDOWED, f"SELECT {WINDOW_COLUMNS} FROM w"),
        "stream_detect": DETECTED,
        "stream_time_window": DAILY,
        "stream_sync": LAKE,
        "stream_metrics": SCORES,
    }
