"""The same questions as ANSI SQL over the base tables, written independently of the
Spark plans: plain windows, self-joins and `EXCEPT`."""

LOG = """
k AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'ingestion-signals'
              WHEN event_type = 'error' THEN 'ingestion-logs' ELSE 'ingestion-events' END AS kafka_topic,
         CAST(user_id % 6 AS INT) AS kafka_partition, event_id, ts, props
  FROM events),
n AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY event_id) - 1 AS BIGINT)
         AS kafka_offset
  FROM k),
wire AS (
  SELECT kafka_topic, kafka_partition, kafka_offset,
    CASE WHEN event_id % 29 = 3 THEN NULL ELSE ts END AS kafka_timestamp,
    event_id AS src_event_id, ts AS src_ts,
    kafka_offset - kafka_offset % 50 AS rs, kafka_offset - kafka_offset % 50 + 49 AS re,
    CASE WHEN event_id % 97 = 13 THEN NULL
         WHEN event_id % 89 = 5 THEN '{"event_id": tru'
         WHEN event_id % 83 = 7 THEN '{"seq":17}'
         ELSE concat('{"event_id":"rec-', CAST(event_id AS STRING), '","gateway_id":"node-',
              CAST(user_id_mod AS STRING), '","received_at":"',
              CASE WHEN event_id % 71 = 11 THEN 'yesterday noon'
                   ELSE concat(replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T'), 'Z') END, '"',
              CASE WHEN event_id % 7 = 0 THEN ''
                   ELSE concat(',"retry_count":', CAST(event_id % 4 AS STRING)) END,
              CASE WHEN event_id % 3 = 0 THEN concat(',"event_header":{"who":"u', CAST(user_id_mod AS STRING), '"}')
                   ELSE '' END,
              ',"payload":', props, '}') END AS value
  FROM (SELECT n.*, kafka_partition % 3 AS user_id_mod FROM n) q
  WHERE kafka_offset % 101 <> 57 AND kafka_offset % 350 <> 149)"""

JUDGED = """
judged AS (
  SELECT *,
    CASE WHEN value IS NULL THEN 'record has no payload (tombstone?)'
         WHEN NOT json_valid(value) THEN 'invalid JSON'
         WHEN json_extract_string(value, '$.event_id') IS NULL THEN 'missing field `event_id`' END AS reason
  FROM wire),
parsed AS (
  SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, src_event_id, rs, re, reason,
    reason IS NOT NULL AS malformed,
    CASE WHEN reason IS NULL THEN json_extract_string(value, '$.event_id') END AS event_id,
    CASE WHEN reason IS NULL THEN json_extract_string(value, '$.gateway_id') END AS gateway_id,
    CASE WHEN reason IS NULL THEN epoch_us(TRY_CAST(replace(replace(
      json_extract_string(value, '$.received_at'), 'T', ' '), 'Z', '') AS TIMESTAMP)) END AS received_us,
    CASE WHEN reason IS NULL
         THEN coalesce(CAST(json_extract_string(value, '$.retry_count') AS INT), 0) END AS retry_count,
    CASE WHEN reason IS NULL THEN json_extract_string(value, '$.stream_name') END AS stream_name,
    CASE WHEN reason IS NULL
         THEN CAST(json(json_extract(value, '$.event_header')) AS VARCHAR) END AS event_header,
    CASE WHEN reason IS NULL THEN CAST(json(json_extract(value, '$.payload')) AS VARCHAR) END AS payload
  FROM judged)"""

SUMMARY = """
summary AS (
  SELECT kafka_topic, kafka_partition, rs, re, count(*) AS records, max(kafka_offset) AS last_offset
  FROM wire GROUP BY ALL),
status AS (
  SELECT *, last_offset >= re AS is_complete,
    CASE WHEN last_offset >= re THEN 'committed'
         WHEN lead(rs) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY rs) IS NOT NULL THEN 'abandoned'
         ELSE 'open' END AS outcome
  FROM summary),
frontier AS (
  SELECT kafka_topic, kafka_partition, max(CASE WHEN is_complete THEN re + 1 END) AS commit_offset
  FROM status GROUP BY ALL)"""

DAMAGED = """
damaged AS (
  SELECT kafka_topic, kafka_partition, kafka_offset, '2031-05-20' AS dt, rs, re, 1 AS attempt
  FROM wire WHERE rs % 250 = 0 AND kafka_offset % 50 < 20
  UNION ALL
  SELECT kafka_topic, kafka_partition, kafka_offset, '2031-05-21', rs, re, 2
  FROM wire WHERE NOT (rs % 350 = 50 AND kafka_offset % 50 = 11)
  UNION ALL
  SELECT kafka_topic, kafka_partition, kafka_offset, '2031-05-22',
    kafka_offset - kafka_offset % 80, kafka_offset - kafka_offset % 80 + 79, 3
  FROM wire WHERE kafka_partition = 5)"""

ARRIVALS = """
arrivals AS (
  SELECT *, coalesce(epoch_us(lead(src_ts) OVER w) - epoch_us(src_ts) >= 21600000000, FALSE) AS is_idle,
    lead(kafka_offset) OVER w IS NULL AS is_last,
    count(*) OVER (PARTITION BY kafka_topic, kafka_partition, rs ORDER BY kafka_offset
                   ROWS UNBOUNDED PRECEDING) AS upload_rows
  FROM wire WINDOW w AS (PARTITION BY kafka_topic, kafka_partition, rs ORDER BY kafka_offset))"""

KEY = "kafka_topic, kafka_partition, kafka_offset"
RANGE = "kafka_topic, kafka_partition, rs AS range_start"

CONTRACT = f"""
SELECT event_id, gateway_id, received_us AS received_at, retry_count, stream_name, event_header, payload, {KEY},
  epoch_us(kafka_timestamp) // 1000 * 1000 AS kafka_timestamp,
  epoch_us(TIMESTAMP '2031-05-21 16:20:00') AS ingested_at, malformed, reason AS malformed_reason
FROM parsed"""

STAGED_COUNTS = f"SELECT {RANGE}, records FROM summary"


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",".join((LOG, *ctes)) + "\n" + select


ORACLE = {
    "wire_log": _sql(f"SELECT {KEY}, epoch_us(kafka_timestamp) AS timestamp_us, value FROM wire"),
    "range_assign": _sql(f"SELECT {KEY}, rs AS range_start, re AS range_end FROM wire"),
    "range_summary": _sql(f"SELECT {RANGE}, re AS range_end, records, last_offset FROM summary", SUMMARY),
    "range_status": _sql(
        f"""SELECT {RANGE}, re AS range_end, re - rs + 1 AS width, records, last_offset, is_complete, outcome
        FROM status""",
        SUMMARY,
    ),
    "range_scan": _sql(f"SELECT {KEY} FROM wire WHERE kafka_offset BETWEEN 100 AND 149"),
    "range_tiling": _sql(
        f"""SELECT {RANGE}, re AS range_end, lag(re) OVER w AS previous_end, lag(re) OVER w + 1 = rs AS is_adjacent
        FROM summary WINDOW w AS (PARTITION BY kafka_topic, kafka_partition ORDER BY rs)""",
        SUMMARY,
    ),
    "open_ranges": _sql(
        """SELECT kafka_topic, CAST(count(DISTINCT kafka_partition) FILTER (WHERE outcome = 'open') AS BIGINT)
        AS open_partitions FROM status GROUP BY kafka_topic""",
        SUMMARY,
    ),
    "commit_ledger": _sql(
        f"SELECT {RANGE}, re AS range_end, re + 1 AS commit_offset FROM status WHERE is_complete", SUMMARY
    ),
    "commit_frontier": _sql(
        """SELECT kafka_topic, kafka_partition, max(CASE WHEN is_complete THEN re + 1 END) AS commit_offset,
          count(*) FILTER (WHERE outcome = 'committed') AS committed,
          count(*) FILTER (WHERE outcome = 'abandoned') AS abandoned,
          count(*) FILTER (WHERE outcome = 'open') AS open_ranges
        FROM status GROUP BY ALL""",
        SUMMARY,
    ),
    "object_names": _sql(
        f"""SELECT {RANGE}, concat(kafka_topic, '/dt=2031-05-21/', kafka_partition, '-', rs, '-', re, '.parquet')
        AS object_name FROM summary""",
        SUMMARY,
    ),
    "replay_from_frontier": _sql(
        f"""SELECT {KEY} FROM wire LEFT JOIN frontier USING (kafka_topic, kafka_partition)
        WHERE kafka_offset >= coalesce(commit_offset, 0)""",
        SUMMARY,
    ),
    "ingest_stats": _sql(
        """SELECT (SELECT count(*) FROM wire) AS records, (SELECT count(*) FROM parsed WHERE malformed) AS malformed,
          (SELECT count(*) FROM status) AS uploads, (SELECT count(*) FROM status WHERE is_complete) AS commits,
          (SELECT count(*) FROM status WHERE NOT is_complete) AS partial_uploads""",
        JUDGED,
        SUMMARY,
    ),
    "parse_envelope": _sql(
        f"SELECT {KEY}, event_id, gateway_id, received_us, retry_count, stream_name, malformed FROM parsed", JUDGED
    ),
    "envelope_defaults": _sql(
        """SELECT retry_count, event_header IS NOT NULL AS has_header, count(*) AS records
        FROM parsed WHERE NOT malformed GROUP BY ALL""",
        JUDGED,
    ),
    "envelope_type_errors": """
        WITH cases(nth, input, malformed) AS (VALUES
          (0, 'valid', FALSE), (1, 'event_id_number', TRUE), (2, 'event_id_null', TRUE),
          (3, 'event_id_missing', TRUE), (4, 'event_id_twice', TRUE), (5, 'retry_decimal', TRUE),
          (6, 'retry_text', TRUE), (7, 'retry_too_big', TRUE), (8, 'retry_null', TRUE),
          (9, 'retry_largest', FALSE), (10, 'stream_number', TRUE), (11, 'stream_null', FALSE),
          (12, 'header_null', FALSE), (13, 'header_list', FALSE), (14, 'single_quotes', TRUE),
          (15, 'unknown_twice', FALSE))
        SELECT input, malformed, count(*) AS records FROM events JOIN cases ON event_id % 16 = nth GROUP BY ALL""",
    "payload_text": _sql(f"SELECT {KEY}, payload, event_header FROM parsed", JUDGED),
    "payload_projection": _sql(
        """SELECT kafka_topic, CAST(sum(CAST(json_extract_string(payload, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
          count(json_extract_string(payload, '$.k')) AS count_k FROM parsed GROUP BY ALL""",
        JUDGED,
    ),
    "received_at_parse": _sql(f"SELECT {KEY}, received_us FROM parsed", JUDGED),
    "received_at_nulls": _sql(
        """SELECT kafka_topic, count(*) AS records FROM parsed WHERE NOT malformed AND received_us IS NULL
        GROUP BY ALL""",
        JUDGED,
    ),
    "malformed_rows": _sql(f"SELECT {KEY}, reason AS malformed_reason FROM parsed WHERE malformed", JUDGED),
    "parsed_rows": _sql(f"SELECT {KEY}, event_id FROM parsed WHERE NOT malformed", JUDGED),
    "malformed_by_reason": _sql(
        """SELECT kafka_topic, reason AS malformed_reason, count(*) AS records FROM parsed WHERE malformed
        GROUP BY ALL""",
        JUDGED,
    ),
    "auth_mix": _sql(
        """SELECT kafka_topic, event_header IS NOT NULL AS has_header, count(*) AS records FROM parsed
        WHERE NOT malformed GROUP BY ALL""",
        JUDGED,
    ),
    "staging_rows": _sql(CONTRACT, JUDGED),
    "idle_flush_points": _sql(
        f"SELECT {RANGE}, kafka_offset AS through_offset FROM arrivals WHERE is_idle", ARRIVALS
    ),
    "upload_history": _sql(
        f"""SELECT {RANGE}, CAST(row_number() OVER (PARTITION BY kafka_topic, kafka_partition, rs
          ORDER BY kafka_offset) AS INT) AS upload, upload_rows FROM arrivals WHERE is_idle OR is_last""",
        ARRIVALS,
    ),
    "lateness_by_write_date": _sql(
        """SELECT strftime(make_timestamp(received_us), '%Y-%m-%d') AS event_date, count(*) AS late_rows
        FROM parsed WHERE received_us < epoch_us(TIMESTAMP '2024-01-16') GROUP BY ALL""",
        JUDGED,
    ),
    "offset_gaps": _sql(
        """SELECT kafka_topic, kafka_partition, kafka_offset + 1 AS gap_start, following - 1 AS gap_end,
          following - kafka_offset - 1 AS missing
        FROM (SELECT *, lead(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset)
              AS following FROM wire) q WHERE following - kafka_offset > 1"""
    ),
    "duplicate_offsets": _sql(
        f"SELECT {KEY}, count(*) AS copies FROM damaged GROUP BY ALL HAVING count(*) > 1", DAMAGED
    ),
    "split_ranges": _sql(
        f"""SELECT {RANGE}, re AS range_end, count(DISTINCT dt) AS dates FROM damaged
        GROUP BY kafka_topic, kafka_partition, rs, re HAVING count(DISTINCT dt) > 1""",
        DAMAGED,
    ),
    "overlapping_ranges": _sql(
        """SELECT a.kafka_topic, a.kafka_partition, a.rs AS a_start, a.re AS a_end, b.rs AS b_start, b.re AS b_end
        FROM r a JOIN r b ON a.kafka_topic = b.kafka_topic AND a.kafka_partition = b.kafka_partition
          AND a.rs <= b.re AND b.rs <= a.re AND (a.rs < b.rs OR (a.rs = b.rs AND a.re < b.re))""",
        DAMAGED,
        "\nr AS (SELECT DISTINCT kafka_topic, kafka_partition, rs, re FROM damaged)",
    ),
    "log_vs_staging": _sql(
        f"""SELECT {KEY}, 'log_only' AS side FROM (SELECT {KEY} FROM wire EXCEPT SELECT {KEY} FROM damaged) q
        UNION ALL
        SELECT {KEY}, 'staging_only' FROM (SELECT {KEY} FROM damaged EXCEPT SELECT {KEY} FROM wire) q""",
        DAMAGED,
    ),
    "staged_dedup": _sql(f"SELECT {KEY}, max(attempt) AS attempt FROM damaged GROUP BY ALL", DAMAGED),
    "unsafe_commits": _sql(
        f"""SELECT {KEY} FROM (SELECT {KEY} FROM wire EXCEPT SELECT {KEY} FROM damaged) q
        JOIN frontier USING (kafka_topic, kafka_partition) WHERE kafka_offset < commit_offset""",
        SUMMARY,
        DAMAGED,
    ),
    "consumer_lag": _sql(
        """SELECT kafka_topic, kafka_partition, max(last_offset) + 1 AS head,
          coalesce(max(CASE WHEN is_complete THEN re + 1 END), 0) AS frontier,
          max(last_offset) + 1 - coalesce(max(CASE WHEN is_complete THEN re + 1 END), 0) AS lag
        FROM status GROUP BY ALL""",
        SUMMARY,
    ),
    "object_lookup": _sql(
        f"""SELECT {KEY} FROM wire WHERE kafka_topic = 'ingestion-events' AND kafka_partition = 0 AND rs = 0"""
    ),
    "staged_readback": _sql(CONTRACT, JUDGED),
    "superset_merge": _sql(STAGED_COUNTS, SUMMARY),
    "overwrite_converges": _sql(STAGED_COUNTS, SUMMARY),
    "staged_stream": _sql(STAGED_COUNTS, SUMMARY),
    "object_row_order": _sql(
        """SELECT concat(kafka_topic, '/dt=2031-05-21/', kafka_partition, '-', rs, '-', re, '.parquet')
        AS object_name, NOT (rs % 150 = 50 AND records > 1) AS is_sorted FROM summary""",
        SUMMARY,
    ),
    "published_objects": _sql(
        """SELECT concat(kafka_topic, '/dt=2031-05-21/', kafka_partition, '-', rs, '-', re, '.parquet')
        AS object_name, records FROM summary""",
        SUMMARY,
    ),
    "staged_objects": _sql(CONTRACT, JUDGED),
    "staged_frontier": _sql("SELECT * FROM frontier WHERE commit_offset IS NOT NULL", SUMMARY),
    "settled_rows": _sql(f"SELECT {RANGE}, records FROM status WHERE outcome <> 'open'", SUMMARY),
    "settled_ranges": _sql(f"SELECT {RANGE}, records FROM status WHERE outcome <> 'open'", SUMMARY),
    "dirty_ranges": _sql(f"SELECT DISTINCT {RANGE} FROM wire WHERE src_event_id % 2 = 1"),
    "contract_violations": _sql(
        """SELECT n.check_name, count(q.check_name) AS violations FROM (VALUES
          ('null_kafka_topic'), ('null_kafka_partition'), ('null_kafka_offset'), ('null_ingested_at'),
          ('null_malformed'), ('envelope_on_malformed'), ('reason_on_parsed'), ('no_reason_on_malformed'),
          ('incomplete_envelope_on_parsed')) n(check_name) LEFT JOIN (SELECT unnest([
            CASE WHEN kafka_offset % 41 = 9 THEN 'null_kafka_topic' END,
            CASE WHEN kafka_offset % 37 = 8 THEN 'null_kafka_partition' END,
            CASE WHEN kafka_offset % 43 = 2 THEN 'null_kafka_offset' END,
            CASE WHEN kafka_offset % 29 = 6 THEN 'null_ingested_at' END,
            CASE WHEN m IS NULL THEN 'null_malformed' END,
            CASE WHEN m AND coalesce(e, g, CAST(received_us AS VARCHAR), CAST(retry_count AS VARCHAR),
                                     stream_name, event_header, p) IS NOT NULL THEN 'envelope_on_malformed' END,
            CASE WHEN NOT m AND r IS NOT NULL THEN 'reason_on_parsed' END,
            CASE WHEN m AND r IS NULL THEN 'no_reason_on_malformed' END,
            CASE WHEN NOT m AND (e IS NULL OR g IS NULL OR retry_count IS NULL OR p IS NULL)
                 THEN 'incomplete_envelope_on_parsed' END]) AS check_name FROM broken) q
        ON n.check_name = q.check_name GROUP BY n.check_name""",
        JUDGED,
        """
broken AS (
  SELECT *, CASE WHEN kafka_offset % 23 <> 5 THEN malformed END AS m,
    CASE WHEN kafka_offset % 5 <> 1 THEN CASE WHEN kafka_offset % 19 = 4 THEN 'no reason' ELSE reason END END AS r,
    CASE WHEN kafka_offset % 17 <> 3 THEN event_id END AS e,
    CASE WHEN kafka_offset % 7 = 4 THEN 'someone' ELSE gateway_id END AS g,
    CASE WHEN kafka_offset % 13 <> 8 THEN payload END AS p
  FROM parsed)""",
    ),
    "trace_rows": _sql(f"SELECT {KEY}, event_id, src_event_id FROM parsed", JUDGED),
}

TILED = """
tiled AS (
  SELECT kafka_topic, kafka_partition, kafka_offset - kafka_offset % 80 AS rs, kafka_offset - kafka_offset % 80 + 79 AS re,
    count(*) AS records, max(kafka_offset) AS last_offset FROM wire GROUP BY ALL)"""

ORACLE |= {
    "bitmap_gaps": ORACLE["offset_gaps"],
    "bitmap_duplicates": ORACLE["duplicate_offsets"],
    "bitmap_differences": ORACLE["log_vs_staging"],
    "bitmap_unsafe_commits": ORACLE["unsafe_commits"],
    "manifest_gaps": ORACLE["offset_gaps"],
    "manifest_vs_log": _sql(
        f"""SELECT {KEY}, CASE WHEN kafka_offset % 7 = 3 THEN 'log_only' ELSE 'staging_only' END AS side
        FROM wire WHERE (kafka_offset % 7 = 3) <> (kafka_offset % 11 = 4)"""
    ),
    "fenced_writer": _sql(
        """SELECT kafka_topic, kafka_partition, epoch_us(TIMESTAMP '2031-05-21 16:20:00') AS ingested_at,
          count(*) AS records, commit_offset
        FROM wire LEFT JOIN frontier USING (kafka_topic, kafka_partition) GROUP BY ALL""",
        SUMMARY,
    ),
    "change_feed": _sql(STAGED_COUNTS, SUMMARY),
    "retiled_area": _sql(
        """SELECT concat(kafka_topic, '/dt=2031-05-21/', kafka_partition, '-', rs, '-', re, '.parquet') AS object_name,
          records, records AS read_back, last_offset, CASE WHEN last_offset >= re THEN re + 1 END AS commit_offset,
          CASE WHEN last_offset >= re THEN 'committed'
               WHEN lead(rs) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY rs) IS NOT NULL THEN 'abandoned'
               ELSE 'open' END AS outcome FROM tiled""",
        TILED,
    ),
    "long_envelopes": """
        SELECT event_id AS src_event_id, 'rec-' || event_id AS event_id, FALSE AS malformed,
          CASE WHEN event_id % 200 = 1 THEN CAST(strlen(props) + 50001 + 5 AS BIGINT) END AS long_payload FROM events""",
    "held_ranges": _sql(f"SELECT {RANGE}, records, is_complete FROM status", SUMMARY),
    "trace_keys": _sql(f"SELECT {KEY}, event_id FROM parsed WHERE src_event_id % 500 = 7 AND NOT malformed", JUDGED),
    "shredded_projection": ORACLE["payload_projection"],
    "run_counters": ORACLE["ingest_stats"],
}
