"""Queries over the log itself."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import in_range
from tidemark.operators import audit, ranges
from tidemark.operators.records import (
    envelope_defaults,
    malformed_by_reason,
    malformed_rows,
    parse_envelope,
    parsed_rows,
    payload_field,
    records_of,
    staging_rows,
)
from tidemark.schema import PROVENANCE, RANGE_KEYS, STAGING
from tidemark.sources.event_log import damaged_staging, event_log, events

WIDTH = 50
IDLE_MS = 6 * 3600 * 1000
WRITE_DATE = "2024-01-16"
OBJECT_DATE = "2031-05-21"
WRITTEN_AT = "2031-05-21 16:20:00"


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(event_log(spark, sf_dir))


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_envelope(log_records(spark, sf_dir))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_summary(log_records(spark, sf_dir), WIDTH)


def frontier_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.commit_frontier(_summary(spark, sf_dir))


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_staging(log_records(spark, sf_dir))


def wire_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_micros("timestamp").alias("timestamp_us"),
        F.col("value").cast("string").alias("value"),
    )


def range_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.with_range(log_records(spark, sf_dir), WIDTH).select(*PROVENANCE, "range_start", "range_end")


def range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


def range_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_status(log_records(spark, sf_dir), WIDTH).select(
        *RANGE_KEYS, "range_end", "width", "records", "last_offset", "is_complete", "outcome"
    )


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = log_records(spark, sf_dir)
    return records.where(in_range(F.col("kafka_offset"), F.lit(100), F.lit(149))).select(*PROVENANCE)


def range_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_tiling(_summary(spark, sf_dir), WIDTH)


def open_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.open_ranges(_summary(spark, sf_dir))


def commit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.commit_ledger(_summary(spark, sf_dir))


def commit_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier_of_log(spark, sf_dir)


def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.object_names(_summary(spark, sf_dir), OBJECT_DATE)


def replay_from_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.replay_from_frontier(log_records(spark, sf_dir), frontier_of_log(spark, sf_dir)).select(*PROVENANCE)


def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.ingest_stats(parsed_records(spark, sf_dir), WIDTH)


def parse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_records(spark, sf_dir).select(
        *PROVENANCE,
        "event_id",
        "gateway_id",
        F.unix_micros("received_at").alias("received_us"),
        "retry_count",
        "stream_name",
        "malformed",
    )


def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_defaults(parsed_records(spark, sf_dir))


TYPE_CASES = {
    "valid": '"event_id":"E"',
    "event_id_number": '"event_id":5',
    "event_id_null": '"event_id":null',
    "event_id_missing": '"other":"E"',
    "event_id_twice": '"event_id":"E","event_id":"F"',
    "retry_decimal": '"event_id":"E","retry_count":1.0',
    "retry_text": '"event_id":"E","retry_count":"7"',
    "retry_too_big": '"event_id":"E","retry_count":2147483648',
    "retry_null": '"event_id":"E","retry_count":null',
    "retry_largest": '"event_id":"E","retry_count":2147483647',
    "stream_number": '"event_id":"E","stream_name":5',
    "stream_null": '"event_id":"E","stream_name":null',
    "header_null": '"event_id":"E","event_header":null',
    "header_list": '"event_id":"E","event_header":[1,"a"]',
    "single_quotes": "'event_id':'E'",
    "unknown_twice": '"event_id":"E","extra":1,"extra":2',
}


def envelope_type_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's envelope in one of the spellings of `TYPE_CASES`."""
    names = F.array(*[F.lit(name) for name in TYPE_CASES])
    texts = F.array(*[F.lit(text) for text in TYPE_CASES.values()])
    nth = (F.col("event_id") % len(TYPE_CASES)).cast("int")
    body = F.concat(
        F.lit('{"gateway_id":"gw","received_at":"2024-01-01T00:00:00Z",'),
        F.get(texts, nth),
        F.lit(',"payload":'),
        F.col("props"),
        F.lit("}"),
    )
    wire = events(spark, sf_dir).select(F.get(names, nth).alias("input"), body.cast("binary").alias("value"))
    return parse_envelope(wire).groupBy("input", "malformed").agg(F.count(F.lit(1)).alias("records"))


def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_records(spark, sf_dir).select(*PROVENANCE, "payload", "event_header")


def payload_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = payload_field(F.col("payload"), "$.k", "bigint")
    return (
        parsed_records(spark, sf_dir)
        .select("kafka_topic", k.alias("k"))
        .groupBy("kafka_topic")
        .agg(F.sum("k").alias("sum_k"), F.count("k").alias("count_k"))
    )


def received_at_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_records(spark, sf_dir).select(*PROVENANCE, F.unix_micros("received_at").alias("received_us"))


def received_at_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.received_at_nulls(parsed_records(spark, sf_dir))


def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_rows(parsed_records(spark, sf_dir)).select(*PROVENANCE, "malformed_reason")


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_rows(parsed_records(spark, sf_dir)).select(*PROVENANCE, "event_id")


def malformed_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_by_reason(parsed_records(spark, sf_dir))


def auth_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.auth_mix(parsed_records(spark, sf_dir))


def contract_columns(staged: DataFrame) -> DataFrame:
    """The 14 contract columns, with instants as microseconds."""
    columns = []
    for column in STAGING.fields[:14]:
        value = F.col(column.name)
        if column.dataType.typeName() == "timestamp":
            value = F.unix_micros(value)
        columns.append(value.alias(column.name))
    return staged.select(*columns)


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_columns(staging_rows(parsed_records(spark, sf_dir), F.lit(WRITTEN_AT)))


def idle_flush_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.idle_flush_points(log_records(spark, sf_dir), WIDTH, "src_ts", IDLE_MS)


def upload_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.upload_history(log_records(spark, sf_dir), WIDTH, "src_ts", IDLE_MS)


def lateness_by_write_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.lateness_by_write_date(parsed_records(spark, sf_dir), WRITE_DATE)


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.offset_gaps(log_records(spark, sf_dir))


def duplicate_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_offsets(damaged_log(spark, sf_dir))


def split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.split_ranges(damaged_log(spark, sf_dir))


def overlapping_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.overlapping_ranges(damaged_log(spark, sf_dir))


def log_vs_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.log_vs_staging(log_records(spark, sf_dir), damaged_log(spark, sf_dir))


def staged_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_rows(damaged_log(spark, sf_dir), "attempt").select(*PROVENANCE, "attempt")


def unsafe_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.unsafe_commits(log_records(spark, sf_dir), damaged_log(spark, sf_dir), frontier_of_log(spark, sf_dir))


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.consumer_lag(log_records(spark, sf_dir), WIDTH)


QUERIES = {
    "wire_log": wire_log,
    "range_assign": range_assign,
    "range_summary": range_summary,
    "range_status": range_status,
    "range_scan": range_scan,
    "range_tiling": range_tiling,
    "open_ranges": open_ranges,
    "commit_ledger": commit_ledger,
    "commit_frontier": commit_frontier,
    "object_names": object_names,
    "replay_from_frontier": replay_from_frontier,
    "ingest_stats": ingest_stats,
    "parse_envelope": parse_envelopes,
    "envelope_defaults": defaults,
    "envelope_type_errors": envelope_type_errors,
    "payload_text": payload_text,
    "payload_projection": payload_projection,
    "received_at_parse": received_at_parse,
    "received_at_nulls": received_at_nulls,
    "malformed_rows": malformed,
    "parsed_rows": parsed,
    "malformed_by_reason": malformed_reasons,
    "auth_mix": auth_mix,
    "staging_rows": contract_rows,
    "idle_flush_points": idle_flush_points,
    "upload_history": upload_history,
    "lateness_by_write_date": lateness_by_write_date,
    "offset_gaps": offset_gaps,
    "duplicate_offsets": duplicate_offsets,
    "split_ranges": split_ranges,
    "overlapping_ranges": overlapping_ranges,
    "log_vs_staging": log_vs_staging,
    "staged_dedup": staged_dedup,
    "unsafe_commits": unsafe_commits,
    "consumer_lag": consumer_lag,
}
