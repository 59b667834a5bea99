"""Schemas of the log, the staging area and the ledger."""

from pyspark.sql import types as T

# --- fixed values of the wire and staging contracts ---
TOPICS = ("ingestion-events", "ingestion-signals", "ingestion-logs")
RANGE_WIDTH = 10_000
IDLE_MS = 30_000
TOMBSTONE_REASON = "record has no payload (tombstone?)"
REASON_LIMIT = 200
# --- end of fixed values ---

WIRE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# Published to every reader of the staging area: columns may be added (nullable),
# never renamed, retyped or removed.
STAGING = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("gateway_id", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("stream_name", T.StringType()),
        T.StructField("event_header", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("kafka_topic", T.StringType(), False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("malformed", T.BooleanType(), False),
        T.StructField("malformed_reason", T.StringType()),
        # The message as it came, for malformed rows. Not one of the 14 columns of the contract.
        T.StructField("raw_value", T.BinaryType()),
    ]
)

ENVELOPE_COLUMNS = STAGING.fieldNames()[:7]
PROVENANCE = ["kafka_topic", "kafka_partition", "kafka_offset"]
PARTITION_KEYS = ["kafka_topic", "kafka_partition"]
RANGE_KEYS = ["kafka_topic", "kafka_partition", "range_start"]

# Directory columns of the staging area: copies of contract columns, so that the
# 14 contract columns all stay inside the file.
LAYOUT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("range_start", T.LongType()),
    ]
)
LAYOUT_COLUMNS = LAYOUT.fieldNames()
STAGED = T.StructType(STAGING.fields + LAYOUT.fields)

LEDGER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("range_start", T.LongType()),
        T.StructField("range_end", T.LongType()),
        T.StructField("dt", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("commit_offset", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
