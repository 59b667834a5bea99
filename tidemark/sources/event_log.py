"""A partitioned log derived from the `events` table.

The shape of a telemetry log with everything that goes wrong in one: tombstones, broken
JSON, documents that are no envelope, bad timestamps, absent headers and counters,
missing broker timestamps, and offset holes, some at the end of a range.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import with_position
from tidemark.session import configure

TOPIC_OF_EVENT = (
    "CASE event_type WHEN 'signup' THEN 'ingestion-signals' WHEN 'error' THEN 'ingestion-logs'"
    " ELSE 'ingestion-events' END"
)

ENVELOPE_TEXT = """
CASE
  WHEN event_id % 97 = 13 THEN NULL
  WHEN event_id % 89 = 5 THEN '{"event_id": tru'
  WHEN event_id % 83 = 7 THEN '{"seq":17}'
  ELSE concat(
    '{"event_id":"rec-', CAST(event_id AS STRING),
    '","gateway_id":"node-', CAST(partition % 3 AS STRING),
    '","received_at":"',
    CASE WHEN event_id % 71 = 11 THEN 'yesterday noon'
         ELSE concat(replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T'), 'Z') END,
    '"',
    CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(',"retry_count":', CAST(event_id % 4 AS STRING)) END,
    CASE WHEN event_id % 3 = 0 THEN concat(',"event_header":{"who":"u', CAST(partition % 3 AS STRING), '"}')
         ELSE '' END,
    ',"payload":', props, '}')
END
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire rows, plus `src_event_id` and `src_ts` to trace them back to `events`."""
    keyed = events(spark, sf_dir).select(
        F.expr(TOPIC_OF_EVENT).alias("topic"),
        F.expr("CAST(user_id % 6 AS INT)").alias("partition"),
        "event_id",
        "ts",
        "props",
    )
    numbered = with_position(keyed, ["topic", "partition"], "event_id", "offset")
    # The holes of the log: offsets that compaction or transaction markers took.
    present = numbered.where("offset % 101 <> 57 AND offset % 350 <> 149")
    no_stamp = F.col("event_id") % 29 == 3
    return present.select(
        "topic",
        "partition",
        "offset",
        F.when(~no_stamp, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(no_stamp, -1).otherwise(0).alias("timestampType"),
        F.expr(ENVELOPE_TEXT).cast("binary").alias("value"),
        F.col("event_id").alias("src_event_id"),
        F.col("ts").cast("timestamp").alias("src_ts"),
    )


def broken_contract(staged: DataFrame) -> DataFrame:
    """Staged rows that break each rule of the contract here and there."""
    nth = F.col("kafka_offset")
    lost = {
        "event_id": nth % 17 == 3,
        "payload": nth % 13 == 8,
        "kafka_topic": nth % 41 == 9,
        "kafka_partition": nth % 37 == 8,
        "kafka_offset": nth % 43 == 2,
        "ingested_at": nth % 29 == 6,
        "malformed": nth % 23 == 5,
        "malformed_reason": nth % 5 == 1,
    }
    added = {"gateway_id": (nth % 7 == 4, "someone"), "malformed_reason": (nth % 19 == 4, "no reason")}
    columns = []
    for name in staged.columns:
        column = F.col(name)
        if name in added:
            column = F.when(added[name][0], added[name][1]).otherwise(column)
        if name in lost:
            column = F.when(~lost[name], column)
        columns.append(column.alias(name))
    return staged.select(*columns)


def damaged_staging(log: DataFrame) -> DataFrame:
    """Staged keys with what audits look for, derived from the log in one pass.

    Attempt 1 is a partial upload before midnight in every fifth range; attempt 2 the full
    upload of the next day, with an offset lost in every seventh range; attempt 3 a changed
    width on partition 5.
    """

    def attempt(condition: str, date: str, width: int, number: int) -> str:
        start = f"kafka_offset - kafka_offset % {width}"
        return (
            f"CASE WHEN {condition} THEN named_struct('dt', '{date}', 'range_start', {start},"
            f" 'range_end', {start} + {width - 1}, 'attempt', {number}) END"
        )

    attempts = ", ".join(
        [
            attempt("kafka_offset % 250 < 20", "2031-05-20", 50, 1),
            attempt("kafka_offset % 350 <> 61", "2031-05-21", 50, 2),
            attempt("kafka_partition = 5", "2031-05-22", 80, 3),
        ]
    )
    return log.selectExpr(
        "kafka_topic", "kafka_partition", "kafka_offset", f"inline(array_compact(array({attempts})))"
    )
