"""Queries over the log that look at bits, or at long messages, in Arrow batches."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bitmaps
from tidemark.operators.long_records import parse_all
from tidemark.plans.log_queries import damaged_log, frontier_of_log, log_records
from tidemark.sources.event_log import events


def bitmap_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.missing_runs(bitmaps.offset_bitmaps(log_records(spark, sf_dir)))


def bitmap_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.repeated(bitmaps.offset_bitmaps(damaged_log(spark, sf_dir), "dt", "range_start", "attempt"))


def bitmap_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, staged = log_records(spark, sf_dir), damaged_log(spark, sf_dir)
    return bitmaps.differences(bitmaps.offset_bitmaps(log), bitmaps.offset_bitmaps(staged))


def bitmap_unsafe_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, staged = log_records(spark, sf_dir), damaged_log(spark, sf_dir)
    return bitmaps.unsafe_commits(bitmaps.offset_bitmaps(log), bitmaps.offset_bitmaps(staged), frontier_of_log(spark, sf_dir))


def long_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of which every two-hundredth has a name in its payload that the parser cannot hold."""
    named = F.concat(F.lit('{"'), F.repeat(F.lit("n"), 50_001), F.lit('":'), F.col("props"), F.lit("}"))
    is_long = F.col("event_id") % 200 == 1
    body = F.concat(
        F.lit('{"event_id":"rec-'), F.col("event_id"), F.lit('","gateway_id":"g","received_at":"2024-01-01T00:00:00Z","payload":'),
        F.when(is_long, named).otherwise(F.col("props")), F.lit("}"),
    )
    wire = events(spark, sf_dir).select("event_id", is_long.alias("is_long"), body.cast("binary").alias("value"))
    parsed = parse_all(wire.withColumnRenamed("event_id", "src_event_id"))
    size = F.when(F.col("is_long"), F.octet_length("payload")).cast("bigint")
    return parsed.select("src_event_id", "event_id", "malformed", size.alias("long_payload"))


QUERIES = {
    "bitmap_gaps": bitmap_gaps,
    "bitmap_duplicates": bitmap_duplicates,
    "bitmap_differences": bitmap_differences,
    "bitmap_unsafe_commits": bitmap_unsafe_commits,
    "long_envelopes": long_envelopes,
}
