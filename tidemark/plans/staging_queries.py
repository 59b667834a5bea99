"""Queries over a staging area written from the log."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions import object_name
from tidemark.operators import audit, bitmaps
from tidemark.plans.log_queries import OBJECT_DATE, WIDTH, contract_columns, log_records
from tidemark.schema import IDLE_MS, PROVENANCE, RANGE_KEYS, WIRE
from tidemark.session import scratch_dir
from tidemark.sinks import manifest, row_index, staging, versions
from tidemark.sinks.area import ManifestArea, ObjectArea, file_stamps
from tidemark.sinks.manifest import read_object, read_settled, read_staging, stage_batch, stage_log
from tidemark.sinks.objects import publish_objects, read_objects
from tidemark.sources.changes import read_changes
from tidemark.sources.event_log import broken_contract, event_log, events
from tidemark.streaming.hold import RELEASED, hold_open_ranges
from tidemark.streaming.ingest import start

NOW = datetime(2031, 5, 21, 16, 20, tzinfo=timezone.utc)

_staged: dict[tuple, ManifestArea] = {}


def staged_log(spark: SparkSession, sf_dir: str) -> ManifestArea:
    """The whole log, staged once per application and state of the table for the queries that
    only read it."""
    key = (spark.sparkContext.applicationId, sf_dir, file_stamps(spark, events(spark, sf_dir).inputFiles()))
    if key not in _staged:
        area = ManifestArea(scratch_dir(spark, "staged"))
        stage_log(event_log(spark, sf_dir), area, WIDTH, now=NOW)
        _staged[key] = area
    return _staged[key]


def _new_area(spark: SparkSession, name: str) -> ManifestArea:
    return ManifestArea(scratch_dir(spark, name))


def _range_counts(spark: SparkSession, area: ManifestArea) -> DataFrame:
    return read_staging(spark, area).groupBy(*RANGE_KEYS).agg(F.count(F.lit(1)).alias("records"))


def staged_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_columns(read_staging(spark, staged_log(spark, sf_dir)))


def object_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"ingestion-events/dt={OBJECT_DATE}/0-0-49.parquet"
    return read_object(spark, staged_log(spark, sf_dir), name).select(*PROVENANCE)


def object_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged files, every third range of them read as if it had been written backwards."""
    rows = read_staging(spark, staged_log(spark, sf_dir))
    index = F.col("_metadata.row_index")
    placed = rows.select(
        "topic",
        "dt",
        "part",
        "range_start",
        (F.col("range_start") + WIDTH - 1).alias("range_end"),
        "kafka_offset",
        F.col("_metadata.file_path").alias("file_path"),
        F.when(F.col("range_start") % (3 * WIDTH) == WIDTH, -index).otherwise(index).alias("row_index"),
    )
    return audit.object_row_order(placed)


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations among the staged rows after some of them were damaged."""
    return audit.contract_violations(broken_contract(read_staging(spark, staged_log(spark, sf_dir))))


def trace_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = read_staging(spark, staged_log(spark, sf_dir)).select(*PROVENANCE, "event_id")
    return audit.trace_rows(staged, log_records(spark, sf_dir), "src_event_id")


def superset_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each with half of every range."""
    area = _new_area(spark, "halves")
    log = event_log(spark, sf_dir)
    for half in (0, 1):
        stage_log(log.where(F.col("src_event_id") % 2 == half), area, WIDTH, now=NOW)
    return _range_counts(spark, area)


def overwrite_converges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch staged twice, as a restart does."""
    area = _new_area(spark, "replayed")
    for _ in range(2):
        stage_batch(event_log(spark, sf_dir), 0, area, WIDTH, now=NOW)
    return _range_counts(spark, area)


def staged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one stream, the second after more of the log has arrived."""
    inbox, checkpoint = scratch_dir(spark, "inbox"), scratch_dir(spark, "checkpoint")
    area = _new_area(spark, "streamed")
    log = event_log(spark, sf_dir)
    for half in (0, 1):
        arrived = log.where(F.col("offset") % 100 >= 50) if half else log.where(F.col("offset") % 100 < 50)
        arrived.select(*WIRE.fieldNames()).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(WIRE).parquet(inbox)
        start(stream, area, checkpoint, WIDTH, drain=True, now=NOW).awaitTermination()
    return _range_counts(spark, area)


def published_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each object published under its exact name."""
    root = scratch_dir(spark, "objects")
    publish_objects(read_staging(spark, staged_log(spark, sf_dir)), root, WIDTH)
    name = object_name(
        F.col("topic"), F.col("part"), F.col("dt"), F.col("range_start"), F.col("range_start") + WIDTH - 1
    )
    return read_objects(spark, root).groupBy(name.alias("object_name")).agg(F.count(F.lit(1)).alias("records"))


def staged_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log staged under exact names in two deliveries, and read back."""
    area = ObjectArea(scratch_dir(spark, "object-area"))
    log = event_log(spark, sf_dir)
    for half in (0, 1):
        staging.stage_log(log.where(F.col("src_event_id") % 2 == half), area, WIDTH, now=NOW)
    return contract_columns(staging.read_staging(spark, area))


def staged_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed offsets as the manifest of the staged log has them."""
    return versions.frontier(spark, staged_log(spark, sf_dir))


def settled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range that readers see when open ranges are held back."""
    rows = read_settled(spark, staged_log(spark, sf_dir), NOW - timedelta(milliseconds=IDLE_MS))
    return rows.groupBy(*RANGE_KEYS).agg(F.count(F.lit(1)).alias("records"))


def settled_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range in an area that receives settled ranges only."""
    published = _new_area(spark, "settled")
    manifest.publish_settled(spark, staged_log(spark, sf_dir), published, NOW - timedelta(milliseconds=IDLE_MS))
    return _range_counts(spark, published)


def dirty_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to stage when half of the log was."""
    area = _new_area(spark, "half")
    log = event_log(spark, sf_dir)
    stage_log(log.where(F.col("src_event_id") % 2 == 0), area, WIDTH, now=NOW)
    return audit.dirty_ranges(log_records(spark, sf_dir), read_staging(spark, area), WIDTH)


def fenced_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and committed offsets after a writer was replaced in mid batch and then tried to finish it.

    The replaced one had written half of the log, stamped with the day before: none of it may show.
    """
    area = _new_area(spark, "fenced")
    log = event_log(spark, sf_dir)
    cut_off = versions.claim(spark, area, "first")
    half = manifest.prepare_batch(log.where("src_event_id % 2 = 0"), 0, area, WIDTH, cut_off, NOW - timedelta(days=1))
    stage_batch(log, 0, area, WIDTH, versions.claim(spark, area, "second"), NOW)
    try:
        if half:
            manifest.commit_batch(spark, area, half)
            raise AssertionError("a replaced writer finished its batch")
    except versions.Fenced:
        pass
    rows = read_staging(spark, area).groupBy("kafka_topic", "kafka_partition", "ingested_at")
    counted = rows.agg(F.count(F.lit(1)).alias("records")).withColumn("ingested_at", F.unix_micros("ingested_at"))
    return counted.join(versions.frontier(spark, area), ["kafka_topic", "kafka_partition"], "left")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range as a reader of increments has them, who looks in twice while the log is staged in
    three deliveries that overlap."""
    area, inbox, checkpoint = _new_area(spark, "fed"), scratch_dir(spark, "increments"), scratch_dir(spark, "checkpoint")
    log = event_log(spark, sf_dir)

    def look_in() -> None:
        feed = read_changes(spark, area).writeStream.option("checkpointLocation", checkpoint)
        query = feed.format("parquet").start(inbox)
        query.processAllAvailable()
        query.stop()

    stage_log(log.where("src_event_id % 2 = 0"), area, WIDTH, now=NOW)
    look_in()
    stage_log(log.where("offset % 100 < 50"), area, WIDTH, now=NOW)
    stage_log(log, area, WIDTH, now=NOW)
    look_in()
    return spark.read.parquet(inbox).groupBy(*RANGE_KEYS).agg(F.count(F.lit(1)).alias("records"))


def retiled_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges, names and commits of an area that was staged in one width and moved to another."""
    area = _new_area(spark, "retiled")
    stage_log(event_log(spark, sf_dir), area, WIDTH, now=NOW)
    manifest.retile(spark, area, 80)
    ranges = versions.state(spark, area)
    rows = read_staging(spark, area).groupBy("topic", F.col("part").alias("partition"), "range_start")
    counted = rows.agg(F.count(F.lit(1)).alias("read_back"))
    name = object_name(F.col("topic"), F.col("partition"), F.col("dt"), F.col("range_start"), F.col("range_end"))
    return ranges.join(counted, ["topic", "partition", "range_start"]).select(
        name.alias("object_name"), "records", "read_back", "last_offset", "commit_offset", "outcome"
    )


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that were published with each of three batches, one per topic, summed."""
    area = _new_area(spark, "counted")
    log, lease = event_log(spark, sf_dir), versions.claim(spark, area, "counted")
    for batch_id, topic in enumerate(("ingestion-events", "ingestion-signals", "ingestion-logs")):
        stage_batch(log.where(F.col("topic") == topic), batch_id, area, WIDTH, lease, NOW)
    names = ["records", "malformed", "uploads", "commits", "partial_uploads"]
    return versions.counters(spark, area).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def trace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged rows of some event ids, some of which no event has, found through the index."""
    area = staged_log(spark, sf_dir)
    row_index.build(spark, area)
    wanted = log_records(spark, sf_dir).where("src_event_id % 500 = 7").select("src_event_id")
    ids = wanted.select(F.concat(F.lit("rec-"), F.col("src_event_id")).alias("event_id"))
    unknown = wanted.select(F.concat(F.lit("none-"), F.col("src_event_id")).alias("event_id"))
    return row_index.trace(spark, area, ids.unionByName(unknown)).select(*PROVENANCE, "event_id")


def shredded_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field of the staged payloads, read from its own column."""
    area = ManifestArea(scratch_dir(spark, "shredded"), shredded=True)
    stage_log(event_log(spark, sf_dir), area, WIDTH, now=NOW)
    fields = manifest.read_fields(spark, area, k=("$.k", "bigint"))
    return fields.groupBy("kafka_topic").agg(F.sum("k").alias("sum_k"), F.count("k").alias("count_k"))


def held_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range that a stream let go which holds open ranges in state, and whether a range was let go
    as complete. The stream is stopped and started again between two deliveries."""
    inbox, outbox, checkpoint = (scratch_dir(spark, name) for name in ("inbox", "outbox", "checkpoint"))
    log = event_log(spark, sf_dir).select(*WIRE.fieldNames())
    log.limit(0).write.parquet(inbox)
    for half in (0, 1):
        arrived = log.where(F.col("offset") % 100 >= 50) if half else log.where(F.col("offset") % 100 < 50)
        arrived.write.mode("append").parquet(inbox)
        held = hold_open_ranges(spark.readStream.schema(WIRE).parquet(inbox), WIDTH, idle_ms=3000)
        query = held.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query = query.trigger(processingTime="200 milliseconds").start(outbox)
        _wait(spark, query, spark.read.schema(WIRE).parquet(inbox) if half else None, outbox)
    released = spark.read.schema(RELEASED).parquet(outbox).withColumn("range_start", F.col("offset") - F.col("offset") % WIDTH)
    return released.groupBy(
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), "range_start"
    ).agg(F.count_distinct("offset").alias("records"), F.max(F.col("released") == "complete").alias("is_complete"))


def _wait(spark: SparkSession, query: StreamingQuery, sent: DataFrame | None, outbox: str, seconds: int = 240) -> None:
    """Stop the query once it has read something, or, with `sent`, once all of that came out."""
    wanted = None if sent is None else sent.count()
    deadline = time.monotonic() + seconds
    while time.monotonic() < deadline and query.isActive:
        time.sleep(0.3)
        if wanted is None and any(p["numInputRows"] for p in query.recentProgress):
            break
        if wanted is not None and spark.read.schema(RELEASED).parquet(outbox).count() >= wanted:
            break
    query.stop()
    if query.exception():
        raise query.exception()


def manifest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of missing offsets as the manifest's bitmaps have them: no row is read."""
    area = staged_log(spark, sf_dir)
    return bitmaps.missing_runs(bitmaps.entry_bitmaps(versions.live_entries(spark, area, versions.head(spark, area), "offsets")))


def manifest_vs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets on one side only, of a log and of what the manifest says is staged, each short of some."""
    area = _new_area(spark, "short")
    stage_log(event_log(spark, sf_dir).where("offset % 7 <> 3"), area, WIDTH, now=NOW)
    staged = bitmaps.entry_bitmaps(versions.live_entries(spark, area, versions.head(spark, area), "offsets"))
    log = log_records(spark, sf_dir).where("kafka_offset % 11 <> 4")
    return bitmaps.differences(bitmaps.offset_bitmaps(log), staged)


QUERIES = {
    "staged_readback": staged_readback,
    "object_lookup": object_lookup,
    "object_row_order": object_row_order,
    "contract_violations": contract_violations,
    "trace_rows": trace_rows,
    "superset_merge": superset_merge,
    "overwrite_converges": overwrite_converges,
    "staged_stream": staged_stream,
    "dirty_ranges": dirty_ranges,
    "fenced_writer": fenced_writer,
    "change_feed": change_feed,
    "retiled_area": retiled_area,
    "run_counters": run_counters,
    "trace_keys": trace_keys,
    "shredded_projection": shredded_projection,
    "held_ranges": held_ranges,
    "manifest_gaps": manifest_gaps,
    "manifest_vs_log": manifest_vs_log,
    "published_objects": published_objects,
    "staged_objects": staged_objects,
    "staged_frontier": staged_frontier,
    "settled_rows": settled_rows,
    "settled_ranges": settled_ranges,
}
