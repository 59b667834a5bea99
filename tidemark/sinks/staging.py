"""Staging a batch of log messages so that a replay at any point converges.

A batch goes through four durable steps, in this order:

1. intent: the ranges it touches, the date each is filed under, and the instant of the
   write. A replay reuses them, so it writes to the same places even after midnight.
2. carry: the rows that re-touched ranges already hold, copied aside. Replacing folders is
   not atomic, and these rows come from earlier batches which a replay does not bring back.
3. data: carried and new rows, one row per offset, one file per range, replacing exactly the
   folders of the ranges that gained rows.
4. ledger: what the ranges now hold, read back from storage. Only a complete range gets a
   commit offset.

A failure before step 4 leaves the ledger as it was.

A batch is known by its content as well as by its writer and number: its name ends in a
fingerprint of the offsets that arrived. Only a batch of the same content is a replay. Another one
under an old number, after a lost checkpoint or on a log that has grown, is a batch of its
own; what an unfinished batch had carried is put back before it begins.
"""

import time
from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import check_width, range_end, range_start, utc_date
from tidemark.operators.records import now_utc, parse_envelope, records_of, staging_rows
from tidemark.schema import LAYOUT_COLUMNS, PROVENANCE, STAGED, STAGING
from tidemark.session import configure
from tidemark.sinks import ledger
from tidemark.sinks.area import ObjectArea, StagingArea, children, delete, exists, is_written
from tidemark.sinks.objects import put_objects, read_named, read_objects
from tidemark.sinks.ownership import held

# Rows, those held before included, that one task merges and writes. The session may ask for more tasks.
ROWS_PER_TASK = 250_000

RANGE = ["topic", "part", "range_start"]

Publish = Callable[[DataFrame, StagingArea], None]


def publish_ranges(rows: DataFrame, area: StagingArea) -> None:
    """Replace the ranges in `rows`, and no others."""
    if isinstance(area, ObjectArea):
        put_objects(rows, area.data)
        return
    (
        rows.select(*STAGED.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*LAYOUT_COLUMNS)
        .parquet(area.data)
    )


def read_staging(spark: SparkSession, area: StagingArea, *paths: str) -> DataFrame:
    """Staged rows with their layout columns. Filters on those prune folders."""
    configure(spark)
    if isinstance(area, ObjectArea):
        return read_objects(spark, area.data, *paths)
    return spark.read.schema(STAGED).option("basePath", area.data).parquet(*(paths or (area.data,)))


def read_day(spark: SparkSession, area: StagingArea, topic: str, date: str) -> DataFrame:
    """Staged rows of one topic and write date, listing only its folder."""
    path = area.day_path(topic, date)
    return read_staging(spark, area, path) if exists(spark, path) else spark.createDataFrame([], STAGED)


def _path_of(area: StagingArea, object_name: str) -> str:
    topic, date, file_name = object_name.split("/")
    part, start, end = file_name.removesuffix(".parquet").split("-")
    return area.range_path(topic, date.removeprefix("dt="), int(part), int(start), int(end))


def read_object(spark: SparkSession, area: StagingArea, object_name: str) -> DataFrame:
    """The rows of one object, found by its name without listing anything else."""
    path = _path_of(area, object_name)
    return read_staging(spark, area, path) if exists(spark, path) else spark.createDataFrame([], STAGED)


def wait_for_object(spark: SparkSession, area: StagingArea, object_name: str, seconds: float) -> bool:
    """Whether the object is there, within `seconds`."""
    deadline = time.monotonic() + seconds
    while not exists(spark, _path_of(area, object_name)):
        if time.monotonic() >= deadline:
            return False
        time.sleep(0.2)
    return True


def read_ranges(spark: SparkSession, area: StagingArea, ranges: DataFrame) -> DataFrame:
    """Staged rows of the given ranges (layout columns and `range_end`), listing only their
    topics and dates.

    The ranges are joined on the layout columns. Where Spark may broadcast them it prunes the
    folders of a `StagingArea` by them before it reads; the filter marks them as selective.
    Objects are skipped by the offsets in their footers.
    """
    bounds = F.min("range_start").alias("first"), F.max("range_end").alias("last")
    days = ranges.groupBy("topic", "dt").agg(*bounds).collect()
    if not days:
        return spark.createDataFrame([], STAGED)
    rows = read_staging(spark, area, *[area.day_path(row["topic"], row["dt"]) for row in days])
    near = rows.where(F.col("kafka_offset").between(min(r["first"] for r in days), max(r["last"] for r in days)))
    return near.join(ranges.select(*LAYOUT_COLUMNS).where("range_start >= 0"), LAYOUT_COLUMNS, "left_semi")


def read_batch(spark: SparkSession, area: StagingArea, ranges: DataFrame, *columns: str) -> DataFrame:
    """`read_ranges` for the many ranges of a batch, all columns or those named: objects are opened by their names."""
    if isinstance(area, ObjectArea):
        return read_named(ranges, area.data, list(columns or STAGED.fieldNames()), ranges.count())
    found = read_ranges(spark, area, ranges)
    return found.select(*columns) if columns else found


def read_settled(spark: SparkSession, area: StagingArea, quiet_since: datetime) -> DataFrame:
    """Staged rows without fresh partial ranges.

    A range is settled once it is complete, or was passed by, or has gained nothing since
    `quiet_since`. The ledger answers that, so no folder of an unsettled range is read.
    """
    settled = (F.col("outcome") != "open") | (F.col("written_at") <= F.lit(quiet_since))
    ranges = ledger.ledger_state(spark, area).where(settled).withColumnRenamed("partition", "part")
    return read_ranges(spark, area, ranges)


def touched_ranges(wire: DataFrame, width: int) -> DataFrame:
    """A row per range with what of it arrived."""
    return (
        records_of(wire)
        .groupBy(
            F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").alias("partition"),
            range_start(F.col("kafka_offset"), width).alias("range_start"),
        )
        .agg(
            F.count(F.lit(1)).alias("arrived"),
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
            F.bit_xor(F.xxhash64("kafka_offset")).alias("offsets"),
        )
    )


def _fingerprint(touched: DataFrame) -> str | None:
    """What tells batches of other offsets apart; nothing for an empty batch."""
    row = F.xxhash64(*touched.columns).cast("decimal(38,0)")
    total = touched.agg(F.sum(row).alias("total"), F.count(F.lit(1)).alias("ranges")).first()
    return f"{int(total['total']) % (1 << 64):016x}" if total["ranges"] else None


def _restore(spark: SparkSession, area: StagingArea, name: str, width: int, publish: Publish) -> None:
    """Put back what other batches, which never reached the ledger, carried aside.

    The carried rows are all that the ledger knows of their ranges. New rows of such a batch
    were never committed, so the log still has them.
    """
    for other in children(spark, area.carried):
        path = f"{area.carried}/{other}"
        if other == name or not is_written(spark, path):
            continue
        carried = spark.read.schema(STAGED).parquet(path)
        if not carried.isEmpty():
            publish(merged(carried, None, width, carried.count()), area)
        delete(spark, path)


def _intent(touched: DataFrame, area: StagingArea, name: str, width: int, now: datetime | None) -> DataFrame:
    spark = touched.sparkSession
    path = f"{area.intents}/{name}"
    if not is_written(spark, path):
        written_at = F.lit(now or now_utc()).cast("timestamp")
        keys = ["topic", "partition", "range_start"]
        touched = touched.drop("last_offset", "offsets")
        if children(spark, area.snapshots) or children(spark, area.batches):
            touched = touched.join(ledger.staged_dates(spark, area, touched), keys, "left")
        else:
            touched = touched.select(
                "*", F.lit(None).cast("string").alias("dt"), F.lit(None).cast("bigint").alias("staged_through")
            )
        (
            touched.select(
                "topic",
                F.coalesce("dt", utc_date(written_at)).alias("dt"),
                F.col("partition").alias("part"),
                "range_start",
                range_end(F.col("range_start"), width).alias("range_end"),
                "arrived",
                F.col("dt").isNotNull().alias("was_staged"),
                utc_date(written_at).alias("write_date"),
                written_at.alias("written_at"),
            )
            .write.mode("overwrite")
            .parquet(path)
        )
    return spark.read.parquet(path)


def _totals(intent: DataFrame) -> Row:
    """What the driver needs to know of a batch, in one row whatever the number of ranges."""
    return intent.agg(
        F.sum("arrived").alias("arrived"),
        F.max("was_staged").alias("was_staged"),
        F.max("write_date").alias("write_date"),
        F.max("written_at").alias("written_at"),
    ).first()


def _carried(intent: DataFrame, area: StagingArea, name: str) -> DataFrame:
    """A copy of what re-touched ranges hold."""
    spark = intent.sparkSession
    path = f"{area.carried}/{name}"
    if not is_written(spark, path):
        read_batch(spark, area, intent.where("was_staged")).write.mode("overwrite").parquet(path)
    return spark.read.schema(STAGED).parquet(path)


def placed(rows: DataFrame, width: int, write_date: str) -> DataFrame:
    """Rows with their layout columns, as of ranges that were not staged before."""
    return rows.select(
        "*",
        F.col("kafka_topic").alias("topic"),
        F.lit(write_date).alias("dt"),
        F.col("kafka_partition").alias("part"),
        range_start(F.col("kafka_offset"), width).alias("range_start"),
    )


def merged(
    incoming: DataFrame,
    carried: DataFrame | None,
    width: int,
    count: int,
    *extra: str,
    counted: Observation | None = None,
) -> DataFrame:
    """One row per offset, carried rows first, in offset order within each range; `extra` columns pass through.

    With carried rows, only ranges that get an offset they do not hold, under the date they have. Carried rows
    may be there more than once, and of other ranges too. `counted` receives the `records` and `malformed` that
    arrived for the ranges returned.

    One shuffle brings a range together; its sort serves the choice of rows and, for new ranges, the order
    inside the file and the writer, which keeps one file open at a time. No table of ranges or of keys is
    joined, so none is sent to the tasks or collected. Coalescing by size would leave a batch of many
    small files to one task, so the number of tasks is given, by the `count` of all rows.
    """
    tasks = int(incoming.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, -(-count // ROWS_PER_TASK))
    columns = [*STAGED.fieldNames(), *extra]
    rows = incoming.select(*columns, F.lit(1).alias("__rank"))
    if carried is not None:
        rows = rows.unionByName(carried.select(*columns, F.lit(0).alias("__rank")))
    rows = rows.withColumn("range_end", range_end(F.col("range_start"), width))
    # Of copies that arrive together the earliest stays; content decides between equal times.
    content = [c for c in STAGING.fieldNames() if c not in (*PROVENANCE, "kafka_timestamp", "ingested_at")]
    # Not by `dt`, which the range decides: as a constant it would be folded out of the
    # window's keys, and the shuffle would no longer match them.
    together = rows.repartition(tasks, *RANGE)
    keys = LAYOUT_COLUMNS if carried is None else RANGE
    one_offset = W.partitionBy(*keys, "kafka_offset").orderBy("__rank", "kafka_timestamp", *content)
    numbered = together.withColumn("__nth", F.row_number().over(one_offset))
    arrived = F.col("__rank") == 1
    if carried is not None:
        one_range = W.partitionBy(*RANGE)
        numbered = numbered.withColumns(
            {
                "__gains": F.max(arrived & (F.col("__nth") == 1)).over(one_range),
                "__pinned": F.min(F.when(~arrived, F.col("dt"))).over(one_range),
            }
        ).where("__gains")
        numbered = numbered.withColumn("dt", F.coalesce("__pinned", "dt"))
    if counted is not None:
        malformed = F.count_if(arrived & F.col("malformed"))
        numbered = numbered.observe(counted, F.count_if(arrived).alias("records"), malformed.alias("malformed"))
    chosen = numbered.where("__nth = 1")
    return chosen.select(*columns, "range_end").sortWithinPartitions(*LAYOUT_COLUMNS, "kafka_offset")


def _ledger_rows(intent: DataFrame, area: StagingArea, width: int, batch_id: int) -> DataFrame:
    staged = read_batch(intent.sparkSession, area, intent, *LAYOUT_COLUMNS, "kafka_offset", "malformed", "ingested_at")
    held = staged.groupBy("topic", F.col("part").alias("partition"), "range_start", "dt").agg(
        F.count(F.lit(1)).alias("records"),
        F.max("kafka_offset").alias("last_offset"),
        F.count_if("malformed").alias("malformed"),
        F.max("ingested_at").alias("written_at"),
    )
    end = range_end(F.col("range_start"), width)
    return ledger.with_ledger_outcome(
        held.withColumn("range_end", end).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    )


def stage_batch(
    wire: DataFrame,
    batch_id: int,
    area: StagingArea,
    width: int,
    writer: str = "batch",
    now: datetime | None = None,
    publish: Publish = publish_ranges,
    keep: bool = False,
    counters: Observation | None = None,
) -> bool:
    """Stage the messages of `wire` as batch `batch_id` of `writer`, if there are any.

    `counters` receives the batch's `records` and `malformed` as they are written.

    `keep` holds the raw messages on the executors while the batch runs, for a source that
    is costly to read twice. Fails while another writer, or call, is staging into the area.
    """
    check_width(width)
    spark = configure(wire.sparkSession)
    ledger.check_same_width(spark, area, width)
    if keep:
        wire = wire.persist(StorageLevel.MEMORY_AND_DISK)
    touched = touched_ranges(wire, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with held(spark, area, writer):
            fingerprint = _fingerprint(touched)
            if fingerprint is None:
                return False
            name = ledger.batch_name(writer, batch_id, fingerprint)
            _restore(spark, area, name, width, publish)
            # The batch before is settled once this one is asked for.
            for old in children(spark, area.intents):
                if old != name:
                    delete(spark, f"{area.intents}/{old}")
            intent = _intent(touched, area, name, width, now)
            batch = _totals(intent)
            carried = _carried(intent, area, name) if batch["was_staged"] else None
            rows = staging_rows(parse_envelope(records_of(wire)), F.lit(batch["written_at"]))
            if counters is not None:
                rows = rows.observe(
                    counters, F.count(F.lit(1)).alias("records"), F.count_if("malformed").alias("malformed")
                )
            incoming = placed(rows, width, batch["write_date"])
            count = batch["arrived"] + (carried.count() if carried is not None else 0)
            publish(merged(incoming, carried, width, count), area)
            ledger.record_batch(_ledger_rows(intent, area, width, batch_id), area, name)
            delete(spark, f"{area.carried}/{name}")
            ledger.compact_if_long(spark, area)
            return True
    finally:
        touched.unpersist()
        if keep:
            wire.unpersist()


def stage_log(
    wire: DataFrame, area: StagingArea, width: int, now: datetime | None = None, batch_id: int | None = None
) -> None:
    """Stage a bounded log. Run it again and nothing changes."""
    spark = configure(wire.sparkSession)
    if batch_id is None:
        batch_id = ledger.last_batch_id(spark, area) + 1
    stage_batch(wire, batch_id, area, width, now=now)


__all__ = [
    "Publish",
    "publish_ranges",
    "read_day",
    "read_object",
    "read_ranges",
    "read_settled",
    "read_staging",
    "stage_batch",
    "stage_log",
    "wait_for_object",
]
