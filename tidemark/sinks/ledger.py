"""The commit ledger: what each batch left in staging, and what that allows to commit.

One small folder per batch, overwritten if the batch is replayed. A range only ever gains
rows, so its state is a maximum over its rows in the ledger: neither the order of batches
nor a row counted twice can change it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import commit_offset, is_complete
from tidemark.operators.ranges import with_outcome
from tidemark.schema import LEDGER, PARTITION_KEYS, RANGE_KEYS
from tidemark.sinks.area import StagingArea, children, delete, is_written, make_folder

LEDGER_FILE = T.StructType(
    [
        *LEDGER.fields,
        T.StructField("malformed", T.LongType()),
        # When the newest row of the range was staged.
        T.StructField("written_at", T.TimestampType()),
    ]
)
COMPACT_AFTER = 100


def batch_name(writer: str, batch_id: int, fingerprint: str) -> str:
    return f"{writer}-{batch_id:015d}-{fingerprint}"


def ledger_rows(spark: SparkSession, area: StagingArea) -> DataFrame:
    folders = [f"{area.snapshots}/{n}" for n in children(spark, area.snapshots)]
    folders += [f"{area.batches}/{n}" for n in children(spark, area.batches)]
    paths = [path for path in folders if is_written(spark, path)]
    if not paths:
        return spark.createDataFrame([], LEDGER_FILE)
    return spark.read.schema(LEDGER_FILE).parquet(*paths)


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic", "partition", "range_start", "range_end").agg(
        # The date of a range is pinned by its first write.
        F.min("dt").alias("dt"),
        F.max("records").alias("records"),
        F.max("last_offset").alias("last_offset"),
        F.max("malformed").alias("malformed"),
        F.max("batch_id").alias("batch_id"),
        F.max("written_at").alias("written_at"),
    )


def with_ledger_outcome(latest: DataFrame) -> DataFrame:
    named = latest.withColumnsRenamed({"topic": "kafka_topic", "partition": "kafka_partition"})
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    return (
        with_outcome(named)
        .withColumn("commit_offset", F.when(complete, commit_offset(F.col("range_end"))))
        .withColumnsRenamed({"kafka_topic": "topic", "kafka_partition": "partition"})
        .select(*LEDGER_FILE.fieldNames())
    )


def ledger_state(spark: SparkSession, area: StagingArea) -> DataFrame:
    """One row per staged range, as of now."""
    return with_ledger_outcome(_latest(ledger_rows(spark, area)))


def staged_dates(spark: SparkSession, area: StagingArea, touched: DataFrame) -> DataFrame:
    """The pinned date and the last staged offset of those touched ranges that were staged
    before. The bounds of what is touched skip the older parts of the ledger's snapshot."""
    keys = ["topic", "partition", "range_start"]
    bounds = touched.agg(F.min("range_start").alias("first"), F.max("range_start").alias("last")).first()
    near = F.col("range_start").between(bounds["first"], bounds["last"])
    rows = ledger_rows(spark, area).where(near).select(*keys, "dt", "last_offset")
    return (
        rows.join(touched.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min("dt").alias("dt"), F.max("last_offset").alias("staged_through"))
    )


def staged_ranges(spark: SparkSession, area: StagingArea) -> DataFrame:
    """The ranges of the area and their dates, for audits that need no rows."""
    names = {"topic": "kafka_topic", "partition": "kafka_partition"}
    return ledger_rows(spark, area).withColumnsRenamed(names).select(*RANGE_KEYS, "range_end", "dt").distinct()


def frontier(spark: SparkSession, area: StagingArea) -> DataFrame:
    """The committed offset of each partition: the next offset to read."""
    return (
        ledger_rows(spark, area)
        .groupBy(F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"))
        .agg(F.max("commit_offset").alias("commit_offset"))
        .where("commit_offset IS NOT NULL")
        .select(*PARTITION_KEYS, "commit_offset")
    )


def record_batch(rows: DataFrame, area: StagingArea, name: str) -> None:
    rows.select(*LEDGER_FILE.fieldNames()).write.mode("overwrite").parquet(f"{area.batches}/{name}")


def last_batch_id(spark: SparkSession, area: StagingArea) -> int:
    row = ledger_rows(spark, area).select(F.max("batch_id").alias("latest")).first()
    return -1 if row is None or row["latest"] is None else row["latest"]


def check_same_width(spark: SparkSession, area: StagingArea, width: int) -> None:
    """Refuse a width other than the one the area was first staged with: ranges would overlap.

    The width is kept as the name of an empty folder; an area without one asks its ledger.
    """
    known = children(spark, area.widths)
    if not known:
        span = F.col("range_end") - F.col("range_start") + 1
        staged = ledger_rows(spark, area).select(F.max(span).alias("width")).first()["width"]
        make_folder(spark, f"{area.widths}/{staged or width}")
        known = children(spark, area.widths)
    if known != [str(width)]:
        raise ValueError(f"staging area {area.root} has ranges of {', '.join(known)} offsets, not {width}")


def compact(spark: SparkSession, area: StagingArea) -> None:
    """Fold all batches into one snapshot with a row per range.

    Old folders go only after the snapshot is whole. If that is interrupted, rows are
    present twice, which the state does not notice.
    """
    old = [f"{area.snapshots}/{n}" for n in children(spark, area.snapshots)]
    batches = [f"{area.batches}/{n}" for n in children(spark, area.batches)]
    newest = max((int(path.rsplit("/", 1)[1]) for path in old), default=-1)
    target = f"{area.snapshots}/{newest + 1:015d}"
    state = ledger_state(spark, area).repartitionByRange("topic", "partition", "range_start")
    state.sortWithinPartitions("topic", "partition", "range_start").write.mode("overwrite").parquet(target)
    for path in old + batches:
        delete(spark, path)


def compact_if_long(spark: SparkSession, area: StagingArea, after: int = COMPACT_AFTER) -> None:
    if len(children(spark, area.batches)) >= after:
        compact(spark, area)


def ledger_stats(spark: SparkSession, area: StagingArea) -> DataFrame:
    """Counters over everything staged, without reading it."""
    state = ledger_state(spark, area)
    committed = F.col("outcome") == "committed"
    return state.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"),
        F.count(F.lit(1)).alias("ranges"),
        F.count_if(committed).alias("commits"),
        F.count_if(~committed).alias("partial_ranges"),
    )
