"""Ranges of a log: which exist, how far they got, and what may be committed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import commit_offset, is_complete, object_name, range_end, range_start, width_of
from tidemark.operators.ordered import with_previous
from tidemark.schema import PARTITION_KEYS, RANGE_KEYS


def with_range(records: DataFrame, width: int) -> DataFrame:
    start = range_start(F.col("kafka_offset"), width)
    return records.withColumn("range_start", start).withColumn("range_end", range_end(F.col("range_start"), width))


def range_summary(records: DataFrame, width: int, *extra: Column) -> DataFrame:
    """Rows and last offset of every range. Counted before the shuffle, so that one row
    per range and task moves, whatever the partition's share of the log is."""
    start = range_start(F.col("kafka_offset"), width).alias("range_start")
    summary = records.groupBy(*PARTITION_KEYS, start).agg(
        F.count(F.lit(1)).alias("records"), F.max("kafka_offset").alias("last_offset"), *extra
    )
    end = range_end(F.col("range_start"), width)
    extras = [c for c in summary.columns if c not in {*RANGE_KEYS, "records", "last_offset"}]
    return summary.select(*RANGE_KEYS, end.alias("range_end"), "records", "last_offset", *extras)


def with_outcome(summary: DataFrame) -> DataFrame:
    """Add `is_complete` and `outcome` to one row per range.

    A range is `committed` once its last offset was seen, `abandoned` if the partition
    moved on to a later range without it, else `open`. Completeness is about offsets and
    not rows, since offsets may have holes.
    """
    # The newest range of a partition, as a whole row: both sides of the join then need
    # the same aggregate of the log and share its exchange, so the log is read once.
    whole = F.struct(*summary.columns)
    newest = summary.groupBy(*PARTITION_KEYS).agg(F.max_by(whole, "range_start").alias("newest"))
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    outcome = (
        F.when(complete, "committed")
        .when(F.col("newest.range_start") > F.col("range_start"), "abandoned")
        .otherwise("open")
    )
    return (
        summary.join(newest, PARTITION_KEYS)
        .withColumn("is_complete", complete)
        .withColumn("outcome", outcome)
        .drop("newest")
    )


def range_status(records: DataFrame, width: int) -> DataFrame:
    status = with_outcome(range_summary(records, width))
    return status.withColumn("width", width_of(F.col("range_start"), F.col("range_end")))


def commit_ledger(summary: DataFrame) -> DataFrame:
    """Complete ranges with the offset each allows to commit."""
    return summary.where(is_complete(F.col("last_offset"), F.col("range_end"))).select(
        *RANGE_KEYS, "range_end", commit_offset(F.col("range_end")).alias("commit_offset")
    )


def commit_frontier(summary: DataFrame) -> DataFrame:
    """Committed offset of each partition: one past its highest complete range.

    `abandoned` and `open_ranges` need no second look at the log: the only range that can
    be open is the newest one.
    """
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    totals = summary.groupBy(*PARTITION_KEYS).agg(
        F.max(F.when(complete, commit_offset(F.col("range_end")))).alias("commit_offset"),
        F.count_if(complete).alias("committed"),
        F.count_if(~complete).alias("unfinished"),
        F.max("range_start").alias("newest_start"),
        F.max(F.when(~complete, F.col("range_start"))).alias("newest_unfinished"),
    )
    still_open = F.coalesce(F.col("newest_unfinished") == F.col("newest_start"), F.lit(False)).cast("bigint")
    return totals.select(
        *PARTITION_KEYS,
        "commit_offset",
        "committed",
        (F.col("unfinished") - still_open).alias("abandoned"),
        still_open.alias("open_ranges"),
    )


def open_ranges(summary: DataFrame) -> DataFrame:
    """Partitions per topic whose newest range is unfinished."""
    return commit_frontier(summary).groupBy("kafka_topic").agg(F.sum("open_ranges").alias("open_partitions"))


# Rows of a frontier that are sent to every task, about 40 bytes each.
FRONTIER_ROWS = 200_000


def positions(frontier: DataFrame) -> DataFrame:
    """The frontier, sent to every task if it is as small as brokers make it.

    It is worked out once: up to `FRONTIER_ROWS` rows come back and go out again. A join that deals
    rows by (topic, partition) would put a hot partition into one task.
    """
    position = frontier.select(*PARTITION_KEYS, "commit_offset")
    few = position.limit(FRONTIER_ROWS + 1).collect()
    if len(few) > FRONTIER_ROWS:
        return position
    return F.broadcast(frontier.sparkSession.createDataFrame(few, position.schema))


def replay_from_frontier(records: DataFrame, frontier: DataFrame) -> DataFrame:
    """Records a restart reads again: from the committed offset, or all where there is none."""
    return (
        records.join(positions(frontier), PARTITION_KEYS, "left")
        .where(F.col("kafka_offset") >= F.coalesce("commit_offset", F.lit(0)))
        .drop("commit_offset")
    )


def consumer_lag(records: DataFrame, width: int) -> DataFrame:
    """Offsets between the end of each partition and its committed offset.

    The last offset of a partition comes from the range summary, so one aggregate of the
    log answers both.
    """
    summary = range_summary(records, width)
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    return (
        summary.groupBy(*PARTITION_KEYS)
        .agg(
            (F.max("last_offset") + 1).alias("head"),
            F.coalesce(F.max(F.when(complete, commit_offset(F.col("range_end")))), F.lit(0)).alias("frontier"),
        )
        .withColumn("lag", F.col("head") - F.col("frontier"))
    )


def range_tiling(summary: DataFrame, width: int) -> DataFrame:
    """Each range with the end of the one before it, and whether the two are adjacent."""
    block = width * 4096
    ranges = summary.select(*RANGE_KEYS, "range_end")
    return with_previous(ranges, PARTITION_KEYS, "range_start", ["range_end"], block).select(
        *RANGE_KEYS,
        "range_end",
        F.col("previous.range_end").alias("previous_end"),
        (F.col("previous.range_end") + 1 == F.col("range_start")).alias("is_adjacent"),
    )


def object_names(summary: DataFrame, date: str) -> DataFrame:
    name = object_name(
        F.col("kafka_topic"), F.col("kafka_partition"), F.lit(date), F.col("range_start"), F.col("range_end")
    )
    return summary.select(*RANGE_KEYS, name.alias("object_name"))


def ingest_stats(parsed: DataFrame, width: int) -> DataFrame:
    """Run counters, with one upload per range."""
    summary = range_summary(parsed, width, F.count_if("malformed").alias("malformed"))
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    return summary.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"),
        F.count(F.lit(1)).alias("uploads"),
        F.count_if(complete).alias("commits"),
        F.count_if(~complete).alias("partial_uploads"),
    )


def _arrivals(records: DataFrame, width: int, clock: str, idle_ms: int) -> DataFrame:
    """Records with the quiet time after each inside its range, and whether an idle flush
    falls there. The window is one range, so never more than `width` offsets."""
    in_range = W.partitionBy(*RANGE_KEYS).orderBy("kafka_offset")
    quiet_us = F.unix_micros(F.lead(clock).over(in_range)) - F.unix_micros(clock)
    return (
        with_range(records, width)
        .select(*RANGE_KEYS, "range_end", "kafka_offset", clock)
        .withColumn("is_last", F.lead("kafka_offset").over(in_range).isNull())
        .withColumn("is_idle", F.coalesce(quiet_us >= F.lit(idle_ms).cast("bigint") * 1000, F.lit(False)))
    )


def idle_flush_points(records: DataFrame, width: int, clock: str, idle_ms: int) -> DataFrame:
    """Where a range went quiet for `idle_ms` and was published unfinished."""
    return (
        _arrivals(records, width, clock, idle_ms)
        .where("is_idle")
        .select(*RANGE_KEYS, F.col("kafka_offset").alias("through_offset"))
    )


def upload_history(records: DataFrame, width: int, clock: str, idle_ms: int) -> DataFrame:
    """Every publication of every range: at each idle flush and at its end. Each holds all
    rows of the one before."""
    in_range = W.partitionBy(*RANGE_KEYS).orderBy("kafka_offset")
    so_far = in_range.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        _arrivals(records, width, clock, idle_ms)
        .withColumn("upload_rows", F.count(F.lit(1)).over(so_far))
        .where("is_idle OR is_last")
        .withColumn("upload", F.row_number().over(in_range))
        .select(*RANGE_KEYS, "upload", "upload_rows")
    )
