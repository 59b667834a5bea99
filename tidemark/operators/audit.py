"""Checks over a log and over staged rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import object_name, width_of
from tidemark.operators.ordered import with_previous
from tidemark.operators.ranges import positions, with_range
from tidemark.schema import ENVELOPE_COLUMNS, PARTITION_KEYS, PROVENANCE, RANGE_KEYS, STAGING


def offset_gaps(rows: DataFrame, copies: bool = False) -> DataFrame:
    """Runs of offsets missing between two present ones of a partition.

    With `copies`, rows of one offset are merged before they are brought together. A log
    has none; a staging area may.
    """
    keys = rows.select(*PROVENANCE)
    if copies:
        keys = keys.distinct()
    previous = F.col("previous.kafka_offset")
    return (
        with_previous(keys, PARTITION_KEYS, "kafka_offset", ["kafka_offset"])
        .where(F.col("kafka_offset") - previous > 1)
        .select(*PARTITION_KEYS, (previous + 1).alias("gap_start"), (F.col("kafka_offset") - 1).alias("gap_end"))
        .withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1)
    )


def duplicate_offsets(staged: DataFrame) -> DataFrame:
    """Offsets staged more than once."""
    return staged.groupBy(*PROVENANCE).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def latest_rows(staged: DataFrame, version: str) -> DataFrame:
    """One row per offset, the one with the highest `version`. Copies are merged before the
    shuffle."""
    newest = F.max_by(F.struct(*staged.columns), version).alias("newest")
    return staged.groupBy(*PROVENANCE).agg(newest).select("newest.*")


def split_ranges(staged: DataFrame) -> DataFrame:
    """Ranges staged under more than one write date."""
    per_date = staged.select(*RANGE_KEYS, "range_end", "dt").distinct()
    return per_date.groupBy(*RANGE_KEYS, "range_end").agg(F.count(F.lit(1)).alias("dates")).where("dates > 1")


def overlapping_ranges(staged: DataFrame) -> DataFrame:
    """Pairs of different ranges of a partition that share an offset.

    A pure equi-join on grid cells. A range has the size class of the smallest power of
    two that is not below its width, and touches at most two cells of its class. It looks
    for partners in the cells of its own class and of each wider class its partition has,
    so what is compared is in proportion to what is found. A pair that meets in two cells
    is kept where the later of the two starts lies.
    """
    width = width_of(F.col("range_start"), F.col("range_end"))
    power = F.length(F.bin(width - 1))
    ranges = (
        staged.select(*RANGE_KEYS, "range_end")
        .distinct()
        .withColumn("size_class", F.when(width == 1, 0).otherwise(power))
    )
    # At most 64 classes exist, whatever the number of ranges.
    classes = ranges.groupBy(*PARTITION_KEYS).agg(F.collect_set("size_class").alias("classes"))

    def cells(size_class: Column) -> Column:
        scale = size_class.cast("int")
        first = F.call_function("shiftright", F.col("range_start"), scale)
        last = F.call_function("shiftright", F.col("range_end"), scale)
        return F.explode(F.sequence(first, last))

    wide = ranges.withColumn("cell", cells(F.col("size_class")))
    narrow = (
        ranges.withColumnRenamed("size_class", "own_class")
        .join(classes, PARTITION_KEYS)
        .withColumn("size_class", F.explode("classes"))
        .where("size_class >= own_class")
        .withColumn("cell", cells(F.col("size_class")))
        .drop("classes")
    )
    on = [*PARTITION_KEYS, "size_class", "cell"]
    a = narrow.select(*on, F.col("range_start").alias("s1"), F.col("range_end").alias("e1"), "own_class")
    b = wide.select(*on, F.col("range_start").alias("s2"), F.col("range_end").alias("e2"))
    later = F.greatest("s1", "s2")
    a_first = (F.col("s1") < F.col("s2")) | ((F.col("s1") == F.col("s2")) & (F.col("e1") < F.col("e2")))
    different = (F.col("s1") != F.col("s2")) | (F.col("e1") != F.col("e2"))
    pairs = (
        a.join(b, on)
        .where((F.col("s1") <= F.col("e2")) & (F.col("s2") <= F.col("e1")) & different)
        # Two ranges of one class meet from both sides; of two classes, from the narrow one.
        .where((F.col("own_class") < F.col("size_class")) | a_first)
        .where(F.call_function("shiftright", later, F.col("size_class").cast("int")) == F.col("cell"))
    )
    return pairs.select(
        *PARTITION_KEYS,
        F.when(a_first, F.col("s1")).otherwise(F.col("s2")).alias("a_start"),
        F.when(a_first, F.col("e1")).otherwise(F.col("e2")).alias("a_end"),
        F.when(a_first, F.col("s2")).otherwise(F.col("s1")).alias("b_start"),
        F.when(a_first, F.col("e2")).otherwise(F.col("e1")).alias("b_end"),
    )


def presence(log: DataFrame, staged: DataFrame) -> DataFrame:
    """Every offset of either side, with `in_log` and `in_staging`.

    One tagged union and one aggregate: each side is shuffled once, and copies of an
    offset are merged before it.
    """
    left = log.select(*PROVENANCE, F.lit(True).alias("in_log"), F.lit(False).alias("in_staging"))
    right = staged.select(*PROVENANCE, F.lit(False).alias("in_log"), F.lit(True).alias("in_staging"))
    return (
        left.unionByName(right)
        .groupBy(*PROVENANCE)
        .agg(F.max("in_log").alias("in_log"), F.max("in_staging").alias("in_staging"))
    )


def log_vs_staging(log: DataFrame, staged: DataFrame) -> DataFrame:
    """Offsets on one side only."""
    return (
        presence(log, staged)
        .where("in_log != in_staging")
        .select(*PROVENANCE, F.when(F.col("in_log"), "log_only").otherwise("staging_only").alias("side"))
    )


def unsafe_commits(log: DataFrame, staged: DataFrame, frontier: DataFrame) -> DataFrame:
    """Offsets of the log below the committed offset that were never staged."""
    committed = positions(frontier.where("commit_offset IS NOT NULL"))
    missing = presence(log, staged).where("in_log AND NOT in_staging").select(*PROVENANCE)
    return missing.join(committed, PARTITION_KEYS).where("kafka_offset < commit_offset").select(*PROVENANCE)


def dirty_ranges(log: DataFrame, staged: DataFrame, width: int) -> DataFrame:
    """Ranges with log rows that staging does not hold."""
    missing = presence(log, staged).where("in_log AND NOT in_staging")
    return with_range(missing, width).select(*RANGE_KEYS).distinct()


def contract_violations(staged: DataFrame) -> DataFrame:
    """How many rows break each null rule of the contract: one aggregate over the rows."""
    checks = {f"null_{c.name}": F.col(c.name).isNull() for c in STAGING.fields if not c.nullable}
    envelope = [F.col(c).isNotNull() for c in ENVELOPE_COLUMNS]
    any_set = envelope[0]
    for column in envelope[1:]:
        any_set = any_set | column
    complete = F.col("event_id").isNotNull() & F.col("gateway_id").isNotNull()
    complete = complete & F.col("retry_count").isNotNull() & F.col("payload").isNotNull()
    checks["envelope_on_malformed"] = F.col("malformed") & any_set
    checks["reason_on_parsed"] = ~F.col("malformed") & F.col("malformed_reason").isNotNull()
    checks["no_reason_on_malformed"] = F.col("malformed") & F.col("malformed_reason").isNull()
    checks["incomplete_envelope_on_parsed"] = ~F.col("malformed") & ~complete
    counted = staged.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return counted.unpivot([], list(checks), "check_name", "violations")


def received_at_nulls(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where("NOT malformed AND received_at IS NULL")
        .groupBy("kafka_topic")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def auth_mix(parsed: DataFrame) -> DataFrame:
    """Authenticated traffic carries a header; API-key traffic does not."""
    return (
        parsed.where("NOT malformed")
        .groupBy("kafka_topic", F.col("event_header").isNotNull().alias("has_header"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def lateness_by_write_date(parsed: DataFrame, write_date: str) -> DataFrame:
    """Rows per event date that precedes the date they were written under. There is no
    lateness cut: late rows are staged under the write date."""
    event_date = F.date_format("received_at", "yyyy-MM-dd")
    return (
        parsed.where(F.col("received_at") < F.lit(write_date).cast("timestamp"))
        .groupBy(event_date.alias("event_date"))
        .agg(F.count(F.lit(1)).alias("late_rows"))
    )


def trace_rows(staged: DataFrame, log: DataFrame, *columns: str) -> DataFrame:
    """Staged rows with `columns` of the message each came from."""
    origin = log.select(*PROVENANCE, *columns)
    return staged.join(origin, PROVENANCE)


def object_row_order(staged_with_files: DataFrame) -> DataFrame:
    """Whether each staged range holds its rows in offset order.

    Needs the `file_path` and `row_index` a file scan offers. One window per range of a file.
    """
    in_file = W.partitionBy("file_path", "topic", "part", "range_start").orderBy("row_index")
    in_order = F.col("kafka_offset") > F.lag("kafka_offset").over(in_file)
    name = object_name(F.col("topic"), F.col("part"), F.col("dt"), F.col("range_start"), F.col("range_end"))
    return (
        staged_with_files.withColumn("in_order", F.coalesce(in_order, F.lit(True)))
        .groupBy("file_path", name.alias("object_name"))
        .agg(F.min("in_order").alias("is_sorted"))
        .select("object_name", "is_sorted")
    )
