"""Ranges published only once they are complete or quiet.

The stream stages into an area of its own, where every row is durable as soon as its batch
ends. From there, settled ranges are copied whole into the area that readers see. What is
held back lives in files, so that nothing is lost with an executor or a driver.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import range_end
from tidemark.schema import LAYOUT_COLUMNS, STAGED
from tidemark.sinks import ledger
from tidemark.sinks.area import StagingArea, children, delete
from tidemark.sinks.ownership import held
from tidemark.sinks.staging import publish_ranges, read_ranges


def unpublished_ranges(
    spark: SparkSession, staged: StagingArea, published: StagingArea, quiet_since: datetime
) -> DataFrame:
    """Settled ranges of which `published` lacks rows, as rows of the ledger of `staged`."""
    keys = ["topic", "partition", "range_start"]
    settled = (F.col("outcome") != "open") | (F.col("written_at") <= F.lit(quiet_since))
    held = ledger.ledger_state(spark, staged).where(settled)
    known = ledger.ledger_state(spark, published).select(*keys, F.col("records").alias("published_records"))
    return (
        held.join(known, keys, "left")
        .where(F.coalesce("published_records", F.lit(0)) < F.col("records"))
        .drop("published_records")
    )


def publish_settled(
    spark: SparkSession, staged: StagingArea, published: StagingArea, width: int, quiet_since: datetime
) -> bool:
    """Copy what settled since the last call, and say whether there was anything.

    Each range is replaced whole, so a repeated call converges. Only then does the ledger of
    `published` name it.
    """
    ledger.check_same_width(spark, staged, width)
    ledger.check_same_width(spark, published, width)
    with held(spark, published, "settled"):
        return _publish_settled(spark, staged, published, width, quiet_since)


def _publish_settled(
    spark: SparkSession, staged: StagingArea, published: StagingArea, width: int, quiet_since: datetime
) -> bool:
    batch_id = ledger.last_batch_id(spark, published) + 1
    ranges = unpublished_ranges(spark, staged, published, quiet_since).withColumn(
        "batch_id", F.lit(batch_id).cast("bigint")
    )
    # The list of ranges is written down: the copy and the ledger must speak of the same.
    name = f"settled-{batch_id:015d}"
    for old in children(spark, published.intents):
        if old.startswith("settled-"):
            delete(spark, f"{published.intents}/{old}")
    path = f"{published.intents}/{name}"
    ranges.write.mode("overwrite").parquet(path)
    chosen = spark.read.schema(ledger.LEDGER_FILE).parquet(path)
    if chosen.isEmpty():
        return False
    wanted = chosen.withColumnRenamed("partition", "part")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        read_ranges(spark, staged, wanted)
        .withColumn("range_end", range_end(F.col("range_start"), width))
        .repartition(tasks, "topic", "part", "range_start")
        .sortWithinPartitions(*LAYOUT_COLUMNS, "kafka_offset")
    )
    publish_ranges(rows.select(*STAGED.fieldNames(), "range_end"), published)
    ledger.record_batch(chosen, published, name)
    ledger.compact_if_long(spark, published)
    return True
