"""The log as a Kafka source, and the position a restart begins at.

Needs the Spark Kafka connector on the classpath.
"""

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.schema import TOPICS, WIRE

EARLIEST = -2


def log_options(
    servers: str,
    topics: Sequence[str] = TOPICS,
    starting_offsets: str = "earliest",
    tasks: int | None = None,
    per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the source. `tasks` is a minimum: a partition with more than its share
    of the log is read by several tasks. `per_trigger` bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        # Offsets that expired before they were read are an error, never skipped.
        "failOnDataLoss": "true",
    }
    if tasks is not None:
        options["minPartitions"] = str(tasks)
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def starting_offsets(frontier: DataFrame, partitions: Mapping[str, int]) -> str:
    """Where to resume: the committed offset, or the beginning where nothing is committed.

    One entry per log partition, which the broker bounds. A topic or partition that is not
    in `partitions` is not subscribed and gets no position.
    """
    position = {topic: {str(p): EARLIEST for p in range(count)} for topic, count in partitions.items()}
    for row in frontier.where("commit_offset IS NOT NULL").collect():
        offsets = position.get(row["kafka_topic"], {})
        if str(row["kafka_partition"]) in offsets:
            offsets[str(row["kafka_partition"])] = row["commit_offset"]
    return json.dumps(position)


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().select(*WIRE.fieldNames())


def read_log(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The log as it is now, as a bounded batch."""
    return spark.read.format("kafka").options(**options).load().select(*WIRE.fieldNames())


def produce(messages: DataFrame, servers: str) -> None:
    """Write `topic`, `partition` and `value` to the log."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
