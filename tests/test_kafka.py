import json

from tidemark.schema import TOPICS
from tidemark.sources.kafka import log_options, starting_offsets


def test_options():
    options = log_options("broker:9092", tasks=400, per_trigger=10_000)
    assert options["subscribe"] == "ingestion-events,ingestion-signals,ingestion-logs"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true"
    assert (options["minPartitions"], options["maxOffsetsPerTrigger"]) == ("400", "10000")
    assert not any("commit" in key for key in options)


def test_topics_keep_their_order():
    assert TOPICS == ("ingestion-events", "ingestion-signals", "ingestion-logs")


def test_restart_position(spark):
    frontier = spark.createDataFrame(
        [("a", 0, 50), ("a", 1, None)], "kafka_topic string, kafka_partition int, commit_offset bigint"
    )
    position = json.loads(starting_offsets(frontier, {"a": 2, "b": 1}))
    assert position == {"a": {"0": 50, "1": -2}, "b": {"0": -2}}


def test_topics_and_partitions_that_are_not_subscribed_get_no_position(spark):
    frontier = spark.createDataFrame(
        [("gone", 0, 7), ("a", 9, 8), ("a", 0, 3)], "kafka_topic string, kafka_partition int, commit_offset bigint"
    )
    assert json.loads(starting_offsets(frontier, {"a": 1})) == {"a": {"0": 3}}
