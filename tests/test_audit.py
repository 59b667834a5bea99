import random

import pytest
from frames import NOW, envelope, message, wire
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.records import parse_envelope, records_of

KEYS = "kafka_topic string, kafka_partition int, kafka_offset bigint"


def rows(spark, offsets, partition=0):
    return spark.createDataFrame([("t", partition, o) for o in offsets], KEYS)


@pytest.mark.parametrize("copies", [False, True])
def test_gaps_across_blocks_and_duplicates(spark, copies):
    offsets = [0, 1, 1, 4, 65_535, 65_536, 200_000, 200_002]
    found = audit.offset_gaps(rows(spark, offsets), copies).orderBy("gap_start").collect()
    assert [(r.gap_start, r.gap_end, r.missing) for r in found] == [
        (2, 3, 2),
        (5, 65_534, 65_530),
        (65_537, 199_999, 134_463),
        (200_001, 200_001, 1),
    ]


def test_log_and_staging_differ_both_ways(spark):
    found = audit.log_vs_staging(rows(spark, [0, 1, 2]), rows(spark, [1, 1, 2, 3])).collect()
    assert sorted((r.kafka_offset, r.side) for r in found) == [(0, "log_only"), (3, "staging_only")]


def test_unsafe_commits(spark):
    schema = "kafka_topic string, kafka_partition int, commit_offset bigint"
    position = spark.createDataFrame([("t", 0, 3), ("t", 1, None)], schema)
    log = rows(spark, range(6)).union(rows(spark, range(3), partition=1))
    found = audit.unsafe_commits(log, rows(spark, [0, 2]), position).collect()
    assert [(r.kafka_partition, r.kafka_offset) for r in found] == [(0, 1)]


def test_duplicates_and_latest(spark):
    staged = spark.createDataFrame([("t", 0, 1, 1), ("t", 0, 1, 3), ("t", 0, 2, 1)], KEYS + ", attempt int")
    assert [tuple(r) for r in audit.duplicate_offsets(staged).collect()] == [("t", 0, 1, 2)]
    latest = audit.latest_rows(staged, "attempt").collect()
    assert sorted((r.kafka_offset, r.attempt) for r in latest) == [(1, 3), (2, 1)]


def test_dirty_ranges(spark):
    found = audit.dirty_ranges(rows(spark, range(10)), rows(spark, [0, 1, 2, 3, 4, 6, 8, 9]), 4)
    assert sorted(r.range_start for r in found.collect()) == [4]


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_against_brute_force(spark, seed):
    rng = random.Random(seed)
    ranges = set()
    for _ in range(300):
        partition, start = rng.randrange(3), rng.randrange(5000)
        width = rng.choice([1, 2, 10, 16, 50, 64, 80, 700])
        if seed % 2:
            start -= start % width
        ranges.add((partition, start, start + width - 1))
    ranges.add((0, 0, 2**62))
    frame = spark.createDataFrame(
        [("t", *r) for r in ranges] * 2, "kafka_topic string, kafka_partition int, range_start bigint, range_end bigint"
    )
    found = audit.overlapping_ranges(frame).collect()
    expected = {
        (p, s1, e1, s2, e2)
        for p, s1, e1 in ranges
        for q, s2, e2 in ranges
        if p == q and s1 <= e2 and s2 <= e1 and (s1 < s2 or (s1 == s2 and e1 < e2))
    }
    assert len(found) == len(expected)
    assert {(r.kafka_partition, r.a_start, r.a_end, r.b_start, r.b_end) for r in found} == expected


def test_split_ranges(spark):
    staged = spark.createDataFrame(
        [("t", 0, 0, 3, "d1"), ("t", 0, 0, 3, "d2"), ("t", 0, 0, 3, "d2"), ("t", 0, 4, 7, "d1")],
        "kafka_topic string, kafka_partition int, range_start bigint, range_end bigint, dt string",
    )
    assert [tuple(r) for r in audit.split_ranges(staged).collect()] == [("t", 0, 0, 3, 2)]


def test_counts_over_parsed_rows(spark):
    parsed = parse_envelope(
        records_of(
            wire(
                spark,
                message(0, value=envelope(0, received_at="?")),
                message(1, value=envelope(1, event_header={"sub": "u"}, received_at="2031-05-20T23:59:59Z")),
                message(2, value="x"),
            )
        )
    )
    assert [tuple(r) for r in audit.received_at_nulls(parsed).collect()] == [("ingestion-events", 1)]
    assert sorted((r.has_header, r.records) for r in audit.auth_mix(parsed).collect()) == [(False, 1), (True, 1)]
    assert [tuple(r) for r in audit.lateness_by_write_date(parsed, f"{NOW:%Y-%m-%d}").collect()] == [("2031-05-20", 1)]


def test_unsorted_object_is_reported(spark):
    frame = spark.createDataFrame(
        [("f", i, o) for i, o in enumerate([0, 2, 1])], "file_path string, row_index bigint, kafka_offset bigint"
    )
    placed = frame.select(
        "*", F.lit("t").alias("topic"), F.lit("d").alias("dt"), F.lit(0).alias("part"),
        F.lit(0).alias("range_start"), F.lit(3).alias("range_end"),
    )
    assert [tuple(r) for r in audit.object_row_order(placed).collect()] == [("t/dt=d/0-0-3.parquet", False)]


def test_trace(spark):
    staged = rows(spark, [1, 2]).withColumn("event_id", F.lit("e"))
    log = rows(spark, [1, 2, 3]).withColumn("src", F.col("kafka_offset") * 10)
    assert sorted((r.kafka_offset, r.src) for r in audit.trace_rows(staged, log, "src").collect()) == [(1, 10), (2, 20)]
