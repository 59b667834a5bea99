import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import commit_offset, in_range, is_complete, object_name, range_end, range_start, width_of
from tidemark.functions.ranges import MAX_OFFSET


def ranges(spark, offsets, width):
    df = spark.createDataFrame([(o,) for o in offsets], "o bigint")
    df = df.withColumn("s", range_start(F.col("o"), width)).withColumn("e", range_end(F.col("s"), width))
    return [tuple(r) for r in df.orderBy("o").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, MAX_OFFSET), min_size=1, max_size=50), st.integers(1, 10**6))
def test_ranges_follow_the_arithmetic(spark, offsets, width):
    for o, s, e in ranges(spark, offsets, width):
        assert s == o // width * width
        assert e == min(s + width - 1, MAX_OFFSET)


@pytest.mark.parametrize("width", [1, 2, 37, 6_000])
def test_every_offset_lies_in_one_range_and_ranges_touch(spark, width):
    dice = random.Random(width)
    edges = [n * width + step for n in (0, 1, 2, 11) for step in (-1, 0, 1)]
    offsets = sorted({o for o in (*edges, *(dice.randrange(15 * width) for _ in range(60))) if o >= 0})
    found = ranges(spark, offsets, width)
    assert all(s <= o <= e and e - s + 1 == width for o, s, e in found)
    starts = sorted({s for _, s, _ in found})
    assert all((b - a) % width == 0 for a, b in zip(starts, starts[1:], strict=False))


@pytest.mark.parametrize("width", [0, -5, 1.5, None, True])
def test_other_widths_are_refused(spark, width):
    with pytest.raises(ValueError):
        range_start(F.col("o"), width)


def test_top_of_offset_space_is_clamped(spark):
    ((_, start, end),) = ranges(spark, [MAX_OFFSET], 6_000)
    assert end == MAX_OFFSET and 0 < start <= MAX_OFFSET


@pytest.mark.parametrize(("start", "end"), [(36, 47), (5, 5), (0, 6_143)])
def test_commit_width_completeness_and_membership(spark, start, end):
    offsets = [max(0, start - 1), start, (start + end) // 2, end, end + 1]
    probe = spark.createDataFrame([(o, start, end) for o in offsets], "o bigint, s bigint, e bigint")
    found = probe.select(
        "o",
        commit_offset(F.col("e")).alias("commit"),
        width_of(F.col("s"), F.col("e")).alias("width"),
        is_complete(F.col("o"), F.col("e")).alias("complete"),
        in_range(F.col("o"), F.col("s"), F.col("e")).alias("inside"),
    )
    for row in found.collect():
        assert (row.commit, row.width) == (end + 1, len(range(start, end + 1)))
        assert row.complete == (row.o >= end)
        assert row.inside == (row.o in range(start, end + 1))


def name_of(spark, offset, topic="ingestion-logs", partition=5, date="2027-02-28", width=640):
    df = spark.createDataFrame([(topic, partition, date, offset)], "t string, p int, d string, o bigint")
    start = range_start(F.col("o"), width)
    return df.select(object_name(F.col("t"), F.col("p"), F.col("d"), start, range_end(start, width))).first()[0]


def test_object_name(spark):
    assert name_of(spark, 1_300) == "ingestion-logs/dt=2027-02-28/5-1280-1919.parquet"
    dice = random.Random(4)
    within = [1_280 + dice.randrange(640) for _ in range(3)]
    assert {name_of(spark, o) for o in within} == {name_of(spark, 1_300)}
    changes = [{"topic": "ingestion-signals"}, {"partition": 50}, {"date": "2027-03-01"}, {"width": 64}]
    assert len({name_of(spark, 1_300, **change) for change in [{}, *changes]}) == 5
