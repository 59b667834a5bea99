from datetime import datetime, timedelta, timezone

import duckdb
import pandas as pd
import pytest
from frames import log, message, wire
from pyspark.sql import functions as F

from tidemark.operators import ranges
from tidemark.operators.records import parse_envelope, records_of


def summary(spark, offsets, width):
    return ranges.range_summary(records_of(log(spark, offsets)), width)


def outcomes(spark, offsets, width):
    rows = ranges.range_status(records_of(log(spark, offsets)), width).orderBy("range_start").collect()
    return [(r.range_start, r.records, r.outcome) for r in rows]


def frontier(spark, offsets, width):
    row = ranges.commit_frontier(summary(spark, offsets, width)).first()
    return row.commit_offset, row.committed, row.abandoned, row.open_ranges


@pytest.mark.parametrize(
    ("offsets", "width", "status", "position"),
    [
        (range(6), 6, [(0, 6, "committed")], (6, 1, 0, 0)),
        (range(5), 6, [(0, 5, "open")], (None, 0, 0, 1)),
        (range(21), 8_192, [(0, 21, "open")], (None, 0, 0, 1)),
        ([2, 9], 6, [(0, 1, "abandoned"), (6, 1, "open")], (None, 0, 1, 1)),
        # A later complete range commits past the abandoned one.
        ([2, 9, 11], 6, [(0, 1, "abandoned"), (6, 2, "committed")], (12, 1, 1, 0)),
        # Only the last offset matters: holes do not keep a range open.
        ([5, 6, 10], 6, [(0, 1, "committed"), (6, 2, "open")], (6, 1, 0, 1)),
        (range(9), 3, [(n, 3, "committed") for n in (0, 3, 6)], (9, 3, 0, 0)),
        ([12], 1, [(12, 1, "committed")], (13, 1, 0, 0)),
    ],
)
def test_status_and_frontier(spark, offsets, width, status, position):
    assert outcomes(spark, offsets, width) == status
    assert frontier(spark, offsets, width) == position


def test_partitions_are_independent(spark):
    rows = wire(spark, message(7, partition=2), message(1, partition=7))
    found = ranges.range_summary(records_of(rows), 9)
    assert ranges.open_ranges(found).first().open_partitions == 2
    assert {r.kafka_partition for r in found.collect()} == {2, 7}


def test_topic_without_open_ranges_is_listed(spark):
    found = ranges.open_ranges(summary(spark, range(4), 4)).collect()
    assert [tuple(r) for r in found] == [("ingestion-events", 0)]


def test_malformed_first_row_advances_the_range(spark):
    rows = parse_envelope(records_of(wire(spark, message(0, value='{"event_id": tru'), message(1))))
    stats = ranges.ingest_stats(rows, 2).first()
    assert stats.asDict() == {"records": 2, "malformed": 1, "uploads": 1, "commits": 1, "partial_uploads": 0}


def test_stats_of_an_empty_log(spark):
    rows = parse_envelope(records_of(log(spark, [0]))).limit(0)
    assert tuple(ranges.ingest_stats(rows, 2).first()) == (0, 0, 0, 0, 0)


def test_commit_ledger_holds_complete_ranges(spark):
    found = ranges.commit_ledger(summary(spark, [0, 1, 2, 3, 4], 4)).collect()
    assert [(r.range_start, r.commit_offset) for r in found] == [(0, 4)]


def test_replay_starts_at_the_committed_offset(spark):
    rows = records_of(wire(spark, *[message(o) for o in range(7)], message(0, partition=1)))
    position = ranges.commit_frontier(ranges.range_summary(rows, 4))
    again = ranges.replay_from_frontier(rows, position).select("kafka_partition", "kafka_offset").collect()
    assert sorted(tuple(r) for r in again) == [(0, 4), (0, 5), (0, 6), (1, 0)]


def test_lag(spark):
    row = ranges.consumer_lag(records_of(log(spark, range(7))), 4).first()
    assert (row.head, row.frontier, row.lag) == (7, 4, 3)


def test_names_depend_on_keys_only(spark):
    partial = ranges.object_names(summary(spark, [700], 640), "2027-02-28").first().object_name
    whole = ranges.object_names(summary(spark, [640, 1_279], 640), "2027-02-28").first().object_name
    assert partial == whole == "ingestion-events/dt=2027-02-28/0-640-1279.parquet"


def test_tiling_finds_a_missing_range(spark):
    found = ranges.range_tiling(summary(spark, [0, 4, 12], 4), 4).orderBy("range_start").collect()
    assert [(r.previous_end, r.is_adjacent) for r in found] == [(None, None), (3, True), (7, False)]


def clocked(spark, seconds):
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    rows = [message(o, stamp=start + timedelta(seconds=s)) for o, s in enumerate(seconds)]
    return records_of(wire(spark, *rows)).withColumn("clock", F.col("kafka_timestamp"))


def test_idle_flushes_and_upload_history(spark):
    # Range [0, 4]: quiet for 30 s after offset 1. Range [5, 9]: quiet before it began, and
    # for 29 s inside.
    records = clocked(spark, [0, 1, 31, 32, 33, 100, 129])
    points = ranges.idle_flush_points(records, 5, "clock", 30_000).collect()
    assert [(r.range_start, r.through_offset) for r in points] == [(0, 1)]
    uploads = ranges.upload_history(records, 5, "clock", 30_000).orderBy("range_start", "upload").collect()
    assert [(r.range_start, r.upload, r.upload_rows) for r in uploads] == [(0, 1, 2), (0, 2, 5), (5, 1, 2)]


UPLOADS = """
WITH waits AS (
  SELECT o // 7 * 7 AS start, o, lead(clock) OVER w - clock AS wait FROM arrived
  WINDOW w AS (PARTITION BY o // 7 ORDER BY o))
SELECT start, (SELECT count(*) FROM waits i WHERE i.start = waits.start AND i.o <= waits.o) AS held
FROM waits WHERE wait IS NULL OR wait >= 30 ORDER BY start, o"""


def test_upload_history_follows_the_flush_rules(spark):
    import random

    rng = random.Random(3)
    clock, events = 0, []
    for offset in range(400):
        clock += rng.choice([1, 2, 40])
        if rng.random() < 0.8:
            events.append((offset, clock))
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    rows = [message(o, stamp=start + timedelta(seconds=s)) for o, s in events]
    records = records_of(wire(spark, *rows)).withColumn("clock", F.col("kafka_timestamp"))
    found = ranges.upload_history(records, 7, "clock", 30_000).orderBy("range_start", "upload").collect()
    arrived = pd.DataFrame(events, columns=["o", "clock"])
    expected = duckdb.sql(UPLOADS).fetchall()
    assert len(arrived) and [(r.range_start, r.upload_rows) for r in found] == expected
