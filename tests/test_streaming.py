from datetime import timedelta

import pytest
from frames import NOW, log, message, wire

from tidemark.schema import WIRE
from tidemark.session import scratch_dir
from tidemark.sinks import ledger
from tidemark.sinks.area import StagingArea
from tidemark.sinks.staging import publish_ranges, read_staging
from tidemark.streaming.ingest import start


class Inbox:
    """Parquet files that arrive one by one, as a stream of messages."""

    def __init__(self, spark):
        self.spark = spark
        self.path, self.checkpoint = scratch_dir(spark, "inbox"), scratch_dir(spark, "checkpoint")
        self.area = StagingArea(scratch_dir(spark, "area"))

    def arrive(self, *messages):
        wire(self.spark, *messages).coalesce(1).write.mode("append").parquet(self.path)

    def drain(self, width=5, checkpoint=None, **options):
        stream = self.spark.readStream.schema(WIRE).option("maxFilesPerTrigger", 1).parquet(self.path)
        query = start(stream, self.area, checkpoint or self.checkpoint, width, drain=True, now=NOW, **options)
        query.awaitTermination()

    def offsets(self):
        return sorted(r.kafka_offset for r in read_staging(self.spark, self.area).collect())

    def committed(self):
        return sorted(r.commit_offset for r in ledger.frontier(self.spark, self.area).collect())


@pytest.fixture
def inbox(spark):
    return Inbox(spark)


def test_a_partial_range_is_published_and_completed_after_a_restart(inbox):
    inbox.arrive(*[message(n) for n in (0, 1, 2)])
    inbox.drain()
    assert (inbox.offsets(), inbox.committed()) == ([0, 1, 2], [])
    inbox.arrive(*[message(n) for n in (3, 4)])
    inbox.drain()
    assert (inbox.offsets(), inbox.committed()) == ([0, 1, 2, 3, 4], [5])


def test_many_micro_batches(inbox):
    for n in range(6):
        inbox.arrive(message(2 * n), message(2 * n + 1), message(n, partition=1, value='{"event_id": tru'))
    told = []
    inbox.drain(on_batch=lambda batch, counts: told.append((batch, counts)))
    assert told == [(n, {"records": 3, "malformed": 1}) for n in range(6)]
    assert inbox.offsets() == sorted([*range(12), *range(6)])
    assert inbox.committed() == [5, 10]
    assert ledger.ledger_stats(inbox.spark, inbox.area).first().malformed == 6


def test_a_lost_run_is_repeated_without_doubling(inbox):
    inbox.arrive(*[message(n) for n in range(4)])
    calls = []

    def fail_once(rows, area):
        publish_ranges(rows, area)
        if not calls:
            calls.append(1)
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        inbox.drain(publish=fail_once)
    assert inbox.committed() == []
    inbox.arrive(*[message(n) for n in range(3, 6)])
    inbox.drain(publish=fail_once)
    assert (inbox.offsets(), inbox.committed()) == ([0, 1, 2, 3, 4, 5], [5])


def test_a_new_checkpoint_reads_again_without_harm(inbox):
    inbox.arrive(*[message(n) for n in range(7)])
    inbox.drain()
    state = sorted(map(tuple, ledger.ledger_state(inbox.spark, inbox.area).drop("batch_id").collect()))
    inbox.drain(checkpoint=scratch_dir(inbox.spark, "other"))
    assert inbox.offsets() == list(range(7))
    assert sorted(map(tuple, ledger.ledger_state(inbox.spark, inbox.area).drop("batch_id").collect())) == state


def test_nothing_arrived_nothing_written(inbox):
    inbox.arrive(message(0))
    inbox.drain()
    rows = ledger.ledger_rows(inbox.spark, inbox.area).count()
    inbox.drain()
    assert ledger.ledger_rows(inbox.spark, inbox.area).count() == rows


def test_processing_time_trigger_publishes_partial_ranges(inbox):
    inbox.arrive(message(0), message(1))
    stream = inbox.spark.readStream.schema(WIRE).parquet(inbox.path)
    query = start(stream, inbox.area, inbox.checkpoint, 5, idle_ms=200, now=NOW + timedelta(days=1))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert (inbox.offsets(), inbox.committed()) == ([0, 1], [])


def test_another_width_is_refused(inbox):
    inbox.arrive(message(0))
    inbox.drain()
    with pytest.raises(ValueError, match="ranges of 5 offsets"):
        inbox.drain(width=10)


def test_wire_schema_is_what_frames_use(spark):
    assert log(spark, [0]).schema == WIRE
