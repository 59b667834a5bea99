import random
import shutil
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from frames import NOW, envelope, log, message, wire
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.schema import STAGING
from tidemark.session import scratch_dir
from tidemark.sinks import ledger, staging
from tidemark.sinks.area import ObjectArea, StagingArea, children, make_folder
from tidemark.sinks.ownership import release
from tidemark.sinks.settled import publish_settled
from tidemark.sinks.staging import (
    read_day,
    read_object,
    read_ranges,
    read_settled,
    read_staging,
    stage_batch,
    stage_log,
    wait_for_object,
)


@pytest.fixture(params=[StagingArea, ObjectArea])
def area(spark, request):
    return request.param(scratch_dir(spark, "area"))


def offsets(spark, area):
    rows = read_staging(spark, area).orderBy("topic", "part", "kafka_offset").collect()
    return [r.kafka_offset for r in rows]


def stored(area):
    return {str(p.relative_to(area.data)): p.stat().st_mtime_ns for p in Path(area.data).rglob("*.parquet")}


def files(area):
    return sorted(stored(area))


def committed(spark, area):
    return [r.commit_offset for r in ledger.frontier(spark, area).collect()]


def state(spark, area):
    rows = ledger.ledger_state(spark, area).orderBy("topic", "partition", "range_start").collect()
    return [(r.range_start, r.records, r.outcome, r.commit_offset) for r in rows]


def test_a_complete_range_is_one_object_and_commits(spark, area):
    stage_log(log(spark, range(4)), area, 4, now=NOW)
    assert len(files(area)) == 1
    if isinstance(area, ObjectArea):
        assert files(area) == ["ingestion-events/dt=2031-05-21/0-0-3.parquet"]
    else:
        assert files(area)[0].startswith("topic=ingestion-events/dt=2031-05-21/part=0/range_start=0/")
    assert committed(spark, area) == [4]


def test_an_unfinished_range_commits_nothing(spark, area):
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    assert offsets(spark, area) == [0, 1, 2]
    assert committed(spark, area) == []


def test_finishing_a_range_publishes_a_superset(spark, area):
    stage_log(log(spark, [0, 1, 2]), area, 5, now=NOW)
    assert (state(spark, area), committed(spark, area)) == ([(0, 3, "open", None)], [])
    stage_log(log(spark, [3, 4]), area, 5, now=NOW)
    assert offsets(spark, area) == [0, 1, 2, 3, 4]
    assert len(files(area)) == 1
    assert (state(spark, area), committed(spark, area)) == ([(0, 5, "committed", 5)], [5])


def test_end_to_end_ranges(spark, area):
    stage_log(log(spark, range(10)), area, 5, now=NOW)
    assert state(spark, area) == [(0, 5, "committed", 5), (5, 5, "committed", 10)]
    assert committed(spark, area) == [10]
    second = read_object(spark, area, "ingestion-events/dt=2031-05-21/0-5-9.parquet")
    assert [r.event_id for r in second.collect()] == [f"item-{n}" for n in range(5, 10)]


def test_an_abandoned_range_is_staged_and_passed_over(spark, area):
    stage_log(log(spark, [0]), area, 4, now=NOW)
    stage_log(log(spark, [5, 6, 7]), area, 4, now=NOW)
    assert state(spark, area) == [(0, 1, "abandoned", None), (4, 3, "committed", 8)]
    assert committed(spark, area) == [8]


def test_malformed_rows_are_staged_and_counted(spark, area):
    stage_log(wire(spark, message(0, value='{"event_id": tru'), message(1, value=None), message(2)), area, 3, now=NOW)
    assert offsets(spark, area) == [0, 1, 2]
    stats = ledger.ledger_stats(spark, area).first()
    assert stats.asDict() == {"records": 3, "malformed": 2, "ranges": 1, "commits": 1, "partial_ranges": 0}


def test_redelivered_rows_do_not_double_and_the_staged_row_wins(spark, area):
    stage_log(log(spark, [0, 1]), area, 10, now=NOW)
    again = wire(spark, message(1, value=envelope(99)), message(2), message(2))
    stage_log(again, area, 10, now=NOW + timedelta(hours=1))
    assert offsets(spark, area) == [0, 1, 2]
    rows = {r.kafka_offset: r for r in read_staging(spark, area).collect()}
    assert rows[1].event_id == "item-1"
    assert rows[1].ingested_at == rows[0].ingested_at != rows[2].ingested_at


def test_many_copies_of_one_offset(spark, area):
    rows = wire(spark, *[message(1)] * 50, message(0), message(2))
    stage_log(rows, area, 4, now=NOW)
    assert offsets(spark, area) == [0, 1, 2]
    stage_log(wire(spark, *[message(3)] * 50, message(1)), area, 4, now=NOW)
    assert offsets(spark, area) == [0, 1, 2, 3]
    assert committed(spark, area) == [4]


def test_one_day(spark, area):
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    assert read_day(spark, area, "ingestion-events", "2031-05-21").count() == 3
    assert read_day(spark, area, "ingestion-events", "2031-05-22").count() == 0


def test_nothing_new_writes_nothing(spark, area):
    stage_log(log(spark, range(6)), area, 4, now=NOW)
    before = stored(area)
    stage_log(log(spark, range(6)), area, 4, now=NOW)
    assert stored(area) == before
    stage_log(log(spark, [5, 6]), area, 4, now=NOW)
    after = stored(area)
    untouched = {f for f in before if before[f] == after.get(f)}
    assert untouched == {f for f in before if "range_start=0/" in f or "0-0-3" in f}
    assert offsets(spark, area) == list(range(7))


def test_a_range_keeps_its_date_over_midnight(spark, area):
    late = datetime(2031, 5, 21, 23, 59, tzinfo=timezone.utc)
    stage_log(log(spark, [0, 1]), area, 4, now=late)
    stage_log(log(spark, [2, 3, 4]), area, 4, now=late + timedelta(minutes=2))
    dates = {(r.range_start, r.dt) for r in read_staging(spark, area).select("range_start", "dt").collect()}
    assert dates == {(0, "2031-05-21"), (4, "2031-05-22")}
    assert ledger.staged_ranges(spark, area).count() == 2
    assert audit.split_ranges(ledger.staged_ranges(spark, area)).count() == 0
    assert audit.overlapping_ranges(ledger.staged_ranges(spark, area)).count() == 0
    assert offsets(spark, area) == [0, 1, 2, 3, 4]


def test_a_replay_after_midnight_writes_to_the_same_places(spark, area):
    late = datetime(2031, 5, 21, 23, 59, tzinfo=timezone.utc)

    def fail(rows, where):
        staging.publish_ranges(rows, where)
        raise OSError("lost after the data was written")

    with pytest.raises(OSError):
        stage_batch(log(spark, [0, 1]), 0, area, 4, now=late, publish=fail)
    assert committed(spark, area) == [] and children(spark, area.batches) == []
    stage_batch(log(spark, [0, 1]), 0, area, 4, now=late + timedelta(minutes=2))
    assert {r.dt for r in read_staging(spark, area).collect()} == {"2031-05-21"}
    assert offsets(spark, area) == [0, 1]


def test_a_failed_write_leaves_the_ledger(spark, area):
    def fail(rows, where):
        raise PermissionError("no")

    with pytest.raises(PermissionError):
        stage_batch(log(spark, range(4)), 0, area, 4, now=NOW, publish=fail)
    assert ledger.ledger_rows(spark, area).count() == 0
    stage_batch(log(spark, range(4)), 0, area, 4, now=NOW)
    assert committed(spark, area) == [4]


def test_rows_of_earlier_batches_survive_a_loss_in_mid_replacement(spark, area):
    stage_batch(log(spark, [0, 1, 2]), 0, area, 5, now=NOW)

    def lose(rows, where):
        # What a driver lost between removing the old folder and renaming the new one leaves.
        path = Path(where.range_path("ingestion-events", "2031-05-21", 0, 0, 4))
        path.unlink() if path.is_file() else shutil.rmtree(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        stage_batch(log(spark, [3, 4]), 1, area, 5, now=NOW, publish=lose)
    assert committed(spark, area) == []
    stage_batch(log(spark, [3, 4]), 1, area, 5, now=NOW)
    assert offsets(spark, area) == [0, 1, 2, 3, 4]
    assert committed(spark, area) == [5]


def test_a_replayed_batch_converges(spark, area):
    for _ in range(3):
        stage_batch(log(spark, range(7)), 0, area, 4, now=NOW)
    assert offsets(spark, area) == list(range(7))
    assert state(spark, area) == [(0, 4, "committed", 4), (4, 3, "open", None)]
    assert ledger.ledger_rows(spark, area).count() == 2


def test_leftovers_of_settled_batches_are_removed(spark, area):
    for batch in range(3):
        stage_batch(log(spark, [batch]), batch, area, 10, now=NOW)
    assert [name[:-16] for name in children(spark, area.intents)] == [ledger.batch_name("batch", 2, "")]
    assert children(spark, area.carried) == []


def test_each_range_is_one_file_in_offset_order(spark):
    area = StagingArea(scratch_dir(spark, "area"))
    rows = log(spark, range(0, 2000, 3)).repartition(16)
    stage_log(rows, area, 50, now=NOW)
    assert len(files(area)) == 40
    placed = read_staging(spark, area).select(
        "*", "_metadata.file_path", "_metadata.row_index", (F.col("range_start") + 49).alias("range_end")
    )
    found = audit.object_row_order(placed).collect()
    assert len(found) == 40 and all(r.is_sorted for r in found)


def test_partitions_and_topics_are_kept_apart(spark, area):
    rows = wire(spark, message(0), message(0, partition=1), message(0, topic="ingestion-logs"))
    stage_log(rows, area, 4, now=NOW)
    assert len(files(area)) == 3


def test_file_schema(spark, area):
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    file = pq.ParquetFile(f"{area.data}/{files(area)[0]}")
    assert file.schema_arrow.names == STAGING.fieldNames()
    assert [f.nullable for f in file.schema_arrow] == [f.nullable for f in STAGING]
    assert str(file.schema_arrow.field("received_at").type) == "timestamp[us, tz=UTC]"
    assert file.metadata.row_group(0).column(0).compression == "ZSTD"


def test_an_empty_batch_stages_nothing(spark, area):
    stage_log(log(spark, [0]).limit(0), area, 4, now=NOW)
    assert ledger.ledger_rows(spark, area).count() == 0


def test_an_empty_frame_is_a_readable_file(spark, area):
    path = f"{area.root}/empty"
    spark.createDataFrame([], STAGING).write.parquet(path)
    assert spark.read.parquet(path).columns == STAGING.fieldNames()


def test_another_width_is_refused(spark, area):
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    with pytest.raises(ValueError, match="ranges of 4 offsets"):
        stage_log(log(spark, range(3)), area, 8, now=NOW)
    with pytest.raises(ValueError):
        stage_log(log(spark, range(3)), area, 0, now=NOW)


def test_objects_are_in_offset_order(spark):
    area = ObjectArea(scratch_dir(spark, "area"))
    stage_log(log(spark, range(0, 2000, 3)).repartition(16), area, 50, now=NOW)
    assert len(files(area)) == 40
    for file in files(area):
        found = pq.read_table(f"{area.data}/{file}").column("kafka_offset").to_pylist()
        assert found == sorted(found) and {o // 50 * 50 for o in found} == {int(file.split("-")[-2])}


def test_counters_of_a_batch(spark, area):
    counters = Observation("batch")
    stage_batch(wire(spark, message(0), message(1, value="x")), 0, area, 4, now=NOW, counters=counters)
    assert counters.get == {"records": 2, "malformed": 1}


def test_waiting_for_an_object(spark, area):
    name = "ingestion-events/dt=2031-05-21/0-0-3.parquet"
    assert not wait_for_object(spark, area, name, 0)
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    assert wait_for_object(spark, area, name, 0)


def test_an_unknown_object_is_empty(spark, area):
    stage_log(log(spark, range(3)), area, 4, now=NOW)
    assert read_object(spark, area, "ingestion-events/dt=2031-05-21/0-0-3.parquet").count() == 3
    assert read_object(spark, area, "ingestion-events/dt=2031-05-21/0-4-7.parquet").count() == 0


def test_compaction_keeps_the_state(spark, area):
    for batch, part in enumerate(([0, 1], [2, 3], [4], [9])):
        stage_batch(log(spark, part), batch, area, 4, now=NOW)
    before, position = state(spark, area), committed(spark, area)
    ledger.compact(spark, area)
    assert children(spark, area.batches) == [] and len(children(spark, area.snapshots)) == 1
    assert (state(spark, area), committed(spark, area)) == (before, position)
    stage_batch(log(spark, [10, 11]), 4, area, 4, now=NOW)
    ledger.compact(spark, area)
    assert len(children(spark, area.snapshots)) == 1
    assert state(spark, area) == [*before[:2], (8, 3, "committed", 12)]


def test_many_ranges_over_more_tasks(spark, area, monkeypatch):
    monkeypatch.setattr(staging, "ROWS_PER_TASK", 2)
    stage_log(log(spark, range(1, 45, 2)), area, 3, now=NOW)
    stage_log(log(spark, range(45)), area, 3, now=NOW + timedelta(days=1))
    assert offsets(spark, area) == list(range(45))
    assert committed(spark, area) == [45]
    assert len(files(area)) == 15


def test_ranges_are_found_without_reading_other_folders(spark, area):
    stage_log(log(spark, range(60)), area, 3, now=NOW)
    wanted = ledger.ledger_state(spark, area).where("range_start IN (9, 33)").withColumnRenamed("partition", "part")
    found = read_ranges(spark, area, wanted)
    assert sorted(r.kafka_offset for r in found.collect()) == [9, 10, 11, 33, 34, 35]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(kafka_offset,9)" in plan and "LessThanOrEqual(kafka_offset,35)" in plan
    if not isinstance(area, ObjectArea):
        folders = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert "dynamicpruning" in plan and "range_start" in folders


def test_settled_rows_leave_out_fresh_partial_ranges(spark, area):
    stage_log(log(spark, range(6)), area, 4, now=NOW)
    fresh = read_settled(spark, area, NOW - timedelta(seconds=30))
    assert sorted(r.kafka_offset for r in fresh.collect()) == [0, 1, 2, 3]
    quiet = read_settled(spark, area, NOW + timedelta(seconds=30))
    assert quiet.count() == 6


@pytest.mark.parametrize("kind", [StagingArea, ObjectArea])
def test_only_settled_ranges_are_published(spark, area, kind):
    shown = kind(scratch_dir(spark, "shown"))
    fresh = NOW - timedelta(seconds=30)
    stage_log(log(spark, range(6)), area, 4, now=NOW)
    assert publish_settled(spark, area, shown, 4, fresh)
    assert offsets(spark, shown) == [0, 1, 2, 3]
    assert committed(spark, shown) == [4]
    # Nothing settled since; then the open range goes quiet, and later it is completed.
    assert not publish_settled(spark, area, shown, 4, fresh)
    assert publish_settled(spark, area, shown, 4, NOW)
    assert offsets(spark, shown) == [0, 1, 2, 3, 4, 5]
    assert committed(spark, shown) == [4]
    stage_log(log(spark, [6, 7]), area, 4, now=NOW)
    assert publish_settled(spark, area, shown, 4, fresh)
    assert offsets(spark, shown) == list(range(8))
    assert committed(spark, shown) == [8]
    assert len(files(shown)) == 2


def test_contract_violations_are_found(spark, area):
    stage_log(wire(spark, message(0), message(1, value="x")), area, 4, now=NOW)
    rows = read_staging(spark, area)
    clean = dict(audit.contract_violations(rows).collect())
    assert set(clean.values()) == {0}
    bad = rows.withColumn("event_id", F.lit("x")).withColumn("malformed_reason", F.lit(None).cast("string"))
    found = dict(audit.contract_violations(bad.withColumn("kafka_topic", F.lit(None).cast("string"))).collect())
    assert {k: v for k, v in found.items() if v} == {
        "null_kafka_topic": 2,
        "envelope_on_malformed": 1,
        "no_reason_on_malformed": 1,
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_delivery_with_losses_ends_the_same(spark, area, seed):
    """Random batches with redelivery; some are lost at a random step and repeated."""
    rng = random.Random(seed)
    width, partitions = 7, 2
    present = {p: [o for o in range(40) if rng.random() < 0.85] for p in range(partitions)}
    position = dict.fromkeys(present, 0)
    batch, instant = 0, NOW
    while any(position[p] < len(present[p]) for p in present):
        delivered = []
        for p, found in present.items():
            back = max(0, position[p] - rng.randrange(4))
            position[p] = min(len(found), position[p] + rng.randrange(1, 25))
            delivered += [message(o, partition=p) for o in found[back : position[p]]]
        loss = rng.choice([None, "before", "after"])

        def lose(rows, where, loss=loss):
            if loss == "after":
                staging.publish_ranges(rows, where)
            raise OSError("lost")

        if loss is not None:
            with pytest.raises(OSError):
                stage_batch(wire(spark, *delivered), batch, area, width, now=instant, publish=lose)
        instant += timedelta(hours=9)
        stage_batch(wire(spark, *delivered), batch, area, width, now=instant)
        batch += 1
    staged = read_staging(spark, area).select("part", "kafka_offset", "range_start", "dt").collect()
    assert sorted((r.part, r.kafka_offset) for r in staged) == sorted((p, o) for p in present for o in present[p])
    assert len({(r.part, r.range_start, r.dt) for r in staged}) == len({(r.part, r.range_start) for r in staged})
    ends = {p: [o + 1 for o in present[p] if o % width == width - 1] for p in present}
    found = {r.kafka_partition: r.commit_offset for r in ledger.frontier(spark, area).collect()}
    assert found == {p: max(e) for p, e in ends.items() if e}


def test_another_batch_under_an_old_number_keeps_the_first(spark, area):
    """A checkpoint was lost, and the new one counts from the beginning."""
    stage_batch(log(spark, range(20, 24)), 0, area, 7, writer="w", now=NOW)
    stage_batch(log(spark, range(24, 28)), 0, area, 7, writer="w", now=NOW)
    assert offsets(spark, area) == list(range(20, 28))
    assert state(spark, area) == [(14, 1, "committed", 21), (21, 7, "committed", 28)]


def test_a_retry_on_a_grown_log_records_all_it_staged(spark, area):
    def half(rows, where):
        staging.publish_ranges(rows, where)
        raise RuntimeError("lost after the write")

    with pytest.raises(RuntimeError):
        stage_batch(log(spark, range(4)), 0, area, 6, now=NOW, publish=half)
    stage_log(log(spark, range(9)), area, 6, now=NOW)
    stage_log(log(spark, range(9, 12)), area, 6, now=NOW)
    assert offsets(spark, area) == list(range(12))
    assert state(spark, area) == [(0, 6, "committed", 6), (6, 6, "committed", 12)]


def test_rows_of_an_unfinished_batch_are_put_back_before_another(spark, area):
    """A batch replaced a range and never finished; the next batch has other content."""
    stage_log(log(spark, range(2)), area, 6, now=NOW)

    def lose(rows, where):
        shutil.rmtree(where.data)
        raise RuntimeError("lost in mid replacement")

    with pytest.raises(RuntimeError):
        stage_batch(log(spark, [2]), 7, area, 6, writer="w", now=NOW, publish=lose)
    stage_batch(log(spark, [13]), 7, area, 6, writer="w", now=NOW)
    assert offsets(spark, area) == [0, 1, 13]


def test_another_width_is_refused_in_a_batch(spark, area):
    stage_batch(log(spark, range(3)), 0, area, 3, now=NOW)
    with pytest.raises(ValueError, match="ranges of 3"):
        stage_batch(log(spark, range(3, 6)), 1, area, 6, now=NOW)


def test_copies_are_chosen_by_time_in_any_order(spark, area):
    early, late = NOW - timedelta(hours=2), NOW - timedelta(hours=1)
    for offset, (first, second) in enumerate(((early, late), (late, early))):
        a = message(offset, value=envelope("a"), stamp=first)
        b = message(offset, value=envelope("b"), stamp=second)
        stage_log(wire(spark, a, b), area, 9, now=NOW)
    assert [r.event_id for r in read_staging(spark, area).orderBy("kafka_offset").collect()] == ["item-a", "item-b"]


@pytest.mark.parametrize("second", ["w", "other"])
def test_an_area_has_one_writer_at_a_time(spark, area, second):
    def intrude(rows, where):
        with pytest.raises(RuntimeError, match="is held by w"):
            stage_batch(log(spark, [8]), 1, area, 3, writer=second, now=NOW)
        staging.publish_ranges(rows, where)

    stage_batch(log(spark, range(3)), 0, area, 3, writer="w", now=NOW, publish=intrude)
    assert offsets(spark, area) == [0, 1, 2]
    assert children(spark, area.claims) == []
    stage_batch(log(spark, [8]), 1, area, 3, writer=second, now=NOW)
    assert offsets(spark, area) == [0, 1, 2, 8]


def test_the_claim_of_a_lost_driver(spark, area):
    """The same writer takes over; another one waits for the release."""
    make_folder(spark, f"{area.claims}/w.app-gone.1")
    with pytest.raises(RuntimeError, match="is held by w of app-gone"):
        stage_batch(log(spark, range(3)), 0, area, 3, writer="other", now=NOW)
    stage_batch(log(spark, range(3)), 0, area, 3, writer="w", now=NOW)
    make_folder(spark, f"{area.claims}/w.app-gone.2")
    release(spark, area)
    stage_batch(log(spark, range(3, 6)), 0, area, 3, writer="other", now=NOW)
    assert committed(spark, area) == [6]


def test_the_width_of_an_area_without_a_note_is_that_of_its_ledger(spark, area):
    stage_log(log(spark, range(5)), area, 4, now=NOW)
    shutil.rmtree(area.widths)
    with pytest.raises(ValueError, match="ranges of 4 offsets, not 8"):
        stage_log(log(spark, [11]), area, 8, now=NOW)
    stage_log(log(spark, [11]), area, 4, now=NOW)
    assert offsets(spark, area) == [0, 1, 2, 3, 4, 11]
