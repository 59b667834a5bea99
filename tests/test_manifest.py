"""The manifest area: what fails, what is replaced, what readers see."""

import pickle
import random
from collections import Counter
from datetime import timedelta

import pytest
from frames import NOW, envelope, log, message, wire

from pyspark.sql import functions as F
from tidemark.schema import WIRE
from tidemark.session import scratch_dir
from tidemark.sinks import manifest, row_index, staging, versions
from tidemark.sinks.area import ManifestArea, children, put_if_absent, read_text
from tidemark.sources.changes import ChangeReader, read_changes
from tidemark.streaming.ingest import start

WIDTH = 8


@pytest.fixture
def area(spark):
    return ManifestArea(scratch_dir(spark, "manifest"))


def offsets(frame, *more):
    return sorted(tuple(row) if more else row[0] for row in frame.select("kafka_offset", *more).collect())


def staged(spark, area, version=None):
    return offsets(manifest.read_staging(spark, area, versions.head(spark, area, version)))


def test_one_of_many_makes_the_file(spark, tmp_path):
    path = f"{tmp_path}/one.json"
    assert [put_if_absent(spark, path, f"text {n}") for n in range(4)] == [True, False, False, False]
    assert read_text(spark, path) == "text 0"
    assert [name for name in children(spark, str(tmp_path)) if not name.startswith(".")] == ["one.json"]


def test_an_empty_area_and_an_empty_batch(spark, area):
    assert staged(spark, area) == [] and versions.state(spark, area).count() == 0
    assert manifest.stage_log(log(spark, []), area, WIDTH, NOW) is None
    assert staged(spark, area) == [] and manifest.changes(spark, area, 0).count() == 0
    assert manifest.read_object(spark, area, "ingestion-events/dt=2031-05-21/0-0-7.parquet").count() == 0


def test_a_batch_that_was_not_published_shows_nothing(spark, area, monkeypatch):
    manifest.stage_log(log(spark, range(5)), area, WIDTH, NOW)
    before = versions.head(spark, area).number

    def lost(*_):
        raise ConnectionError("driver lost")

    for step in ("_write", "_describe"):
        with monkeypatch.context() as broken:
            broken.setattr(manifest, step, lost)
            with pytest.raises(ConnectionError):
                manifest.stage_batch(log(spark, range(3, 20)), 1, area, WIDTH, None, NOW)
        assert staged(spark, area) == [0, 1, 2, 3, 4]
    lease = versions.claim(spark, area, "batch")
    manifest.prepare_batch(log(spark, range(3, 20)), 1, area, WIDTH, lease, NOW)
    assert staged(spark, area) == [0, 1, 2, 3, 4] and staged(spark, area, before) == [0, 1, 2, 3, 4]
    manifest.stage_batch(log(spark, range(3, 20)), 1, area, WIDTH, lease, NOW)
    assert staged(spark, area) == list(range(20))


def test_a_replayed_batch_is_published_once(spark, area):
    lease = versions.claim(spark, area, "stream")
    first = manifest.stage_batch(log(spark, range(10)), 4, area, WIDTH, lease, NOW)
    assert manifest.stage_batch(log(spark, range(10)), 4, area, WIDTH, lease, NOW) is None
    # Another content under the same number is a batch of its own.
    second = manifest.stage_batch(log(spark, range(11)), 4, area, WIDTH, lease, NOW)
    assert (first.records, first.uploads, first.commits, first.partial_uploads) == (10, 2, 1, 1)
    assert (second.records, second.uploads) == (3, 1) and staged(spark, area) == list(range(11))


def test_a_replaced_writer_can_finish_nothing(spark, area):
    old = versions.claim(spark, area, "old")
    manifest.stage_batch(log(spark, range(3)), 0, area, WIDTH, old, NOW)
    late = manifest.prepare_batch(log(spark, range(3, 30)), 1, area, WIDTH, old, NOW)
    new = versions.claim(spark, area, "new")
    with pytest.raises(versions.Fenced):
        manifest.commit_batch(spark, area, late)
    with pytest.raises(versions.Fenced):
        manifest.prepare_batch(log(spark, range(3, 30)), 1, area, WIDTH, old, NOW)
    with pytest.raises(versions.Fenced):
        manifest.retile(spark, area, 5, old)
    manifest.stage_batch(log(spark, range(3, 9)), 0, area, WIDTH, new, NOW)
    with pytest.raises(versions.Fenced):
        manifest.commit_batch(spark, area, late)
    assert staged(spark, area) == list(range(9))
    assert [r.commit_offset for r in versions.frontier(spark, area).collect()] == [8]


def test_of_two_calls_with_one_lease_one_is_published(spark, area):
    lease = versions.claim(spark, area, "twin")
    both = [manifest.prepare_batch(log(spark, range(n, n + 4)), n, area, WIDTH, lease, NOW) for n in (0, 20)]
    manifest.commit_batch(spark, area, both[1])
    with pytest.raises(RuntimeError, match="another call"):
        manifest.commit_batch(spark, area, both[0])
    assert staged(spark, area) == [20, 21, 22, 23]


def test_ranges_keep_their_first_date_and_rows_their_first_stamp(spark, area):
    manifest.stage_log(log(spark, [0, 1]), area, WIDTH, NOW)
    manifest.stage_log(log(spark, [1, 2, 9]), area, WIDTH, NOW + timedelta(days=1))
    rows = manifest.read_staging(spark, area).withColumn("day", F.date_format("ingested_at", "dd"))
    assert offsets(rows, "dt", "day") == [
        (0, "2031-05-21", "21"), (1, "2031-05-21", "21"), (2, "2031-05-21", "22"), (9, "2031-05-22", "22"),
    ]
    name = "ingestion-events/dt=2031-05-21/0-0-7.parquet"
    assert offsets(manifest.read_object(spark, area, name)) == [0, 1, 2]
    assert manifest.read_object(spark, area, name.replace("-21", "-22")).count() == 0


def test_random_deliveries_lose_and_repeat_nothing(spark, area):
    dice = random.Random(11)
    sent, appeared = set(), Counter()
    versions_seen = {}
    for number in range(6):
        batch = [(dice.choice([0, 1]), dice.randrange(60)) for _ in range(dice.choice([1, 15, 40]))]
        rows = wire(spark, *[message(offset, partition=part) for part, offset in batch])
        before = versions.head(spark, area).number
        manifest.stage_log(rows, area, WIDTH, NOW)
        new = offsets(manifest.changes(spark, area, before), "kafka_partition")
        assert sorted(new) == sorted({(o, p) for p, o in batch} - sent)
        appeared.update(new)
        sent |= {(o, p) for p, o in batch}
        versions_seen[versions.head(spark, area).number] = set(sent)
        if number == 2:
            versions.snapshot(spark, area, versions.head(spark, area))
    for version, then in versions_seen.items():
        frame = manifest.read_staging(spark, area, versions.head(spark, area, version))
        assert offsets(frame, "kafka_partition") == sorted(then)
    assert set(appeared) == sent and set(appeared.values()) == {1}
    state = {(r.partition, r.range_start): r for r in versions.state(spark, area).collect()}
    for part, start in state:
        held = [o for o, p in sent if p == part and o - o % WIDTH == start]
        assert (state[part, start].records, state[part, start].last_offset) == (len(held), max(held))


def test_versions_that_expired_are_gone_and_nothing_else(spark, area):
    for n in range(4):
        manifest.stage_log(log(spark, range(n * 3, n * 3 + 5)), area, WIDTH, NOW)
    lease = versions.claim(spark, area, "left over")
    manifest.prepare_batch(log(spark, [99]), 7, area, WIDTH, lease, NOW)
    now = versions.head(spark, area)
    middle = [v.number for v in versions.versions(spark, area) if v.kind == "batch"][2]
    then = staged(spark, area, middle)
    dropped = versions.expire(spark, area, middle)
    assert len(dropped) >= 2
    assert staged(spark, area, middle) == then and staged(spark, area) == list(range(14))
    assert versions.head(spark, area).number == now.number
    with pytest.raises(ValueError, match="no version"):
        versions.head(spark, area, middle - 1)
    manifest.stage_log(log(spark, range(20)), area, WIDTH, NOW)
    assert staged(spark, area) == list(range(20))


def test_snapshots_come_by_themselves(spark, area, monkeypatch):
    monkeypatch.setattr(manifest.log.snapshot_if_long, "__defaults__", (3,))
    for n in range(4):
        manifest.stage_log(log(spark, [n]), area, WIDTH, NOW)
    head = versions.head(spark, area)
    assert head.snapshot == 6 and len(head.folders) == 1 and staged(spark, area) == [0, 1, 2, 3]


def test_another_width_is_refused_until_the_area_is_retiled(spark, area):
    rows = wire(spark, *[message(o, partition=p) for p in (0, 1) for o in range(1, 45, 2)])
    manifest.stage_log(rows.where("offset < 10"), area, WIDTH, NOW + timedelta(days=1))
    manifest.stage_log(rows, area, WIDTH, NOW + timedelta(days=2))
    with pytest.raises(ValueError, match="ranges of 8 offsets"):
        manifest.stage_log(rows, area, 12, NOW)
    before = versions.head(spark, area)
    committed = {r.kafka_partition: r.commit_offset for r in versions.frontier(spark, area).collect()}
    for width in (12, 3, 64):
        manifest.retile(spark, area, width)
        state = versions.state(spark, area).collect()
        assert sum(r.records for r in state) == 44 and {r.range_end - r.range_start + 1 for r in state} == {width}
        assert offsets(manifest.read_staging(spark, area), "kafka_partition") == [(o, p) for o in range(1, 45, 2) for p in (0, 1)]
    assert manifest.retile(spark, area, 64) is None
    # The first date of what a range joins, and no row appears anew.
    assert {r.dt for r in versions.state(spark, area).collect()} == {"2031-05-22"}
    assert manifest.changes(spark, area, before.number).count() == 0
    assert committed == {0: 40, 1: 40}
    manifest.stage_log(log(spark, range(50)), area, 64, NOW)
    assert len(offsets(manifest.read_staging(spark, area))) == 50 + 22
    assert len(staged(spark, area, before.number)) == 44


def test_settled_ranges_are_published_whole(spark, area):
    published = ManifestArea(scratch_dir(spark, "published"))
    quiet = NOW - timedelta(minutes=1)
    manifest.stage_log(log(spark, [0, 1, 9]), area, WIDTH, NOW)
    manifest.publish_settled(spark, area, published, quiet)
    assert staged(spark, published) == [0, 1] == offsets(manifest.read_settled(spark, area, quiet))
    assert manifest.publish_settled(spark, area, published, quiet) is None
    manifest.stage_log(log(spark, [2, 10, 15]), area, WIDTH, NOW)
    before = versions.head(spark, published).number
    manifest.publish_settled(spark, area, published, quiet)
    assert staged(spark, published) == [0, 1, 2, 9, 10, 15]
    assert offsets(manifest.changes(spark, published, before)) == [2, 9, 10, 15]
    manifest.stage_log(log(spark, [16]), area, WIDTH, NOW)
    manifest.publish_settled(spark, area, published, NOW)
    assert staged(spark, published) == [0, 1, 2, 9, 10, 15, 16]


def test_only_files_with_the_ranges_are_opened(spark, area):
    for n in range(6):
        manifest.stage_log(log(spark, range(n * WIDTH, (n + 1) * WIDTH)), area, WIDTH, NOW)
    entries = versions.live_entries(spark, area, versions.head(spark, area)).where("range_start = 16")
    rows = manifest.read_ranges(spark, area, entries)
    named = manifest.read_object(spark, area, "ingestion-events/dt=2031-05-21/0-16-23.parquet")
    for found in (rows, named):
        assert len([path for path in found.inputFiles() if "/data/" in path]) == 1
        assert offsets(found) == list(range(16, 24))


def test_a_stream_goes_on_where_its_former_run_ended_and_replaces_it(spark, area, tmp_path):
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")
    counted = {}
    for part in (range(6), range(4, 13)):
        log(spark, part).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(WIRE).parquet(inbox)
        start(stream, area, checkpoint, WIDTH, drain=True, now=NOW, on_batch=counted.__setitem__).awaitTermination()
    assert staged(spark, area) == list(range(13))
    assert counted == {0: {"records": 6, "malformed": 0}, 1: {"records": 9, "malformed": 0}}
    batches = [v for v in versions.versions(spark, area) if v.kind == "batch"]
    assert [v.epoch for v in batches] == [1, 2] and len({v.writer for v in batches}) == 1
    sums = versions.counters(spark, area).agg(F.sum("commits"), F.sum("uploads")).first()
    assert tuple(sums) == (1, 3)


def test_a_feed_brings_each_row_once_also_over_a_change_of_width(spark, area, tmp_path):
    def look_in():
        feed = read_changes(spark, area).writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
        query = feed.format("parquet").start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()
        return offsets(spark.read.parquet(str(tmp_path / "out")))

    manifest.stage_log(log(spark, [1, 2, 9]), area, WIDTH, NOW)
    assert look_in() == [1, 2, 9]
    manifest.stage_log(log(spark, [2, 3]), area, WIDTH, NOW)
    manifest.stage_log(log(spark, [10]), area, WIDTH, NOW)
    manifest.retile(spark, area, 5)
    manifest.stage_log(log(spark, [4, 30]), area, 5, NOW)
    assert look_in() == [1, 2, 3, 4, 9, 10, 30]
    assert look_in() == [1, 2, 3, 4, 9, 10, 30]


def test_what_a_feed_plans_does_not_grow_with_the_ranges(spark, area):
    """The driver holds a line per file, whatever is in it."""

    def planned():
        reader = ChangeReader(area.root, 0)
        return reader.partitions(reader.initialOffset(), reader.latestOffset())

    manifest.stage_log(log(spark, range(0, 4_000, 40)), area, WIDTH, NOW)
    manifest.stage_log(log(spark, range(1, 4_000, 80)), area, WIDTH, NOW)
    files = planned()
    assert len(files) == sum(name.endswith(".parquet") for f in children(spark, area.data) for name in children(spark, f"{area.data}/{f}"))
    assert all(len(pickle.dumps(file)) < 600 for file in files)
    seen = Counter(offset for file in files for batch in ChangeReader(area.root, 0).read(file) for offset in batch["kafka_offset"].to_pylist())
    assert seen == Counter([*range(0, 4_000, 40), *range(1, 4_000, 80)])


def test_ranges_written_again_are_joined_with_nothing(spark, area, monkeypatch):
    """Rows held come from files that also hold older copies, and ranges the batch does not touch or add to."""
    frames = []
    write = manifest._write
    monkeypatch.setattr(manifest, "LIVE_RANGES", 0)
    monkeypatch.setattr(manifest, "_write", lambda rows, *where: (frames.append(rows), write(rows, *where)))
    manifest.stage_log(log(spark, range(0, 64, 2)), area, WIDTH, NOW)
    manifest.stage_log(log(spark, [1, 17, 41]), area, WIDTH, NOW + timedelta(days=1))
    version = manifest.stage_log(log(spark, [1, 3, 8, 40, 43, 70]), area, WIDTH, NOW + timedelta(days=2))
    assert "Join" not in frames[-1]._jdf.queryExecution().executedPlan().toString()
    assert (version.records, version.uploads) == (5, 3)
    assert staged(spark, area) == sorted([*range(0, 64, 2), 1, 17, 41, 3, 43, 70])
    days = dict(offsets(manifest.read_staging(spark, area), "dt"))
    assert {days.pop(70)} == {"2031-05-23"} and set(days.values()) == {"2031-05-21"}


def test_tasks_follow_the_rows_held_too(spark, area, monkeypatch):
    frames = []
    write = manifest._write
    monkeypatch.setattr(staging, "ROWS_PER_TASK", 4)
    monkeypatch.setattr(manifest, "_write", lambda rows, *where: (frames.append(rows), write(rows, *where)))
    manifest.stage_log(log(spark, range(0, 120, 2)), area, WIDTH, NOW)
    manifest.stage_log(log(spark, range(1, 120, 8)), area, WIDTH, NOW)
    assert [frame.rdd.getNumPartitions() for frame in frames] == [15, 19]
    assert staged(spark, area) == sorted([*range(0, 120, 2), *range(1, 120, 8)])


def data_files(frame):
    return [path for path in frame.inputFiles() if "/data/" in path]


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def test_a_trace_opens_the_files_that_may_hold_the_ids(spark, area):
    for n in range(5):
        manifest.stage_log(log(spark, range(n * WIDTH, n * WIDTH + 7)), area, WIDTH, NOW)
    manifest.stage_log(wire(spark, message(50, value="{"), message(51, value=None)), area, WIDTH, NOW)
    assert len(row_index.build(spark, area)) == 6 and row_index.build(spark, area) == []
    found = row_index.trace(spark, area, ids(spark, "item-9", "item-34", "item-34", "nobody", None))
    assert offsets(found) == [9, 34] and len(data_files(found)) == 2
    assert row_index.trace(spark, area, ids(spark, "nobody")).count() == 0
    assert row_index.trace(spark, area, ids(spark).limit(0)).count() == 0
    # A range that was written again is found where it is now, and files without an index are opened.
    manifest.stage_log(log(spark, range(16, 24)), area, WIDTH, NOW)
    again = row_index.trace(spark, area, ids(spark, "item-17", "item-0"))
    assert offsets(again) == [0, 17] and len(data_files(again)) == 2
    row_index.build(spark, area)
    again = row_index.trace(spark, area, ids(spark, "item-0"))
    assert offsets(again) == [0] and len(data_files(again)) == 1
    manifest.retile(spark, area, 16)
    assert offsets(row_index.trace(spark, area, ids(spark, "item-17"))) == [17]


def test_no_id_is_missed_in_files_of_many_blocks(spark, area):
    rows = spark.range(20_000).selectExpr(
        "'ingestion-events' AS topic", "0 AS partition", "id AS offset", "timestamp_seconds(id) AS timestamp", "0 AS timestampType",
        """CAST(concat('{"event_id":"e', id, '","gateway_id":"g","received_at":"x","payload":1}') AS BINARY) AS value""",
    )
    manifest.stage_log(rows, area, 5000, NOW)
    row_index.build(spark, area)
    every = spark.range(0, 20_000, 3).selectExpr("concat('e', id) AS event_id")
    assert row_index.trace(spark, area, every).count() == every.count()
    strangers = spark.range(20_000).selectExpr("concat('stranger', id) AS event_id")
    files = log_entries(spark, area).select("file").distinct().count()
    assert row_index.candidates(spark, area, strangers).count() < 0.03 * 20_000 * files


def log_entries(spark, area):
    return versions.live_entries(spark, area, versions.head(spark, area), "folder", "file")


def test_a_path_of_a_shredded_payload_is_a_column_of_its_own(spark):
    area, plain = (ManifestArea(scratch_dir(spark, "fields"), shredded=shredded) for shredded in (True, False))
    payloads = [{"level": 1, "deep": {"x": "a"}}, {"level": 2}, {"level": "two"}, [1], None, {"level": 3, "deep": {"x": 5}}]
    rows = wire(spark, *[message(o, envelope(o, payload=p)) for o, p in enumerate(payloads)], message(9, "{"))
    for target in (area, plain):
        manifest.stage_log(rows, target, WIDTH, NOW)
        manifest.stage_log(log(spark, [6, 20]), target, WIDTH, NOW)
    fields = {"n": ("$.level", "bigint"), "x": ("$.deep.x", "string")}
    got = manifest.read_fields(spark, area, **fields)
    theirs = manifest.read_fields(spark, plain, **fields)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, theirs.collect()))
    assert [r.n for r in got.orderBy("kafka_offset").collect()] == [1, 2, None, None, None, 3, 6, None, 20]
    plan = got.select("n")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "fields#" in line]
    assert scans and all("fields:struct<0:bigint>" in line and "payload" not in line for line in scans)
    assert staged(spark, area) == staged(spark, plain)
    with pytest.raises(ValueError, match="shredded"):
        manifest.stage_log(rows, ManifestArea(area.root), WIDTH, NOW)
