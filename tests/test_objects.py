import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import NOW, log, message, wire

from tidemark.schema import STAGING
from tidemark.session import scratch_dir
from tidemark.sinks.area import ObjectArea, StagingArea
from tidemark.sinks import objects as sinks_objects
from tidemark.sinks.objects import publish_objects, read_objects
from tidemark.sinks.staging import read_batch, read_staging, stage_log


@pytest.fixture
def area(spark):
    return StagingArea(scratch_dir(spark, "area"))


def objects(root):
    from pathlib import Path

    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if p.is_file())


def test_names_types_and_overwrite(spark, area):
    root = f"{area.root}/objects"
    stage_log(log(spark, range(7)), area, 5, now=NOW)
    publish_objects(read_staging(spark, area), root, 5)
    names = ["ingestion-events/dt=2031-05-21/0-0-4.parquet", "ingestion-events/dt=2031-05-21/0-5-9.parquet"]
    assert objects(root) == names
    file = pq.ParquetFile(f"{root}/{names[0]}")
    assert file.schema_arrow.names == STAGING.fieldNames()
    assert file.schema_arrow.field("kafka_timestamp").type == pa.timestamp("ms", "UTC")
    assert file.schema_arrow.field("ingested_at").type == pa.timestamp("us", "UTC")
    assert [f.nullable for f in file.schema_arrow] == [f.nullable for f in STAGING]
    assert file.metadata.row_group(0).column(0).compression == "ZSTD"
    stage_log(log(spark, [7, 8]), area, 5, now=NOW)
    publish_objects(read_staging(spark, area), root, 5)
    assert objects(root) == names
    assert pq.read_table(f"{root}/{names[1]}").column("kafka_offset").to_pylist() == [5, 6, 7, 8]


def test_rows_come_back(spark, area):
    root = f"{area.root}/objects"
    rows = wire(spark, *[message(n, partition=n % 3) for n in range(500)], message(500, value="x", stamp=None))
    stage_log(rows, area, 20, now=NOW)
    staged = read_staging(spark, area).select(*STAGING.fieldNames())
    publish_objects(read_staging(spark, area), root, 20)
    published = read_objects(spark, root)
    assert published.select("part", "range_start").distinct().count() == len(objects(root))
    assert published.where("dt = '2031-05-22'").count() == 0
    back = published.select(*STAGING.fieldNames())
    assert back.exceptAll(staged).count() == staged.exceptAll(back).count() == 0


def test_an_object_larger_than_a_row_group(spark, area, monkeypatch):
    """What a task holds does not grow with the range."""
    monkeypatch.setattr(sinks_objects, "ROW_GROUP_BYTES", 1 << 16)
    root = f"{area.root}/objects"
    rows = spark.range(30_000).selectExpr(
        "'ingestion-logs' topic", "2 partition", "id offset", "timestamp_millis(id) timestamp", "0 timestampType",
        """encode(concat('{"event_id":"', id, '","gateway_id":"g","received_at":"r","payload":', id, '}'), 'utf-8') value""",
    )
    stage_log(rows, area, 40_000, now=NOW)
    publish_objects(read_staging(spark, area), root, 40_000)
    (name,) = objects(root)
    file = pq.ParquetFile(f"{root}/{name}")
    groups = [file.metadata.row_group(n).num_rows for n in range(file.metadata.num_row_groups)]
    assert sum(groups) == 30_000 and len(groups) > 2
    assert file.read(["kafka_offset"]).column(0).to_pylist() == list(range(30_000))


def test_objects_of_ranges_are_opened_by_their_names(spark):
    """What a batch reads back costs no listing and no set-up of Spark's reader per object."""
    area = ObjectArea(scratch_dir(spark, "named"))
    rows = wire(spark, *[message(n, partition=n % 3) for n in range(90)], message(90, value="x", stamp=None))
    stage_log(rows, area, 20, now=NOW)
    ranges = read_staging(spark, area).where("part < 2").selectExpr("topic", "dt", "part", "range_start", "range_start + 19 range_end")
    gone = ranges.limit(1).selectExpr("topic", "dt", "part", "range_start + 2000 range_start", "range_end + 2000 range_end")
    found = read_batch(spark, area, ranges.unionByName(gone))
    wanted = read_staging(spark, area).where("part < 2")
    assert "FileScan" not in read_batch(spark, area, spark.createDataFrame(ranges.collect(), ranges.schema))._jdf.queryExecution().executedPlan().toString()
    assert found.columns == wanted.columns and found.count() == wanted.count() > 50
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
    few = read_batch(spark, area, ranges, "part", "kafka_offset")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, wanted.select("kafka_offset", "part").collect()))
