"""What the plans must not lose: one read of the log, narrow reads, no Python, no cross join."""

import re

import pytest
from comparison import TESTDATA

from tidemark.operators import audit, ranges
from tidemark.operators.records import parse_envelope, records_of, staging_rows
from tidemark.plans.log_queries import QUERIES
from tidemark.schema import WIRE
from tidemark.session import scratch_dir
from tidemark.sinks.area import StagingArea
from tidemark.sinks.staging import read_staging, stage_log
from tidemark.sources.event_log import event_log

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    """The log as a table, with broadcasts off as for sides too large for them."""
    path = scratch_dir(spark, "wire")
    event_log(spark, SF).select(*WIRE.fieldNames()).write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield records_of(spark.read.schema(WIRE).parquet(path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "operator",
    [
        lambda log: ranges.range_status(log, 50),
        lambda log: ranges.range_tiling(ranges.range_summary(log, 50), 50),
        lambda log: ranges.consumer_lag(log, 50),
        lambda log: ranges.commit_frontier(ranges.range_summary(log, 50)),
        audit.offset_gaps,
    ],
)
def test_the_log_is_read_once_and_without_its_values(stored, operator):
    plan = final_plan(operator(stored))
    assert plan.count("FileScan") == 1
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "value" not in schema


def test_rows_are_counted_before_they_are_shuffled(stored):
    plan = final_plan(ranges.range_summary(stored, 50))
    assert plan.index("partial_count") > plan.index("Exchange")


def test_row_windows_are_not_per_log_partition(stored):
    """The widest shuffle is on the block as well, so a hot partition is spread."""
    plan = final_plan(audit.offset_gaps(stored))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("__block" in k for k in keys)


def test_the_document_is_parsed_once(stored):
    for filtered in ("malformed", "NOT malformed AND received_at IS NULL"):
        plan = final_plan(parse_envelope(stored).where(filtered).select("kafka_offset", "malformed_reason"))
        assert plan.count("parseJson") == 1


def test_parsing_fits_compiled_methods(spark, stored):
    """The JVM compiles no method of more than 8000 bytes of code."""
    plan = staging_rows(parse_envelope(stored), ranges.F.lit("2031-05-21 16:20:00"))._jdf.queryExecution()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan.executedPlan()))
    assert sizes and max(map(int, sizes)) < 8000


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def test_range_filters_prune_folders(spark):
    area = StagingArea(scratch_dir(spark, "area"))
    stage_log(event_log(spark, SF), area, 50)
    rows = read_staging(spark, area).where("range_start = 50 AND malformed").select("kafka_offset")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*range_start", plan)
    assert re.search(r"PushedFilters: \[[^\]]*malformed", plan)
    assert "ReadSchema: struct<kafka_offset:bigint,malformed:boolean>" in plan
