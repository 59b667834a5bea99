"""Every registered query against its SQL on the smallest tables."""

import pytest
from comparison import TESTDATA, compare, duckdb_on

import __spark_entry__ as entry_points

SF = f"{TESTDATA}/sf0.001"
# The queries of the subpackage `llm` have tests of their own.
QUERIES = {name: query for name, query in entry_points.queries().items() if name not in entry_points.LLM_QUERIES}
ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name not in entry_points.LLM_ORACLE}


@pytest.fixture(scope="module")
def con():
    return duckdb_on(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], SF) > 0


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.count() == 28


def test_known_counts_of_the_derived_log(spark):
    """Counts of the log at this scale that were established apart from any query here."""
    status = {r.outcome: r["count"] for r in QUERIES["range_status"](spark, SF).groupBy("outcome").count().collect()}
    assert status == {"committed": 10, "open": 18}
    stats = QUERIES["ingest_stats"](spark, SF).first()
    assert (stats.records, stats.malformed, stats.commits) == (994, 35, 10)
    assert sum(r.records for r in QUERIES["received_at_nulls"](spark, SF).collect()) == 14
    assert sum(r.records for r in QUERIES["auth_mix"](spark, SF).collect() if not r.has_header) == 636
    assert QUERIES["overlapping_ranges"](spark, SF).count() == 4
    assert QUERIES["split_ranges"](spark, SF).count() == 18
    assert QUERIES["duplicate_offsets"](spark, SF).count() == 425
    assert QUERIES["log_vs_staging"](spark, SF).count() == 5
    assert QUERIES["staged_dedup"](spark, SF).count() == 989
