"""Runs a Spark query and its SQL on the same tables and compares the rows."""

import glob
import os

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def duckdb_on(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(([repr(row[i]) for i in order] for row in rows))


def compare(spark, con, query, sql, sf_dir):
    frame = query(spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    result = con.execute(sql)
    theirs = rows_of([c[0] for c in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    return len(ours[1])
