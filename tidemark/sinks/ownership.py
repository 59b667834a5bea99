"""One writer at a time: who is staging into an area.

A claim is an empty folder named after the writer, its Spark application and the call. It is
made before the other claims are listed, so of two that begin together at least one sees the
other and gives way.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.sinks.area import StagingArea, children, delete, make_folder


@contextmanager
def held(spark: SparkSession, area: StagingArea, writer: str) -> Iterator[None]:
    """Holds `area` for `writer`, or fails if someone else does.

    A claim that the same writer left in another application is that of a driver that was
    lost, and is taken over. One of another writer stays until `release`.
    """
    application = spark.sparkContext.applicationId
    mine = f"{writer}.{application}.{uuid.uuid4().hex}"
    make_folder(spark, f"{area.claims}/{mine}")
    try:
        for other in children(spark, area.claims):
            if other == mine:
                continue
            name, where, _ = other.rsplit(".", 2)
            if name != writer or where == application:
                raise RuntimeError(f"staging area {area.root} is held by {name} of {where}")
            delete(spark, f"{area.claims}/{other}")
        yield
    finally:
        delete(spark, f"{area.claims}/{mine}")


def release(spark: SparkSession, area: StagingArea) -> None:
    """Drop all claims, once their writers are known to be gone."""
    for claim in children(spark, area.claims):
        delete(spark, f"{area.claims}/{claim}")
