"""Continuous staging: micro-batches of a log stream through `stage_batch`."""

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.schema import IDLE_MS, RANGE_WIDTH
from tidemark.session import configure
from tidemark.sinks import ledger, manifest, versions
from tidemark.sinks.area import ManifestArea, StagingArea
from tidemark.sinks.staging import Publish, publish_ranges, stage_batch


def start(
    wire: DataFrame,
    area: StagingArea | ManifestArea,
    checkpoint: str,
    width: int = RANGE_WIDTH,
    idle_ms: int = IDLE_MS,
    drain: bool = False,
    now: datetime | None = None,
    publish: Publish = publish_ranges,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Stage a stream until stopped, or until it is drained.

    Every trigger publishes the ranges it touched, so nothing is held back longer than
    `idle_ms` and nothing is buffered at shutdown. There is no watermark and no lateness
    cut: a late message is filed under the date it is written. `on_batch` is told the
    `records` and `malformed` of each batch once it is in the ledger.

    A `ManifestArea` is claimed when the stream starts. From then on no other stream that had it,
    this one's former run included, can publish anything.
    """
    spark = configure(wire.sparkSession)
    # Batch ids start anew with each checkpoint, so the ledger tells checkpoints apart.
    writer = "stream" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    if isinstance(area, ManifestArea):
        versions.check_width(versions.head(spark, area), area, width)
        lease = versions.claim(spark, area, writer)
    else:
        ledger.check_same_width(spark, area, width)

    def stage(batch: DataFrame, batch_id: int) -> None:
        if isinstance(area, ManifestArea):
            version = manifest.stage_batch(batch, batch_id, area, width, lease, now=now, keep=True)
            if version and on_batch is not None:
                on_batch(batch_id, {"records": version.records, "malformed": version.malformed})
            return
        counters = Observation(f"{writer}-{batch_id}")
        staged = stage_batch(
            batch, batch_id, area, width, writer=writer, now=now, publish=publish, keep=True, counters=counters
        )
        if staged and on_batch is not None:
            on_batch(batch_id, counters.get)

    stream = wire.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    if drain:
        return stream.trigger(availableNow=True).start()
    return stream.trigger(processingTime=f"{idle_ms} milliseconds").start()
