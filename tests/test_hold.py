"""Ranges held in the state of a stream."""

import time

from frames import log, message, wire

from tidemark.schema import WIRE
from tidemark.streaming.hold import RELEASED, hold_open_ranges


def run(spark, folder, until, idle_ms, seconds=60):
    """Run the stream over the inbox until `until` of what came out holds, or for `seconds`."""
    held = hold_open_ranges(spark.readStream.schema(WIRE).parquet(f"{folder}/inbox"), 8, idle_ms)
    out = held.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    query = out.trigger(processingTime="100 milliseconds").start(f"{folder}/out")
    deadline = time.monotonic() + seconds
    rows = []
    while time.monotonic() < deadline:
        time.sleep(0.3)
        read = any(p["numInputRows"] for p in query.recentProgress)
        rows = spark.read.schema(RELEASED).parquet(f"{folder}/out").collect()
        if read and until(rows):
            break
    query.stop()
    assert query.exception() is None
    return sorted((r.partition, r.offset, r.released) for r in rows), rows


def test_open_ranges_wait_in_state_over_a_restart(spark, tmp_path):
    inbox = f"{tmp_path}/inbox"
    log(spark, [0, 1, 2, 7, 8, 9]).unionByName(log(spark, [3], partition=1)).coalesce(1).write.parquet(inbox)
    # Offset 7 ends its range at once; the other two ranges stay, far from any timer.
    first, rows = run(spark, tmp_path, lambda rows: len(rows) >= 4, 3_600_000)
    assert first == [(0, offset, "complete") for offset in (0, 1, 2, 7)]
    sent = {r.offset: r for r in log(spark, [0, 1, 2, 7]).collect()}
    assert {r.offset: (r.topic, r.timestamp, r.timestampType, bytes(r.value)) for r in rows} == {
        o: (r.topic, r.timestamp, r.timestampType, bytes(r.value)) for o, r in sent.items()
    }
    # After a restart the held messages are let go with the end of their range; 9 comes twice, as it was sent.
    more = wire(spark, message(9), message(15, stamp=None), message(20, value=None))
    more.coalesce(1).write.mode("append").parquet(inbox)
    second, rows = run(spark, tmp_path, lambda rows: len(rows) >= 9, 1000)
    assert second == first + [(0, 8, "complete"), (0, 9, "complete"), (0, 9, "complete"), (0, 15, "complete"), (0, 20, "idle")]
    by_offset = {r.offset: r for r in rows}
    assert by_offset[15].timestamp is None and by_offset[15].timestampType == -1 and by_offset[20].value is None
