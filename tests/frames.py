"""Small logs for tests."""

import json
from datetime import datetime, timezone

from tidemark.schema import WIRE

STAMP = datetime(2031, 5, 21, 15, 7, 31, 123000, tzinfo=timezone.utc)
NOW = datetime(2031, 5, 21, 16, 20, tzinfo=timezone.utc)


def envelope(n, **changes):
    body = {
        "event_id": f"item-{n}",
        "gateway_id": "edge-7",
        "received_at": "2031-05-21T16:20:00Z",
        "payload": {"level": n},
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def message(offset, value="", topic="ingestion-events", partition=0, stamp=STAMP):
    if value == "":
        value = envelope(offset)
    raw = value.encode() if isinstance(value, str) else value
    return (topic, partition, offset, stamp, 0 if stamp else -1, raw)


def log(spark, offsets, **where):
    return spark.createDataFrame([message(o, **where) for o in offsets], WIRE)


def wire(spark, *messages):
    return spark.createDataFrame(list(messages), WIRE)
