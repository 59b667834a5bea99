"""Ranges held back in state until they are complete or quiet.

The other way to keep fresh partial ranges from readers is `sinks.manifest.publish_settled`, which
holds them in files. Here they are held in the state of the stream, range by range, so a hot log
partition is as many keys as it has open ranges, and a range is let go at once when its last offset
is there. The state is in the checkpoint and outlives the driver and every executor.
"""

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import check_width, range_end, range_start
from tidemark.schema import IDLE_MS, WIRE

if TYPE_CHECKING:
    import pandas as pd

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["topic", "partition", "range_start"]
MESSAGE = ["offset", "timestamp", "timestampType", "value"]
HELD = T.StructType([WIRE[name] for name in MESSAGE])
RELEASED = T.StructType([*WIRE.fields, T.StructField("released", T.StringType())])


class HeldRange(StatefulProcessor):
    """One range: its messages so far, and a timer that each arrival sets anew.

    A range that was let go and gets more messages is held again by itself; staging merges the two.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", HELD)

    def handleInputRows(self, key: tuple, rows: Iterator["pd.DataFrame"], timerValues) -> Iterator["pd.DataFrame"]:
        import pandas as pd

        complete, arrived = False, []
        for frame in rows:
            complete = complete or bool((frame["offset"] >= frame["range_end"]).any())
            arrived.append(frame[MESSAGE])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if complete:
            yield self._let_go(key, "complete", arrived)
        else:
            messages = pd.concat(arrived).itertuples(index=False, name=None)
            self.messages.appendList([tuple(None if pd.isna(value) else value for value in m) for m in messages])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator["pd.DataFrame"]:
        if self.messages.exists():
            yield self._let_go(key, "idle", [])

    def _let_go(self, key: tuple, why: str, arrived: list["pd.DataFrame"]) -> "pd.DataFrame":
        import pandas as pd

        held = [pd.DataFrame(list(self.messages.get()), columns=MESSAGE)] if self.messages.exists() else []
        self.messages.clear()
        rows = pd.concat([frame.astype(object) for frame in [*held, *arrived]], ignore_index=True)
        rows = rows.assign(topic=key[0], partition=key[1], released=why)
        rows["timestamp"] = pd.to_datetime(rows["timestamp"])
        return rows[RELEASED.fieldNames()]

    def close(self) -> None:
        """Nothing is open."""


def hold_open_ranges(wire: DataFrame, width: int, idle_ms: int = IDLE_MS) -> DataFrame:
    """The messages of a stream, each when its range is complete or has got nothing for `idle_ms`.

    `released` says which. A range is complete once an offset at its end or beyond is there, as offsets may
    have holes. What comes out can be staged with `streaming.ingest.start`. State holds at most the
    messages of open ranges, and a task at most those of one range at a time.

    Timers need batches to fire in, so such a stream never drains by itself: run it with a processing-time
    trigger and stop it.
    """
    check_width(width)
    spark = wire.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    start = range_start(F.col("offset"), width)
    placed = wire.select(*WIRE.fieldNames(), start.alias("range_start"))
    placed = placed.withColumn("range_end", range_end(F.col("range_start"), width))
    return placed.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=HeldRange(idle_ms), outputStructType=RELEASED, outputMode="append", timeMode="ProcessingTime"
    )
