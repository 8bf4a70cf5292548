"""Holding rows of a stream until they are due."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.changing import _packed, _unpacked
from millrace.streaming.runner import use_rocksdb


class HeldRows(StatefulProcessor):
    """Rows by the tick at which they are due, a timer for each tick that has some."""

    def __init__(self, tick_ms: int):
        self.tick_ms = tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "tick bigint", "bodies array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        ready, later = [], {}
        for part in rows:
            for due, body in zip(part["due"].tolist(), part["body"].tolist()):
                if body is None:  # a beat of the clock
                    continue
                if due <= now:
                    ready.append(body)
                else:
                    later.setdefault(-(-int(due) // self.tick_ms) * self.tick_ms, []).append(body)
        for tick, bodies in later.items():
            before = list(self.held.getValue((tick,))[0]) if self.held.containsKey((tick,)) else []
            if not before:
                self.handle.registerTimer(tick)
            self.held.updateValue((tick,), (before + bodies,))
        yield pd.DataFrame({"body": ready}, dtype="object")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick = expiredTimerInfo.getExpiryTimeInMs()
        bodies = list(self.held.getValue((tick,))[0]) if self.held.containsKey((tick,)) else []
        self.held.removeKey((tick,))
        yield pd.DataFrame({"body": bodies}, dtype="object")

    def close(self) -> None:
        pass


def hold_until(df: DataFrame, due: Column, slots: int = 64, tick_ms: int = 1000) -> DataFrame:
    """Let each row of a stream through when the time `due` has come, at the next full tick; rows that are due already,
    or have no such time, at once. Append mode, with a trigger by processing time.

    Rows wait in the state store, so none is lost when a query is restarted, and are spread over `slots` groups,
    whatever their keys. Spark runs no batch after a restart until there is input, so a row a second from its `rate`
    source keeps the clock going. In batch, `sinks.outputs.due` is the filter for it; a retry after a back-off is a row that is
    held until then and sent again, instead of a task that sleeps."""
    use_rocksdb(df.sparkSession)
    body = _packed(df, df.columns)
    rows = df.select(F.coalesce(F.unix_millis(due), F.lit(0)).alias("due"), body.alias("body"), F.pmod(F.xxhash64(body), F.lit(slots)).alias("slot"))
    beats = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    rows = rows.unionByName(beats.select(F.lit(0).cast("bigint").alias("due"), F.lit(None).cast("string").alias("body"), (F.col("value") % slots).alias("slot")))
    held = rows.groupBy("slot").transformWithStateInPandas(HeldRows(tick_ms), outputStructType="body string", outputMode="Append", timeMode="ProcessingTime")
    return held.select(_unpacked(F.col("body"), df, df.columns).alias("_row")).select("_row.*")
