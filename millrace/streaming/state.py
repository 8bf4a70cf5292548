"""Per-key processors with named state stores, for streams and batches alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.runner import use_rocksdb

COUNTS = "key string, start timestamp, count bigint, total bigint"


class KeyAndWindowStores(StatefulProcessor):
    """Keeps a total per key in the store "my-store" and a count per key and window start in
    "other-store", whose entries expire after the retention time.

    Takes rows (key, start, count) and gives back each touched window with its count and the key's
    total. Rows of a key are streamed through; only the windows of one call are held in memory."""

    def __init__(self, retention_ms: int | None = None):
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("my-store", "total bigint")
        self.windows = handle.getMapState("other-store", "start timestamp", "count bigint", self.retention_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total = self.total.get()[0] if self.total.exists() else 0
        touched: dict = {}
        for part in rows:
            total += int(part["count"].sum())
            for start, count in part.groupby("start")["count"].sum().items():
                touched[start] = touched.get(start, 0) + int(count)
        for start, count in touched.items():
            before = self.windows.getValue((start,))[0] if self.windows.containsKey((start,)) else 0
            touched[start] = before + count
            self.windows.updateValue((start,), (before + count,))
        self.total.update((total,))
        yield pd.DataFrame({"key": key[0], "start": list(touched), "count": list(touched.values()), "total": total})

    def close(self) -> None:
        pass


def counted_in_task(batches: Iterator[pa.RecordBatch], most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Rows (key, start, count) of a task added up by key and start; the map is emptied at `most` entries."""
    total: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if total is None else pa.concat_tables([total, rows])
        added = rows.group_by(["key", "start"]).aggregate([("count", "sum")]).rename_columns({"count_sum": "count"})
        total = added.select(batch.schema.names).cast(batch.schema)
        if total.num_rows > most:
            yield from total.to_batches()
            total = None
    if total is not None:
        yield from total.to_batches()


def count_in_stores(df: DataFrame, size: str, retention_ms: int | None = None) -> DataFrame:
    """Run the processor over envelopes.

    Rows are added up by key and window within each task before they are exchanged, on a stream in maps over Arrow
    batches, so a hot key reaches its processor as one row for each task and window instead of as all of its events."""
    use_rocksdb(df.sparkSession)
    start = F.window("timestamp", size)["start"].alias("start")
    if df.isStreaming:
        slim = df.select("key", start, F.lit(1).cast("bigint").alias("count"))
        slim = slim.mapInArrow(counted_in_task, slim.schema)
    else:
        slim = df.groupBy("key", start).agg(F.count(F.lit(1)).alias("count"))
    return slim.groupBy("key").transformWithStateInPandas(
        KeyAndWindowStores(retention_ms), outputStructType=COUNTS, outputMode="Update",
        timeMode="ProcessingTime" if retention_ms else "None")
