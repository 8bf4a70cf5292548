"""Tables that change while the stream runs: joins by event time, latest values with removals, and stream time by source.

State lives in Spark's state stores, one entry for each key or row; what the processors keep for longer than it can still
matter is taken out by watermark or time to live. Rows pass through the processors as JSON texts of their columns, so
columns of any type come back as they were."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.runner import use_rocksdb

# Times to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _packed(df: DataFrame, columns: Sequence[str]) -> Column:
    # A struct cannot be empty.
    return F.to_json(F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in columns]), _JSON)


def _unpacked(body: Column, df: DataFrame, columns: Sequence[str]) -> Column:
    return F.from_json(body, T.StructType([df.schema[c] for c in columns]), {k: v for k, v in _JSON.items() if k != "ignoreNullFields"})


class AsOfVersions(StatefulProcessor):
    """Holds the versions of a key's table row by event time, and stream rows until the watermark has passed them: then
    no earlier version can come any more, and each goes out with the newest version of its time or before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at bigint, tie bigint, body string")
        self.versions = handle.getListState("versions", "at bigint, tie bigint, body string")
        self.timer = handle.getValueState("timer", "at bigint")

    def _wake(self, micros: int) -> None:
        """One timer for the earliest row that waits."""
        due = -(-micros // 1000)
        if self.timer.exists():
            if self.timer.get()[0] <= due:
                return
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(due)
        self.timer.update((due,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for part in rows:
            entries = list(zip(part["side"].tolist(), part["at"].tolist(), part["tie"].tolist(), part["body"].tolist()))
            for side, state in ((0, self.versions), (1, self.waiting)):
                mine = [(int(at), int(tie), body) for s, at, tie, body in entries if s == side]
                if mine:
                    state.appendList(mine)
                    if side:
                        earliest = min([x[0] for x in mine] + ([] if earliest is None else [earliest]))
        if earliest is not None:
            self._wake(earliest)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        versions, waiting = sorted(self.versions.get()), sorted(self.waiting.get())
        ready, later = [w for w in waiting if w[0] <= now], [w for w in waiting if w[0] > now]
        out, seen = [], -1
        for at, tie, body in ready:
            while seen + 1 < len(versions) and versions[seen + 1][0] <= at:
                seen += 1
            out.append((key[0], at, tie, body, versions[seen][2] if seen >= 0 else None))
        # Rows to come are later than the watermark, so of the versions before it the newest is enough.
        old = [v for v in versions if v[0] <= now]
        if len(old) > 1:
            self.versions.put([old[-1], *[v for v in versions if v[0] > now]])
        if later:
            self.waiting.put(later)
            self._wake(later[0][0])
        else:
            self.waiting.clear()
        yield pd.DataFrame(out, columns=["key", "at", "tie", "body", "version"])

    def close(self) -> None:
        pass


def join_changing_table(
    stream: DataFrame, table: DataFrame, values: Sequence[str], tie_breaker: str, how: str = "left",
    defaults: Mapping[str, object] | None = None, ts: str = "timestamp", key: str = "key", delay: str = "0 seconds", salt: int = 1,
) -> DataFrame:
    """Give each row of a stream the values that a table, itself a stream of its changes, had at the row's own time: what
    `joins.join_asof` gives in batch. Append mode.

    A row comes out when the watermark, `delay` behind the slower of both inputs, has passed it; a change that arrives
    late, but before that, still counts. Changes and rows behind the watermark are dropped. Equal times: changes come
    first, among themselves by `tie_breaker`, a whole number. Rows without key or without an earlier change get nulls,
    or `defaults`; with `how` inner they are left out, as are those whose values are all null. With `salt` > 1 the rows
    of each key are spread over that many tasks, and its changes repeated as often."""
    if how not in ("left", "inner"):
        raise ValueError("a stream joins a table by left or inner join")
    use_rocksdb(stream.sparkSession)
    own = [c for c in stream.columns if c not in (key, ts, tie_breaker)]

    def side(df: DataFrame, n: int, columns: Sequence[str], salts: Column) -> DataFrame:
        rows = df.withWatermark(ts, delay).where(F.col(key).isNotNull())
        return rows.select(F.col(key).cast("string").alias("key"), F.col(ts).alias("ts"), F.lit(n).alias("side"), F.unix_micros(ts).alias("at"),
                           F.col(tie_breaker).cast("bigint").alias("tie"), _packed(df, columns).alias("body"), salts.alias("salt"))

    spread = F.pmod(F.xxhash64(ts, tie_breaker), F.lit(salt))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
    both = side(table, 0, values, every).unionByName(side(stream, 1, own, spread))
    met = both.groupBy("key", "salt").transformWithStateInPandas(
        AsOfVersions(), outputStructType="key string, at bigint, tie bigint, body string, version string", outputMode="Append", timeMode="EventTime")
    rows = met.select(F.col("key").cast(stream.schema[key].dataType).alias(key), F.timestamp_micros("at").cast(stream.schema[ts].dataType).alias(ts),
                      F.col("tie").cast(stream.schema[tie_breaker].dataType).alias(tie_breaker),
                      _unpacked(F.col("body"), stream, own).alias("_own"), _unpacked(F.col("version"), table, values).alias("_seen"))
    rows = rows.select(key, ts, tie_breaker, *[F.col(f"_own.`{c}`") for c in own], *[F.col(f"_seen.`{v}`") for v in values])
    if how == "inner":
        return rows.where(reduce(Column.__or__, [F.col(f"`{v}`").isNotNull() for v in values]))
    keyless = stream.where(F.col(key).isNull()).select(key, ts, tie_breaker, *own, *[F.lit(None).cast(table.schema[v].dataType).alias(v) for v in values])
    rows = rows.unionByName(keyless)
    fill = {c: F.coalesce(F.col(f"`{c}`"), d if isinstance(d, Column) else F.lit(d)) for c, d in (defaults or {}).items()}
    return rows.withColumns(fill) if fill else rows


class LatestValue(StatefulProcessor):
    """Keeps the newest row of each key. A key whose newest row is a tombstone is remembered as removed, so that an older
    row that comes late does not bring it back."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at bigint, tie bigint, body string, removed boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = None
        for r in rows:
            if newest is None or (r.at, r.tie) > newest[:2]:
                newest = (r.at, r.tie, r.body, r.removed)
        held = self.last.get()
        if newest is not None and (held is None or newest[:2] > tuple(held[:2])):
            self.last.update(newest)
            gone = held is None or held[3]
            # What is new, and removals of what was there.
            if not (newest[3] and gone) and (gone or tuple(held[2:4]) != newest[2:]):
                yield Row(key=key[0], body=newest[2], removed=newest[3])

    def close(self) -> None:
        pass


def newest_in_task(batches: Iterator[pa.RecordBatch], most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Of rows (key, at, tie, ...) in a task, the newest of each key only; the map is emptied at `most` keys."""
    held: dict[str, tuple[tuple[int, int], pa.RecordBatch, int]] = {}

    def taken() -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[pa.RecordBatch, list[int]]] = {}
        for _, batch, n in held.values():
            found.setdefault(id(batch), (batch, []))[1].append(n)
        for batch, rows in found.values():
            yield batch.take(pa.array(sorted(rows)))
        held.clear()

    for batch in batches:
        newest: dict[str, tuple[tuple[int, int], int]] = {}
        for n, (k, at, tie) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "at", "tie")))):
            if k not in newest or (at, tie) > newest[k][0]:
                newest[k] = ((at, tie), n)
        kept = batch.take(pa.array(sorted(n for _, n in newest.values()), pa.int64()))
        for n, (k, at, tie) in enumerate(zip(*(kept.column(c).to_pylist() for c in ("key", "at", "tie")))):
            if k not in held or (at, tie) > held[k][0]:
                held[k] = ((at, tie), kept, n)
        if len(held) > most:
            yield from taken()
    yield from taken()


def latest_changes(
    log: DataFrame, columns: Sequence[str] = ("value",), order: tuple[str, str] = ("timestamp", "offset"), ttl_ms: int | None = None,
) -> DataFrame:
    """The changes of a table of latest values, while its log comes in: key, the columns and `removed`, true for a key
    whose newest value is a tombstone after it had one. Update mode; the newest row of each key that came out is the
    table, which `tables.latest` gives in batch.

    Rows that are older than what is known of their key change nothing, and a value that stays as it is does not come
    out again. Null keys are ignored. Rows are reduced to one for each key in the tasks before they are exchanged, so a
    hot key reaches its state as a row for each task. With `ttl_ms` a key that is not written for so long is forgotten,
    without a removal."""
    use_rocksdb(log.sparkSession)
    ts, tie = order
    at = F.unix_micros(ts) if log.schema[ts].dataType == T.TimestampType() else F.col(ts).cast("bigint")
    slim = log.where(F.col("key").isNotNull()).select(
        F.col("key").cast("string").alias("key"), F.coalesce(at, F.lit(-(1 << 62))).alias("at"), F.col(tie).cast("bigint").alias("tie"),
        F.when(F.col("value").isNotNull(), _packed(log, columns)).alias("body"), F.col("value").isNull().alias("removed"))
    few = slim.mapInArrow(newest_in_task, slim.schema)
    changed = few.groupBy("key").transformWithState(
        LatestValue(ttl_ms), outputStructType="key string, body string, removed boolean", outputMode="Update", timeMode="ProcessingTime" if ttl_ms else "None")
    return changed.select(F.col("key").cast(log.schema["key"].dataType).alias("key"), _unpacked(F.col("body"), log, columns).alias("_last"), "removed").select(
        "key", *[F.col(f"_last.`{c}`") for c in columns], "removed")


class StreamTime(StatefulProcessor):
    """Keeps the greatest event time that has arrived from a source. Of a micro-batch it takes the greatest time of each
    slice of arrivals and gives back the greatest time before it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.time = handle.getValueState("stream-time", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        greatest: dict[int, int] = {}
        for part in rows:
            for n, at in part.groupby("slice")["at"].max().items():
                greatest[int(n)] = max(int(at), greatest.get(int(n), int(at)))
        upto = self.time.get()[0] if self.time.exists() else _NEVER
        out = []
        for n in sorted(greatest):
            out.append((*key, n, upto))
            upto = max(upto, greatest[n])
        self.time.update((upto,))
        yield pd.DataFrame(out, columns=[*(f"source{n}" for n in range(len(key))), "slice", "before"])

    def close(self) -> None:
        pass


# The time of rows without one, and the slice of rows without an arrival.
_NEVER, _LAST = -(1 << 62), 1 << 62


def greatest_in_task(batches: Iterator[pa.RecordBatch], most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Rows (sources, slice, at) of a task reduced to the greatest time of each source and slice; emptied at `most` rows."""
    total: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if total is None else pa.concat_tables([total, rows])
        reduced = rows.group_by(batch.schema.names[:-1]).aggregate([("at", "max")]).rename_columns({"at_max": "at"})
        total = reduced.select(batch.schema.names).cast(batch.schema)
        if total.num_rows > most:
            yield from total.to_batches()
            total = None
    if total is not None:
        yield from total.to_batches()


def _flag_slice(rows: pa.Table, grace_us: int) -> pa.Table:
    """body and late of a slice's rows; one row more has the source's time before the slice."""
    told = rows.column("before").is_valid()
    before = pc.max(rows.column("before")).as_py()
    mine = rows.filter(pc.invert(told))
    order = [(c, "ascending") for c in mine.column_names if c.startswith("arrival")]
    mine = mine.take(pc.sort_indices(mine, sort_keys=order, null_placement="at_end"))
    at = mine.column("at").to_numpy()
    upto = np.maximum(np.maximum.accumulate(at), before)
    late = (at != _NEVER) & (at < upto - grace_us)
    return pa.table({"body": mine.column("body"), "late": pa.array(late)})


def flag_late_rows(
    log: DataFrame, arrival: Sequence[Column | str] = ("offset",), source: Sequence[str] = ("destination", "partition"), grace_ms: int = 0, ts: str = "timestamp",
    width: int = 100_000,
) -> DataFrame:
    """Flag the rows of a stream that are older than their source's stream time, the greatest event time that has arrived
    from it so far: what `windows.flag_late` gives in batch, where Spark's watermark is one for the whole query. Append
    mode. A row without a time is not late. Rows of a source arrive in the order of `arrival`, whole numbers, inside a
    micro-batch, and micro-batches one after the other.

    A source's arrivals are cut into slices of `width` of the first number of `arrival`. The processor of a source only
    sees the greatest time of each slice; the rows of a slice are judged in a task of their own, which holds them in
    memory, so let `width` be no more than what fits."""
    use_rocksdb(log.sparkSession)
    keys = [f"source{n}" for n in range(len(source))]
    sources = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in zip(keys, source)]
    order = [(F.col(c) if isinstance(c, str) else c).cast("bigint").alias(f"arrival{n}") for n, c in enumerate(arrival)]
    rows = log.select(*sources, *order, F.coalesce(F.unix_micros(ts), F.lit(_NEVER)).alias("at"), _packed(log, log.columns).alias("body"))
    rows = rows.withColumn("slice", F.coalesce(F.col("arrival0") - F.pmod("arrival0", F.lit(width)), F.lit(_LAST)))
    slim = rows.select(*keys, "slice", "at")
    kinds = ", ".join(f"{k} string" for k in keys)
    before = slim.mapInArrow(greatest_in_task, slim.schema).groupBy(*keys).transformWithStateInPandas(
        StreamTime(), outputStructType=f"{kinds}, slice bigint, before bigint", outputMode="Append", timeMode="None")
    grace_us = grace_ms * 1000

    def flag(group: pa.Table) -> pa.Table:
        return _flag_slice(group, grace_us)

    both = rows.unionByName(before, allowMissingColumns=True)
    seen = both.groupBy(*keys, "slice").applyInArrow(flag, "body string, late boolean")
    return seen.select(_unpacked(F.col("body"), log, log.columns).alias("_row"), "late").select(*[F.col(f"_row.`{c}`") for c in log.columns], "late")
