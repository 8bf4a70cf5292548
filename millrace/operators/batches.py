"""Batches of messages: cutting, building and taking apart.

A batch is one row: `items`, an array of struct(value, headers) in which a null value is a
tombstone at its own index, and `headers`, the map of the batch itself."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import header_map
from millrace.ordering import with_running
from millrace.session import stored


def _sorted_items(at: str = "_at") -> Column:
    # Structs keep null values, which collect_list would drop.
    rows = F.array_sort(F.collect_list(F.struct(at, "value", F.map_entries("headers").alias("headers"))))
    return F.transform(rows, lambda r: F.struct(r["value"].alias("value"), F.map_from_entries(r["headers"]).alias("headers")))


def assemble(df: DataFrame, group: Sequence[str], order: Sequence[Column], size: int,
             slice_by: Column | None = None) -> DataFrame:
    """Batches of `size` consecutive rows of each group (the last one may be shorter). Batch."""
    numbered = with_running(df, group, order, position="_at", slice_by=slice_by)
    numbered = numbered.withColumn("batch", F.floor(F.col("_at") / size))
    return numbered.groupBy(*group, "batch").agg(_sorted_items().alias("items"))


def build(df: DataFrame, batch: Sequence[str], at: str, root: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Build batches from rows that know theirs, ordered by `at`, with headers for the batch itself. A batch is one
    row, so it must be bounded by whoever assigned it (`assemble` does so by size)."""
    built = df.groupBy(*batch).agg(_sorted_items(at).alias("items"))
    return built.withColumn("headers", header_map(root or {}))


def explode(batches: DataFrame) -> DataFrame:
    """Each item of each batch with its index, own value and own headers."""
    keep = [c for c in batches.columns if c not in ("items", "headers")]
    return (batches.select(*keep, F.posexplode("items").alias("index", "_item"))
            .select(*keep, "index", F.col("_item.value").alias("value"), F.col("_item.headers").alias("headers")))


def explode_bare(batches: DataFrame, payloads: str) -> DataFrame:
    """The same for batches that are plain arrays of payloads, without headers."""
    keep = [c for c in batches.columns if c != payloads]
    return batches.select(*keep, F.posexplode(payloads).alias("index", "value"))


def explode_nested(df: DataFrame, payload: Column, element: str = "string") -> DataFrame:
    """Items of payloads that are lists themselves, as JSON text."""
    listed = F.from_json(payload, f"array<{element}>")
    return df.select("*", F.posexplode(listed).alias("index", "element"))


def _ends(sizes: np.ndarray, times: np.ndarray, count: int, limit: int, idle_ms: int) -> np.ndarray:
    """For a batch that begins at each row, the row after its last one; len + 1 if nothing in these
    rows releases it. Each message takes its size plus 4 bytes."""
    n = len(sizes)
    used = np.concatenate([[0], np.cumsum(sizes + 4)])
    rows = np.arange(n)
    target = used[:-1] + limit
    reach = np.searchsorted(used, target, side="left")
    exact = used[np.minimum(reach, n)] == target
    # Over the limit, the message that overflows begins the next batch, unless it is alone.
    by_bytes = np.where(reach > n, n + 1, np.where(exact, reach, np.maximum(reach - 1, rows + 1)))
    by_count = np.where(rows + count <= n, rows + count, n + 1)
    breaks = np.flatnonzero(np.diff(times) >= idle_ms) + 1
    following = np.searchsorted(breaks, rows, side="right")
    by_idle = np.append(breaks, n + 1)[following]
    return np.minimum(np.minimum(by_bytes, by_count), by_idle)


def buffer(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    count: int = 100,
    limit: int = 10_000,
    idle_ms: int = 5000,
    slice_by: Column | None = None,
    chunk: int = 1_000_000,
    ts: str = "timestamp",
) -> DataFrame:
    """Producer-side batching: add to each row `batch`, the position in its group at which its batch
    begins. A batch is released at `count` messages, at `limit` buffered bytes, or when nothing comes
    for `idle_ms`. Batch.

    Where a batch ends depends on where it began, so the rule is sequential; yet what a chunk of rows
    needs to know of those before it is only how many messages are still open, fewer than `count`.
    So each chunk works out, from its rows and the last count - 1 before it, how many it leaves open
    for each number it may find; these small tables are chained per group; and each chunk then marks
    its batches. No task holds more than a chunk of a group."""
    chunk = max(chunk, count)
    rows = with_running(df, group, order, position="_at", slice_by=slice_by)
    rows = rows.withColumns({"_size": F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint"),
                             "_ms": F.unix_millis(ts)})
    rows = stored(rows, "numbered")  # read three times below, twice without its payload
    slim = rows.select(*group, "_at", "_size", "_ms")
    own = F.floor(F.col("_at") / chunk)
    tail = F.col("_at") % chunk > chunk - count
    # The last rows of a chunk are context for the next one.
    context = slim.withColumn("_chunk", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))))
    keys = [*group, "_chunk"]
    key_fields = [context.schema[k] for k in keys]

    def prepared(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
        pdf = pdf.sort_values("_at")
        at = pdf["_at"].to_numpy()
        before = int((at // chunk < pdf["_chunk"].iloc[0]).sum())
        ends = _ends(pdf["_size"].to_numpy(), pdf["_ms"].to_numpy(), count, limit, idle_ms)
        return pdf, ends, before

    def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, ends, before = prepared(pdf)
        n = len(pdf)
        if before == n:  # context only: the group ends with the chunk before
            return pd.DataFrame(columns=[*keys, "_open"])
        left = np.zeros(n + 1, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            left[i] = n - i if ends[i] > n else left[ends[i]]
        found = [int(left[before - k]) for k in range(min(before, count - 1) + 1)]
        first = pdf[keys].iloc[:1].copy()
        first["_open"] = [found]
        return first

    def chained(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = pd.concat(list(parts)).sort_values("_chunk")
        found, entry = [], 0
        for opened in tables["_open"]:
            found.append(entry)
            entry = int(opened[entry])
        yield tables[keys].assign(_entry=found)

    def marked(pdf: pd.DataFrame) -> pd.DataFrame:
        entry = int(pdf["_entry"].iloc[0])
        pdf, ends, before = prepared(pdf)
        n, at = len(pdf), pdf["_at"].to_numpy()
        begins = np.empty(n, dtype=np.int64)
        i = before - entry
        while i < n:
            stop = min(int(ends[i]), n)
            begins[i:stop] = at[i]
            i = stop
        out = pdf[[*group, "_at"]].assign(batch=begins)
        return out.iloc[before:]

    tables = context.groupBy(*keys).applyInPandas(
        leaves, T.StructType([*key_fields, T.StructField("_open", T.ArrayType(T.LongType()))]))
    entries = tables.groupBy(*group).applyInPandas(
        chained, T.StructType([*key_fields, T.StructField("_entry", T.LongType())]))
    starts = context.join(entries, keys).groupBy(*keys).applyInPandas(
        marked, T.StructType([*key_fields[:-1], T.StructField("_at", T.LongType()), T.StructField("batch", T.LongType())]))
    return rows.drop("_size", "_ms").join(starts, [*group, "_at"]).withColumnRenamed("_at", "position")
