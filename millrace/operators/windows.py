"""Windows over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import pages
from millrace.ordering import with_running


def tumbling(df: DataFrame, size: str, *keys: str, ts: str = "timestamp", **aggregates: Column) -> DataFrame:
    """Aggregate by tumbling window and keys. On a stream, set a watermark of "0 seconds" for windows
    with no grace; rows are reduced before the shuffle in either case."""
    aggregates = aggregates or {"count": F.count(F.lit(1))}
    grouped = df.groupBy(F.window(ts, size), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return grouped.select(*keys, *aggregates, F.col("window.start").alias("start"), F.col("window.end").alias("end"))


def gather(
    df: DataFrame,
    size: str,
    value: str,
    order: Sequence[Column],
    keys: Sequence[str] = (),
    page_size: int = 10_000,
    slice_by: Column | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Values of each window in order, as pages of at most `page_size` items. Batch.

    Most windows have the one page 0; a window with more rows than one task should hold has more,
    and its value is their concatenation by page number."""
    df = df.withColumn("start", F.window(ts, size)["start"])
    paged = pages(df, ["start", *keys], order, page_size, slice_by)
    sorted_items = F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("v"))))
    return paged.groupBy("start", *keys, "page").agg(F.transform(sorted_items, lambda s: s["v"]).alias("items"))


def concat(df: DataFrame, size: str, value: str, order: Sequence[Column], separator: str = "", **options) -> DataFrame:
    """Concatenate the values of each window in order, page by page as `gather` does. Batch."""
    gathered = gather(df, size, value, order, **options)
    return gathered.withColumn("text", F.array_join("items", separator)).drop("items")


def fill_gaps(df: DataFrame, size: str, identity: dict[str, object], keys: Sequence[str] = (), start: str = "start") -> DataFrame:
    """Add the windows without rows between the first and the last of each key, holding the
    identity values. Batch.

    Takes aggregated windows, so a key has as many rows as windows, whatever its number of events;
    each row emits itself and the empty windows up to the next one."""
    step = F.expr(f"INTERVAL {size}")
    after = F.lead(start).over(Window.partitionBy(*keys).orderBy(start)) if keys else None
    if after is None:
        raise ValueError("gaps are filled by key; give a constant key for a single series")
    stop = F.coalesce(F.col("_next") - step, F.col(start))
    spread = df.withColumn("_next", after).withColumn("_at", F.explode(F.sequence(F.col(start), stop, step)))
    empty = F.col("_at") != F.col(start)
    filled = {c: F.when(empty, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in identity.items()}
    return spread.withColumns(filled).withColumn(start, F.col("_at")).drop("_next", "_at")


def store(df: DataFrame, size: str, *keys: str, retention: str | None = None, as_of: Column | None = None,
          **aggregates: Column) -> DataFrame:
    """Window store: one value per key and window start, less the windows that ended before the
    retention time (by default one window) at `as_of`."""
    table = tumbling(df, size, *keys, **aggregates)
    if as_of is None:
        return table
    return table.filter(F.col("end") > as_of - F.expr(f"INTERVAL {retention or size}"))


def flag_late(
    log: DataFrame,
    arrival: Sequence[Column],
    source: Sequence[str] = ("destination", "partition"),
    grace: str = "0 seconds",
    slice_by: Column | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Flag rows older than their source's stream time, the greatest event time that has arrived so
    far. A row without a time is not late. Batch; on a stream the watermark drops them."""
    seen = with_running(log, list(source), arrival, maxima={"_stream_time": F.col(ts)}, slice_by=slice_by)
    late = F.coalesce(F.col(ts) < F.col("_stream_time") - F.expr(f"INTERVAL {grace}"), F.lit(False))
    return seen.withColumn("late", late).drop("_stream_time")


def drop_late(log: DataFrame, arrival: Sequence[Column], **options) -> DataFrame:
    return flag_late(log, arrival, **options).filter(~F.col("late")).drop("late")
