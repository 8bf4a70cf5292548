"""Aggregation by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.ordering import with_running
from millrace.session import stored

COLLECTIONS = ("list", "linked_list", "set", "priority_queue")


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows of each key, running on streams in update mode."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def reduce_by(df: DataFrame, keys: Sequence[str], **reducers: Column) -> DataFrame:
    """Reduce each key by built-in associative aggregates, partly done before the shuffle."""
    return df.groupBy(*keys).agg(*[r.alias(n) for n, r in reducers.items()])


def pages(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    page_size: int,
    slice_by: Column | None = None,
    page: str = "page",
) -> DataFrame:
    """Number the rows of each group along `order` and cut them into pages of `page_size`, so that
    no task ever holds a whole group. Batch."""
    numbered = with_running(df, group, order, position="_at", slice_by=slice_by)
    return numbered.withColumn(page, F.floor(F.col("_at") / page_size))


def fold(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[Column],
    step: Callable[[Column, Column], Column],
    slice_by: Column | None = None,
    page_size: int = 4096,
    levels: int = 1,
) -> DataFrame:
    """Reduce each group along `order` by an associative function that is no built-in. Batch; runs jobs.

    Values are folded in pages, the pages' results in pages again, and so on, at least `levels` times and until one
    page is left of the largest group: each task sees at most `page_size` (2 or more) values at a time. The result of
    `step` should be bounded; what grows with the group grows in one row."""
    if page_size < 2:
        raise ValueError("a page must hold two values or more to be folded")
    rows = with_running(df, group, order, position="_at", slice_by=slice_by)
    rows = stored(rows.select(*group, F.col("_at"), F.col(value).alias("_v")), "fold")
    largest = rows.agg(F.coalesce(F.max("_at"), F.lit(0)).alias("n")).first()["n"] + 1
    while page_size ** levels < largest:
        levels += 1
    for level in range(levels):
        last = level == levels - 1
        keys = [*group] if last else [*group, "_page"]
        if not last:
            rows = rows.withColumn("_page", F.floor(F.col("_at") / page_size))
        sorted_values = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda s: s["_v"])
        folded = F.aggregate(F.slice(sorted_values, 2, F.size(sorted_values)), F.get(sorted_values, F.lit(0)), step)
        rows = rows.groupBy(*keys).agg(folded.alias("_v"))
        if not last:
            rows = rows.withColumnRenamed("_page", "_at")
    return rows.select(*group, F.col("_v").alias(value))


def collect(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[Column],
    kind: str = "list",
    page_size: int = 10_000,
    slice_by: Column | None = None,
) -> DataFrame:
    """Collect the values of each group: in event order (list, linked list), distinct and sorted
    (set), or sorted (priority queue). Batch.

    A collection comes as pages of at most `page_size` items, numbered from 0; one that fits has a
    single page. `slice_by` is for lists only: the others are ordered by value, not by `order`."""
    if kind not in COLLECTIONS:
        raise ValueError(f"unsupported collection: {kind}")
    if kind == "set":
        df = df.select(*group, value).distinct()
        order, slice_by = [F.col(value)], None
    elif kind == "priority_queue":
        order, slice_by = [F.col(value), *order], None
    paged = pages(df, group, order, page_size, slice_by)
    items = F.transform(F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("v")))), lambda s: s["v"])
    return paged.groupBy(*group, "page").agg(items.alias("items"))
