"""Ordered computations inside groups of any size.

A plain window sorts a whole group in one task. Here each group is cut into slices that follow the
order; the window runs inside (group, slice), and what a slice takes over from the slices before it
comes from a small summary table with one row for each (group, slice). A group with a third of all
rows is then spread over as many tasks as it has slices.

Slices come from `slice_by`, any column that never decreases along the order (an hour of the event
time, an offset range). The rows of each (group, slice) are counted first, by a narrow aggregate that
runs while the frame is built. Slices with more than `slice_rows` rows of a group, and only they, are
range-partitioned on (group, order), which balances any distribution, and written to a table.
Without `slice_by` this is
done for all rows, unless all of them are no more than `slice_rows`. The order must be total within a group; group columns
must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

_SLICE, _PART = "_slice", "_part"

# More rows of one group in one slice than a task should sort, unless the caller says otherwise.
SLICE_ROWS = 20_000_000


def _ranged(df: DataFrame, group: Sequence[str], order: Sequence[Column], rows: int, slice_rows: int) -> DataFrame:
    """Cut the rows into parts of about the same size along (group, order), of half the limit at most, about."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * rows // slice_rows))
    ranged = df.repartitionByRange(tasks, *[F.col(g) for g in group], *order)
    # Stored, since a second computation would sample other range bounds.
    return stored(ranged.withColumn(_PART, F.spark_partition_id()), "ranged")


def _sliced(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], slice_by: Column | None, slice_rows: int | None = None
) -> DataFrame:
    slice_rows = slice_rows or SLICE_ROWS
    # A null group would lose what it takes over, so it is an error rather than a wrong result.
    known = reduce(Column.__and__, [F.col(g).isNotNull() for g in group])
    checked = F.when(known, F.lit(0) if slice_by is None else slice_by)
    df = df.withColumn(_SLICE, checked.otherwise(F.raise_error(F.lit("a group column is null"))))
    if slice_by is None:
        rows = df.count()
        # What one task can sort is one part, whatever its groups.
        return df.withColumn(_PART, F.lit(0)) if rows <= slice_rows else _ranged(df, group, order, rows, slice_rows)

    rows = df.withColumn(_PART, F.lit(0))
    keys = [*group, _SLICE]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most one row for each `slice_rows` rows of the input.
    hot = stored(counts.filter(F.col("_n") > slice_rows), "hot-slices")
    many = hot.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    if not many:
        return rows
    hot = hot.drop("_n")
    return rows.join(hot, keys, "left_anti").unionByName(
        _ranged(df.join(hot, keys, "left_semi"), group, order, many, slice_rows))


def with_running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    *,
    position: str | None = None,
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    slice_by: Column | None = None,
    descending: bool = False,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add running columns along `order` within `group`. Batch; runs jobs to count the slices and, where a slice is
    too large or there are none, to write the rows to a table.

    position: name of the 0-based dense position. sums, maxima: running sum and maximum up to and
    with the row. latest: last non-null value up to and with the row. previous: value of the row
    before (null for the first). With `descending`, order and slices run downwards. slice_rows: most rows
    of one group that a task sorts (by default `SLICE_ROWS`)."""
    sums, maxima, latest, previous = sums or {}, maxima or {}, latest or {}, previous or {}
    order_key = F.struct(*order)
    order = [o.desc() if descending else o.asc() for o in order]
    rows = _sliced(df, group, order, slice_by, slice_rows)
    inputs = {**{f"_s_{n}": c for n, c in sums.items()}, **{f"_m_{n}": c for n, c in maxima.items()},
              **{f"_l_{n}": c for n, c in latest.items()}, **{f"_p_{n}": c for n, c in previous.items()}}
    rows = rows.withColumns(inputs)

    keys = [*group, _SLICE, _PART]
    inside = Window.partitionBy(*keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Parts are numbered along the order, so they always run upwards.
    slice_order = [F.col(_SLICE).desc() if descending else F.col(_SLICE).asc(), F.col(_PART).asc()]
    before = Window.partitionBy(*group).orderBy(*slice_order).rowsBetween(Window.unboundedPreceding, -1)

    # The last row of a slice is the one with the greatest (downwards, the least) order key.
    last_by = F.min_by if descending else F.max_by

    local, summary, carry, final = {}, [], {}, {}
    if position:
        local["_n_local"] = F.row_number().over(inside).cast("bigint") - 1
        summary.append(F.count(F.lit(1)).alias("_n"))
        carry["_n_carry"] = F.sum("_n").over(before)
        final[position] = F.col("_n_local") + F.coalesce("_n_carry", F.lit(0))
    for n in sums:
        local[f"_s_{n}_local"] = F.sum(f"_s_{n}").over(upto)
        summary.append(F.sum(f"_s_{n}").alias(f"_s_{n}"))
        carry[f"_s_{n}_carry"] = F.sum(f"_s_{n}").over(before)
        here, earlier = F.col(f"_s_{n}_local"), F.col(f"_s_{n}_carry")
        final[n] = F.coalesce(here + earlier, here, earlier)
    for n in maxima:
        local[f"_m_{n}_local"] = F.max(f"_m_{n}").over(upto)
        summary.append(F.max(f"_m_{n}").alias(f"_m_{n}"))
        carry[f"_m_{n}_carry"] = F.max(f"_m_{n}").over(before)
        final[n] = F.greatest(f"_m_{n}_local", f"_m_{n}_carry")
    for n in latest:
        v = F.col(f"_l_{n}")
        local[f"_l_{n}_local"] = F.last(v, ignorenulls=True).over(upto)
        summary.append(last_by(v, F.when(v.isNotNull(), order_key)).alias(f"_l_{n}"))
        carry[f"_l_{n}_carry"] = F.last(f"_l_{n}", ignorenulls=True).over(before)
        final[n] = F.coalesce(f"_l_{n}_local", f"_l_{n}_carry")
    for n in previous:
        # Wrapped, so that a null value is told from a missing row.
        v = F.struct(F.col(f"_p_{n}").alias("v"))
        local[f"_p_{n}_local"] = F.lag(v).over(inside)
        summary.append(last_by(v, order_key).alias(f"_p_{n}"))
        carry[f"_p_{n}_carry"] = F.last(f"_p_{n}", ignorenulls=True).over(before)
        final[n] = F.coalesce(f"_p_{n}_local", f"_p_{n}_carry")["v"]

    totals = rows.groupBy(*keys).agg(*summary)
    carried = totals.select(*keys, *[c.alias(n) for n, c in carry.items()])
    # No broadcast hint: the summary is broadcast only if its measured size allows.
    joined = rows.withColumns(local).join(carried, on=keys, how="left")
    return joined.withColumns(final).select(*df.columns, *final)
