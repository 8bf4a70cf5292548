"""Joins of streams with tables and with other streams.

None of them hints a broadcast: Spark broadcasts a side when its estimated or measured size is
below `spark.sql.autoBroadcastJoinThreshold` and shuffles both otherwise. In batch, adaptive
execution splits the partitions of hot keys if nothing but a sort stands between exchange and join;
an aggregate there (`latest`) prevents it, so tables are stored first. A stream has no such step,
hence `salt`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.ordering import with_running
from millrace.session import stored


def join_table(
    stream: DataFrame,
    table: DataFrame,
    how: str = "left",
    defaults: Mapping[str, Column | str] | None = None,
    salt: int = 1,
) -> DataFrame:
    """Join a stream with a table's present values on `key`; `defaults` stand in for what a key
    without a table row lacks. A batch table is stored first, by a job.

    With `salt` > 1 each key is spread over that many tasks, and the table repeated as often."""
    if not table.isStreaming:
        table = stored(table, "table")
    if how not in ("left", "inner"):
        raise ValueError("a stream joins a table by left or inner join")
    on = ["key"]
    if salt > 1:
        spread = F.pmod(F.xxhash64(*[c for c in stream.columns if stream.schema[c].dataType.typeName() != "map"]), F.lit(salt))
        stream = stream.withColumn("_salt", spread)
        table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
        on.append("_salt")
    joined = stream.join(table, on, how).drop("_salt")
    fill = {c: F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)) for c, d in (defaults or {}).items()}
    return joined.withColumns(fill) if fill else joined


def join_global(stream: DataFrame, table: DataFrame, key: Column) -> DataFrame:
    """Inner join on a key computed from the record; `table` has the columns `key` and its own."""
    keyed = table.withColumnRenamed("key", "_global_key")
    return stream.join(keyed, key == F.col("_global_key")).drop("_global_key")


def join_interval(left: DataFrame, right: DataFrame, within_ms: int, ts: tuple[str, str], key: str = "key") -> DataFrame:
    """Inner join of two streams on `key` where the times are at most `within_ms` apart.

    Rows meet through a time bucket as well as the key, so a hot key is compared only within
    neighbouring buckets, never all against all. Columns must not clash, but for the key."""
    width = 2 * within_ms + 1
    left_ms, right_ms = F.unix_millis(ts[0]), F.unix_millis(ts[1])
    bucket_of = lambda ms: F.floor(ms / width)
    # A right row can meet left rows of at most two buckets.
    first, last = bucket_of(right_ms - within_ms), bucket_of(right_ms + within_ms)
    spread = right.withColumn("_bucket", F.explode(F.array_distinct(F.array(first, last))))
    near = F.col(ts[1]).between(F.col(ts[0]) - F.make_dt_interval(secs=F.lit(within_ms / 1000.0)),
                                F.col(ts[0]) + F.make_dt_interval(secs=F.lit(within_ms / 1000.0)))
    return left.withColumn("_bucket", bucket_of(left_ms)).join(spread, [key, "_bucket"]).filter(near).drop("_bucket")


def join_asof(
    stream: DataFrame,
    table: DataFrame,
    values: Sequence[str],
    tie_breaker: str,
    ts: str = "timestamp",
    key: str = "key",
    slice_by: Column | None = None,
) -> DataFrame:
    """Give each stream row the table's values as of its own time (same time included); a row
    without key or without earlier table row gets nulls. Batch.

    Both sides share `key`, `ts` and `tie_breaker`. They are put into one order in which table rows
    come before stream rows of the same time, and the newest table row is carried along it; this
    sorts each side once, where a range join would compare pairs."""
    carried = F.struct(*[F.col(v) for v in values])
    own = [c for c in stream.columns if c not in (key, ts, tie_breaker)]
    row = F.struct(F.lit(True).alias("_present"), *[F.col(c) for c in own])  # a struct cannot be empty
    left = stream.select(key, ts, tie_breaker, row.alias("_row"), F.lit(1).alias("_side"))
    right = table.select(key, ts, tie_breaker, carried.alias("_table"), F.lit(0).alias("_side"))
    both = left.unionByName(right, allowMissingColumns=True).filter(F.col(key).isNotNull())
    table_types = {v: table.schema[v].dataType for v in values}
    keyless = stream.filter(F.col(key).isNull()).select(
        key, ts, tie_breaker, *own, *[F.lit(None).cast(t).alias(v) for v, t in table_types.items()])
    seen = with_running(both, [key], [F.col(ts), F.col("_side"), F.col(tie_breaker)],
                        latest={"_seen": F.col("_table")}, slice_by=slice_by)
    rows = seen.filter(F.col("_side") == 1)
    joined = rows.select(key, ts, tie_breaker, *[F.col(f"_row.{c}") for c in own], *[F.col(f"_seen.{v}") for v in values])
    return joined.unionByName(keyless)
