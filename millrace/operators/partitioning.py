"""Choosing the partition of outgoing rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.envelope import PARTITION, PARTITION_OVERRIDE, drop_headers, header, put_headers
from millrace.functions.hashing import default_selector


@dataclass(frozen=True)
class Partitioning:
    """How one output is partitioned.

    key: partition key, from the row. dtype: its type, which decides its hash code.
    count: configured number of partitions. actual: number the destination has by now; the
    greater one counts, so a destination never shrinks. selector: replaces the hash."""

    key: Column
    count: int
    dtype: str = "string"
    actual: int = 0
    selector: Callable[[Column], Column] | None = None

    @property
    def effective(self) -> int:
        return max(self.count, self.actual)


def partition_of(how: Partitioning) -> Column:
    """abs(selector(key) % count); a null key is an error."""
    select = how.selector or (lambda k: default_selector(k, how.dtype))
    chosen = F.abs(select(how.key).cast("bigint") % how.effective)
    return F.when(how.key.isNull(), F.raise_error(F.lit("Partition key cannot be null"))).otherwise(chosen).cast("int")


def assign_partition(df: DataFrame, how: Partitioning) -> DataFrame:
    """Set `partition` and its header. An override header wins and is removed; a partition header
    that the function has set already stays."""
    override, given = header(PARTITION_OVERRIDE).cast("int"), header(PARTITION).cast("int")
    out = df.withColumn("partition", F.coalesce(override, given, partition_of(how)))
    headers = put_headers({PARTITION: F.col("partition")}, drop_headers(PARTITION_OVERRIDE))
    return out.withColumn("headers", headers)


def route_name(destination: Column, routing_key: Column | None = None, partition: Column | None = None) -> Column:
    """Name an AMQP output goes out under: routing key, else destination, plus the partition."""
    base = F.coalesce(routing_key, destination) if routing_key is not None else destination
    return F.concat_ws("-", base, partition.cast("string")) if partition is not None else base


def lay_out(df: DataFrame, count: int, tasks: int = 16) -> DataFrame:
    """Bring the rows of each of `count` assigned partitions together, e.g. before writing files with `partitionBy`.

    A partition is dealt over `tasks` tasks by offset, so that few or uneven partitions are no few tasks' work; no task
    gets rows of two."""
    part = F.pmod(F.xxhash64("offset"), F.lit(tasks)).cast("int")
    return df.repartitionById(count * tasks, F.col("partition") * tasks + part)
