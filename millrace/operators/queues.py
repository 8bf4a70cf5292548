"""Queue policies: expiry, length limits, priorities and delivery limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.ordering import with_running

DROP_HEAD, REJECT_PUBLISH = "drop-head", "reject-publish"


@dataclass(frozen=True)
class Kept:
    """Messages that stay in their queue and those that leave it. What leaves goes to the queue's
    dead-letter exchange if it has one, and is lost otherwise."""

    kept: DataFrame
    left: DataFrame


def expire(df: DataFrame, ttl_ms: int, as_of: Column, ts: str = "timestamp") -> Kept:
    """Messages older than the time to live leave the queue; one without a time stays."""
    old = F.coalesce(F.unix_millis(as_of) - F.unix_millis(ts) > ttl_ms, F.lit(False))
    return Kept(df.filter(~old), df.filter(old))


def limit_length(
    df: DataFrame,
    queue: str,
    order: list[Column],
    max_messages: int | None = None,
    max_bytes: int | None = None,
    size: Column | None = None,
    overflow: str = DROP_HEAD,
    slice_by: Column | None = None,
) -> Kept:
    """Keep at most that many messages or bytes per queue. Overflow drops the oldest messages, or
    rejects the newest. Without `size`, a message counts the bytes of its value (none: 0). Batch; runs jobs."""
    if overflow not in (DROP_HEAD, REJECT_PUBLISH):
        raise ValueError(f"unknown overflow behaviour: {overflow}")
    weight = F.coalesce(F.octet_length("value") if size is None else size, F.lit(0))
    numbered = with_running(
        df, [queue], order, position="_at",
        sums={"_bytes": weight.cast("bigint")} if max_bytes is not None else None,
        slice_by=slice_by, descending=overflow == DROP_HEAD)
    fits = F.lit(True)
    if max_messages is not None:
        fits = fits & (F.col("_at") < max_messages)
    if max_bytes is not None:
        fits = fits & (F.col("_bytes") <= max_bytes)
    tagged = numbered.withColumn("_fits", fits)
    extra = ["_at", "_bytes", "_fits"]
    return Kept(tagged.filter("_fits").drop(*extra), tagged.filter("NOT _fits").drop(*extra))


def by_priority(
    df: DataFrame,
    queue: str,
    priority: Column,
    order: list[Column],
    max_priority: int,
    slice_by: Column | None = None,
) -> DataFrame:
    """Order in which the messages of each queue are consumed: by priority, capped at the queue's
    maximum (a message without one has 0), then by age. Adds `turn`, from 0. Batch.

    `slice_by` must not decrease with age; slices are taken within each priority."""
    urgency = -F.least(F.coalesce(priority, F.lit(0)), F.lit(max_priority))
    ranked = df.withColumn("_urgency", urgency)
    slices = None if slice_by is None else F.struct(F.col("_urgency").alias("p"), slice_by.alias("s"))
    out = with_running(ranked, [queue], [F.col("_urgency"), *order], position="turn", slice_by=slices)
    return out.drop("_urgency")


def limit_deliveries(df: DataFrame, deliveries: Column, limit: int) -> Kept:
    """Messages delivered more often than the limit leave the queue; an unknown count is no reason to."""
    over = F.coalesce(deliveries > limit, F.lit(False))
    return Kept(df.filter(~over), df.filter(over))
