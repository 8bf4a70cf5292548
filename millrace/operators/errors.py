"""Bad rows: policies, dead letters and their way back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.envelope import PARTITION_OVERRIDE, epoch_ms, header, put_headers
from millrace.functions.embedded import embed_headers, extract_headers
from millrace.session import stored

FAIL, LOG, SKIP, DLQ = "logAndFail", "logAndContinue", "skipAndContinue", "sendToDlq"

# Headers of dead letters.
X_RETRIES = "x-retries"
X_EXCEPTION_MESSAGE = "x-exception-message"
X_EXCEPTION_STACKTRACE = "x-exception-stacktrace"
X_RETRY_COUNT = "x-retry-count"
X_DELAY = "x-delay"


@dataclass(frozen=True)
class Split:
    """The rows that go on and those for the dead-letter destination (None if there is none)."""

    good: DataFrame
    bad: DataFrame | None


def apply_policy(
    df: DataFrame, binding: str | None = None, default: str = FAIL, error: str = "error", dropped: Observation | None = None
) -> Split:
    """Split rows by their error column; the binding's policy beats the default one.

    Tombstones carry no error, so they are always good. Rows that are logged or skipped are dropped; an observation
    given as `dropped` counts them as `dropped`, and for the log policy holds the least and the greatest error as
    `errors` (one if they are equal, none without bad rows), whatever the number of different errors."""
    policy = binding or default
    ok = F.col(error).isNull()
    if policy == FAIL:
        stop = F.raise_error(F.concat(F.col(error), F.lit(": "), F.coalesce(F.col("value").cast("string"), F.lit("null"))))
        return Split(df.filter(F.when(ok, True).otherwise(stop.cast("boolean"))).drop(error), None)
    if policy not in (LOG, SKIP, DLQ):
        raise ValueError(f"unknown policy: {policy}")
    if policy != DLQ and dropped is not None:
        counted = [F.count_if(~ok).alias("dropped")]
        if policy == LOG:
            counted.append(F.array_distinct(F.array_compact(F.array(F.min(error), F.max(error)))).alias("errors"))
        df = df.observe(dropped, *counted)
    return Split(df.filter(ok).drop(error), df.filter(~ok) if policy == DLQ else None)


def handle_errors(
    split: Split,
    default: Callable[[DataFrame], DataFrame] | None = None,
    binding: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Give the bad rows to a handler: the binding's own, else the default one. A handler takes the
    place of the dead-letter destination."""
    handler = binding or default
    if handler is None or split.bad is None:
        raise ValueError("no handler, or no bad rows to handle")
    return handler(split.bad)


def dlq_name(
    group: str | None,
    destination: Column | None = None,
    configured: str | None = None,
    resolver: Column | None = None,
) -> Column:
    """Where a record's dead letter goes: resolver, else configured name, else
    `error.<destination>.<group>`. Dead letters need a named group."""
    if not group:
        raise ValueError("a dead-letter destination needs a named consumer group")
    destination = F.col("destination") if destination is None else destination
    options = [resolver] if resolver is not None else []
    if configured:
        options.append(F.lit(configured))
    options.append(F.concat(F.lit("error."), destination, F.lit(f".{group}")))
    return F.coalesce(*options)


def queue_dlq_name(queue: Column) -> Column:
    """Name of an AMQP queue's dead-letter queue."""
    return F.concat(queue, F.lit(".dlq"))


def dlq_partition(dlq_partitions: int | None = None, custom: Column | None = None) -> Column:
    """Custom choice, else the original partition, else 0 if the dead-letter destination has at most
    one partition."""
    fallback = F.lit(0) if dlq_partitions is not None and dlq_partitions <= 1 else F.col("partition")
    return (F.coalesce(custom, fallback) if custom is not None else fallback).cast("int")


def dead_letter(
    bad: DataFrame,
    name: Column,
    partition: Column | None = None,
    mode: str = "headers",
    error: str = "error",
    message: Column | None = None,
    stacktrace: Column | None = None,
    timestamp_type: str = "CreateTime",
) -> DataFrame:
    """Envelopes for the dead-letter destination: original payload and headers, plus where the
    record came from and what went wrong.

    mode: these go into native `headers`, into the payload (`embeddedHeaders`), or nowhere (`none`)."""
    details = {
        "x-original-topic": F.col("destination"),
        "x-original-partition": F.col("partition"),
        "x-original-offset": F.col("offset"),
        "x-original-timestamp": epoch_ms("timestamp"),
        "x-original-timestamp-type": timestamp_type,
        "x-exception-fqcn": F.col(error),
        X_EXCEPTION_MESSAGE: F.col(error) if message is None else message,
        X_EXCEPTION_STACKTRACE: F.col(error) if stacktrace is None else stacktrace,
    }
    target = {"destination": name, "partition": dlq_partition() if partition is None else partition,
              "offset": F.lit(None).cast("bigint")}
    if mode == "headers":
        changed = {**target, "headers": put_headers(details)}
    elif mode == "embeddedHeaders":
        # In steps, so that neither the extracted nor the combined headers are computed per header.
        bad = bad.withColumn("_inside", extract_headers(F.col("value").cast("binary")))
        bad = bad.withColumn("_together", put_headers(details, "_inside.headers"))
        changed = {**target, "value": embed_headers(F.col("_inside.body"), F.col("_together"), list(details))}
    elif mode == "none":
        changed = target
    else:
        raise ValueError(f"unknown header mode: {mode}")
    return bad.withColumns(changed).drop(error, "_inside", "_together")


def dead_letter_batches(df: DataFrame, *batch: str, error: str = "error") -> DataFrame:
    """Rows of every batch in which at least one failed: in batch mode the whole batch is sent, all
    of it with the same error. Batch; runs a job.

    The failed batches, one row each, are stored and joined back: where they are few, Spark broadcasts them and none
    but failed rows are shuffled; where they are many, adaptive execution can split a large batch, as it could not
    with an aggregate right below the join."""
    failed = stored(df.filter(F.col(error).isNotNull()).groupBy(*batch).agg(F.min(error).alias(error)), "failed-batches")
    return df.drop(error).join(failed, list(batch))


def reprocess(dlq: DataFrame, original: Column, parking_lot: str, limit: int = 3) -> DataFrame:
    """Send dead letters back to where they came from, to their original partition, counting
    `x-retries`; after `limit` of them, to the parking lot."""
    retries = F.coalesce(header(X_RETRIES).cast("int"), F.lit(0))
    again = retries < limit
    count = F.when(again, retries + 1).otherwise(retries)
    return dlq.withColumns({
        "destination": F.when(again, original).otherwise(F.lit(parking_lot)),
        "headers": put_headers({X_RETRIES: count, PARTITION_OVERRIDE: F.col("partition")}),
    })


def reprocess_delay(retries: Column, step_ms: int = 5000) -> Column:
    """Delay before a dead letter is queued again."""
    return retries.cast("bigint") * step_ms


def truncate_trace(trace: Column, frame_max: int, headroom: int = 20_000) -> Column:
    """Stack trace cut to what a frame can hold; no limit if the frame has none."""
    room = frame_max - headroom
    return F.substring(trace, 1, room) if frame_max > 0 and room > 0 else trace


def republish(
    bad: DataFrame,
    exchange: str,
    routing_key: Column,
    immediate_ack: Column,
    message: Column,
    trace: Column,
    original_exchange: Column,
    original_key: Column,
) -> DataFrame:
    """AMQP form of dead-lettering; an error that asks for immediate acknowledgement is not
    republished, one that says nothing about it is. The message goes to `exchange` with `routing_key` (by default the queue's name)."""
    retries = F.coalesce(header(X_RETRY_COUNT).cast("bigint"), F.lit(0)) + 1
    return bad.filter(~F.coalesce(immediate_ack, F.lit(False))).withColumns({
        "destination": F.lit(exchange),
        "key": routing_key,
        "headers": put_headers({
            X_EXCEPTION_STACKTRACE: trace,
            X_EXCEPTION_MESSAGE: message,
            "x-original-exchange": original_exchange,
            "x-original-routingKey": original_key,
            X_RETRY_COUNT: retries,
        }),
    })
