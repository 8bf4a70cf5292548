"""What is sent where: headers, splitting, destinations, receipts and delays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.envelope import (
    CONTENT_TYPE, ENVELOPE, JSON, SEND_TO, drop_headers, header, present, put_headers, put_headers_if_absent)
from millrace.functions.content import encode
from millrace.operators.partitioning import Partitioning, assign_partition
from millrace.sources.log import abandon_append, assign_offsets, begin_append, finish_append, stored_positions

DELAY = "x-delay"


def results(df: DataFrame, request_headers: Column | None = None) -> DataFrame:
    """What a function's results become: null results send nothing, and a result takes over the
    request's headers that it has not set itself."""
    out = df.filter(F.col("value").isNotNull())
    return out if request_headers is None else out.withColumn("headers", put_headers_if_absent(request_headers))


def split(df: DataFrame, results_column: str = "results") -> DataFrame:
    """Send a list of results one by one, in order. Binary payloads are no lists and stay whole."""
    if df.schema[results_column].dataType.typeName() == "binary":
        return df.withColumnRenamed(results_column, "value")
    keep = [c for c in df.columns if c not in (results_column, "value")]
    return df.select(*keep, F.posexplode(results_column).alias("index", "value"))


def dynamic_destination(df: DataFrame, default: Column | str, header_name: str = SEND_TO) -> DataFrame:
    """Destination from a header of the row, else the static output; the header does not go out."""
    default = default if isinstance(default, Column) else F.lit(default)
    return df.withColumns({"destination": F.coalesce(header(header_name), default),
                           "headers": drop_headers(header_name)})


def prepare(
    df: DataFrame,
    destination: str,
    data: Column,
    content_type: str = JSON,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """Rows sent to a destination from outside any function: encode, choose the partition, address. `error` says why
    a row could not be encoded."""
    out = encode(df, data, content_type).withColumn("destination", F.lit(destination))
    return assign_partition(out, partitioning) if partitioning else out.withColumn("partition", F.lit(0))


def append(df: DataFrame, path: str, tie_breaker: Column | None = None, slice_by: Column | None = None) -> None:
    """Append to a log stored by destination; a destination not seen before is created. Batch.

    Records get the next offsets of their partition, after those that are stored, by (timestamp, tie breaker); without
    a tie breaker, records of one time follow in any order. A record without timestamp is given that of the call.

    Where partitions end is read from a table beside the log, which every append writes anew for the next one: the log
    is not looked at, and records count when that table is complete. A second append to the same log at the same time
    raises AppendInProgress and writes nothing; one that fails leaves the log as it was."""
    spark = df.sparkSession
    missing = {c: F.lit(None).cast(ENVELOPE[c].dataType) for c in ENVELOPE.names if c not in df.columns}
    rows = df.withColumns(missing).withColumns({
        "headers": present(), "timestamp": F.coalesce("timestamp", F.current_timestamp())})
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields], (
        F.monotonically_increasing_id() if tie_breaker is None else tie_breaker).alias("_tie"))
    n = begin_append(spark, path)
    try:
        base = stored_positions(spark, path) if n > 1 else None
        numbered = assign_offsets(rows, F.col("_tie"), slice_by, base).drop("_tie")
        numbered.withColumn("append", F.lit(n)).write.mode("append").partitionBy("destination", "append").parquet(path)
        finish_append(spark, path, n)
    except BaseException:
        abandon_append(spark, path, n)
        raise


def send(df: DataFrame, path: str, destination: str, data: Column, tie_breaker: Column | None = None, **options) -> None:
    """Encode, partition and append rows from outside any function. Rows that cannot be encoded are not sent; `prepare`
    returns them with their error."""
    rows = df if tie_breaker is None else df.withColumn("_tie", tie_breaker)
    sent = prepare(rows, destination, data, **options).filter(F.col("error").isNull())
    append(sent, path, None if tie_breaker is None else F.col("_tie"))


def with_key(df: DataFrame, key: Column) -> DataFrame:
    """Message key from an expression over payload and headers."""
    return df.withColumn("key", key.cast("string"))


def receipts(sent: DataFrame, destination: str = "receipts") -> DataFrame:
    """One receipt for each record sent: where it went and its offset there."""
    return sent.select(
        F.lit(destination).alias("destination"), "key",
        F.to_json(F.struct("destination", "partition", "offset")).alias("value"),
        put_headers({CONTENT_TYPE: JSON}).alias("headers"))


def confirmations(df: DataFrame, queues: Column) -> tuple[DataFrame, DataFrame]:
    """(acknowledged, returned): messages some queue takes, and those that cannot be routed."""
    routable = F.coalesce(F.size(queues) > 0, F.lit(False))
    return df.filter(routable), df.filter(~routable)


def delay(df: DataFrame, delay_ms: Column) -> DataFrame:
    """Set the delay header and the time before which the message must not be delivered."""
    due = F.timestamp_millis(F.unix_millis("timestamp") + F.coalesce(delay_ms.cast("bigint"), F.lit(0)))
    return df.withColumns({"headers": put_headers({DELAY: delay_ms.cast("bigint")}), "deliver_at": due})


def due(df: DataFrame, as_of: Column) -> DataFrame:
    return df.filter(F.col("deliver_at") <= as_of)
