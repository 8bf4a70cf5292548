"""The row schema shared by all operators, and small helpers on its header map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("destination", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Reserved header names.
PARTITION = "scst_partition"
PARTITION_OVERRIDE = "scst_partitionOverride"
TARGET_DESTINATION = "scst_targetDestination"
BATCH_HEADERS = "scst_batchHeaders"
NATIVE_HEADERS_PRESENT = "scst_nativeHeadersPresent"
VERSION = "scst_version"
CONTENT_TYPE = "contentType"
EVENT_TYPE = "event_type"
SEND_TO = "spring.cloud.stream.sendto.destination"

JSON = "application/json"


def as_column(value: Column | str | int | None, dtype: str = "string") -> Column:
    """A Column as it is, any other value as a literal of the given type."""
    return value if isinstance(value, Column) else F.lit(value).cast(dtype)


def header(name: str) -> Column:
    """The value of one header, or null. Where the map is built in the same query, Spark reads the
    entry's expression and never builds the map."""
    return F.col("headers")[name]


def header_map(entries: Mapping[str, Column | str | int]) -> Column:
    """A header map of the given entries. An entry whose value is null counts as absent; sinks leave
    it out (`present`)."""
    if not entries:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    parts = [p for name, v in entries.items() for p in (F.lit(name), as_column(v).cast("string"))]
    return F.create_map(*parts)


def present(headers: Column | str = "headers") -> Column:
    """Headers that have a value."""
    return F.map_filter(headers, lambda _, v: v.isNotNull())


def put_headers(entries: Mapping[str, Column | str | int], base: Column | str = "headers") -> Column:
    """`base` with the entries added, or replaced where the name is there already."""
    new = header_map(entries)
    base = F.coalesce(F.col(base) if isinstance(base, str) else base, header_map({}))
    names = list(entries)
    return F.map_concat(F.map_filter(base, lambda k, _: ~k.isin(names)), new)


def put_headers_if_absent(entries: Column, base: Column | str = "headers") -> Column:
    """`base` with those of `entries` (a map) whose names it lacks."""
    base = F.coalesce(F.col(base) if isinstance(base, str) else base, header_map({}))
    return F.map_zip_with(base, entries, lambda _, own, other: F.coalesce(own, other))


def drop_headers(*names: str, base: Column | str = "headers") -> Column:
    base = F.col(base) if isinstance(base, str) else base
    return F.map_filter(base, lambda k, _: ~k.isin(list(names)))


def to_envelope(
    df: DataFrame,
    destination: Column | str,
    value: Column,
    key: Column | None = None,
    timestamp: Column | None = None,
    headers: Mapping[str, Column | str | int] | None = None,
    partition: Column | int = 0,
    offset: Column | None = None,
) -> DataFrame:
    """Wrap the rows of any table as envelopes."""
    return df.select(
        as_column(destination).alias("destination"),
        as_column(partition, "int").cast("int").alias("partition"),
        as_column(offset, "bigint").cast("bigint").alias("offset"),
        as_column(timestamp, "timestamp").cast("timestamp").alias("timestamp"),
        as_column(key).cast("string").alias("key"),
        value.alias("value"),
        header_map(headers or {}).alias("headers"),
    )


def epoch_ms(ts: Column | str) -> Column:
    """Event time as epoch milliseconds."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)
