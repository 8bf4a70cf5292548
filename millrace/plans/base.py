"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.envelope import CONTENT_TYPE, EVENT_TYPE, JSON, to_envelope
from millrace.operators.partitioning import Partitioning, partition_of
from millrace.session import working_path
from millrace.sinks.outputs import append

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

PARTITIONS = 8


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under an operator's name, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Event times in the tables carry no zone; they are taken as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> Column:
    """Exact, so that sums do not depend on the order of the rows."""
    return F.col(c).cast("decimal(18,2)")


def payload() -> Column:
    return F.to_json(F.struct("event_id", money("value").alias("value"), "props"))


def event_log(spark: SparkSession, sf_dir: str, value: Column | None = None, **headers: Column | str) -> DataFrame:
    """Events as the envelopes of destinations `events.<event_type>`, in 8 partitions by user."""
    return to_envelope(
        table(spark, sf_dir, "events"),
        destination=F.concat(F.lit("events."), "event_type"),
        value=payload() if value is None else value,
        key=F.col("user_id"),
        timestamp=F.col("ts"),
        headers={EVENT_TYPE: F.col("event_type"), **headers},
        partition=partition_of(Partitioning(F.col("user_id"), PARTITIONS, "bigint")),
        offset=F.col("event_id"),
    )


def stored_events(spark: SparkSession, sf_dir: str) -> str:
    """Path of a log that events have been appended to in two goes, the later ones second."""
    path = working_path(spark, "log")
    log = event_log(spark, sf_dir)
    early = F.coalesce(F.col("timestamp") < "2024-01-15", F.lit(True))
    for part in (log.filter(early), log.filter(~early)):
        append(part, path, F.col("offset"), hour())
    return path


def noisy_payload() -> Column:
    """Payloads of which small sign-ups are tombstones and errors are cut in half."""
    whole = payload()
    half = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    small_signup = (F.col("event_type") == "signup") & (F.col("value") < 50)
    return F.when(small_signup, None).when(F.col("event_type") == "error", half).otherwise(whole)


def noisy_log(spark: SparkSession, sf_dir: str, **headers: Column | str) -> DataFrame:
    return event_log(spark, sf_dir, noisy_payload(), **headers)


def word_time() -> Column:
    """Event time of a conversation's turn: a minute for each conversation, a second for each turn."""
    seconds = F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn")
    return F.timestamp_seconds(seconds)


def hour(ts: str = "timestamp") -> Column:
    return F.date_trunc("hour", ts)


def shown(headers: str = "headers") -> Column:
    """Headers as text, sorted by name."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


JSON_HEADER = {CONTENT_TYPE: JSON}

PAYLOAD_SQL = """'{"event_id":' || event_id || ',"value":' || CAST(value AS DECIMAL(18,2)) || ',"props":"' || replace(props, '"', '\\"') || '"}'"""

NOISY_SQL = f"""CASE WHEN event_type = 'signup' AND value < 50 THEN NULL
      WHEN event_type = 'error' THEN substring({PAYLOAD_SQL}, 1, CAST(floor(length({PAYLOAD_SQL}) / 2) AS INTEGER))
      ELSE {PAYLOAD_SQL} END"""


def log_cte(value: str = PAYLOAD_SQL) -> str:
    return f"""log AS (SELECT 'events.' || event_type AS destination, CAST(user_id % 8 AS INTEGER) AS "partition",
      event_id AS "offset", ts, epoch_us(ts) // 1000 AS ms, CAST(user_id AS VARCHAR) AS key, {value} AS value,
      event_type, CAST(value AS DECIMAL(18,2)) AS amount, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""


LOG = log_cte()

# Events with the offsets they get when they are appended.
NUMBERED = """(SELECT * EXCLUDE ("offset"), row_number() OVER (PARTITION BY destination, "partition" ORDER BY ts, "offset") - 1 AS "offset" FROM log)"""
NOISY = log_cte(NOISY_SQL)
