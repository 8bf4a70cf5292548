"""Operators whose state changes while a stream runs, each against what it amounts to in the end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.envelope import epoch_ms
from millrace.operators import routing
from millrace.plans.base import LOG, NOISY, event_log, noisy_log, query
from millrace.plans.queries.aggregation import amount
from millrace.plans.queries.keyed import LATEST
from millrace.session import working_path
from millrace.streaming import changing, runner

# Where the log is cut into the parts that arrive one after the other.
DAYS = ("2024-01-10", "2024-01-20")


def arriving(spark: SparkSession, logs: list[DataFrame], operator: Callable[..., DataFrame], mode: str, by: Column | None = None) -> DataFrame:
    """What an operator on streams emits when the parts of its logs arrive one after the other. Each run goes on from the
    state that the one before left."""
    by = F.col("timestamp") if by is None else by
    paths, out, checkpoint = [working_path(spark, "arriving") for _ in logs], working_path(spark, "out"), working_path(spark, "group")
    for first, last in zip((None, *DAYS), (*DAYS, None)):
        for log, path in zip(logs, paths):
            some = (F.lit(True) if first is None else by >= first) & (F.lit(True) if last is None else by < last)
            log.filter(some).write.mode("append").parquet(path)
        streams = [runner.stream_table(spark, path, "*.parquet", log.schema) for log, path in zip(logs, paths)]
        runner.run_available(operator(*streams), runner.write_outputs({"out": lambda b: b}, out), checkpoint, mode)
    return spark.read.parquet(f"{out}/out")


@query("join_changing_table", f"""WITH {LOG}, ends AS (SELECT max(ms) FILTER (event_type = 'purchase') AS p, max(ms) FILTER (event_type = 'signup') AS s FROM log)
  SELECT p."offset", p.key, p.ms AS timestamp_ms, CAST(s.amount AS DOUBLE) AS plan
  FROM (SELECT log.* FROM log, ends WHERE event_type = 'purchase' AND epoch_us(ts) <= 1000 * least(p, s)) p
  ASOF LEFT JOIN (SELECT * FROM log WHERE event_type = 'signup') s ON p.key = s.key AND p.ts >= s.ts""")
def join_changing_table(spark, sf):
    """Purchases with the plan of the newest sign-up before them; both arrive as streams. Rows that the watermark, the
    lesser end of both, has not passed are still waiting."""
    log = event_log(spark, sf).withColumn("amount", F.get_json_object("value", "$.value").cast("decimal(18,2)"))
    purchases = routing.by_event_type(log, "purchase").select("key", "timestamp", "offset")
    signups = routing.by_event_type(log, "signup").select("key", "timestamp", "offset", F.col("amount").alias("plan"))
    joined = arriving(spark, [purchases, signups], lambda p, s: changing.join_changing_table(p, s, ["plan"], "offset"), "append")
    return joined.select("offset", "key", epoch_ms("timestamp").alias("timestamp_ms"), F.col("plan").cast("double").alias("plan"))


@query("tbl_latest_changes", f"""WITH {NOISY}, {LATEST} SELECT * FROM latest""")
def tbl_latest_changes(spark, sf):
    """The newest row of each key that came out of the stream, less the keys that were removed."""
    log = noisy_log(spark, sf).select("key", "timestamp", "offset", "value")
    changes = arriving(spark, [log], changing.latest_changes, "update")
    newest = changes.groupBy("key").agg(F.max_by(F.struct("value", "removed"), "batch").alias("last"))
    return newest.filter("not last.removed").select("key", "last.value")


@query("late_by_source", f"""WITH {LOG}, arrived AS (SELECT *, epoch_us(ts) + CAST(amount * 1000000 AS BIGINT) AS arrival FROM log),
  seen AS (SELECT *, max(ts) OVER (PARTITION BY destination ORDER BY arrival, "offset" ROWS UNBOUNDED PRECEDING) AS stream_time FROM arrived)
  SELECT destination, "offset", ts < stream_time - INTERVAL 1 MINUTE AS late FROM seen""")
def late_by_source(spark, sf):
    """As late_drop, on a stream: records take as many seconds to arrive as their value says."""
    arrival = F.timestamp_micros(F.unix_micros("timestamp") + (amount() * 1_000_000).cast("bigint"))
    log = event_log(spark, sf).withColumn("arrival", arrival).select("destination", "offset", "timestamp", "arrival")
    flag = lambda df: changing.flag_late_rows(df, [F.unix_micros("arrival"), "offset"], ["destination"], 60_000, width=3_600_000_000)
    return arriving(spark, [log], flag, "append", F.col("arrival")).select("destination", "offset", "late")
