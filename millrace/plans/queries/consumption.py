"""Sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, epoch_ms, header, to_envelope
from millrace.plans.base import LOG, NUMBERED, event_log, hour, query, stored_events, table
from millrace.sources import log as src

_ROW = ["destination", "partition", "offset"]

_COMMITTED = """committed AS (SELECT destination, "partition", max("offset") + 1 AS committed FROM log
  WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY ALL)"""


def committed(log):
    """A group that has read all but errors up to mid-month."""
    return src.committed_before(log, "audit", (F.col("timestamp") < "2024-01-15") & (header(EVENT_TYPE) != "error"))


@query("src_envelope", f"""WITH {LOG} SELECT destination, "partition", "offset", ms AS timestamp_ms, key, value, event_type FROM log""")
def src_envelope(spark, sf):
    return event_log(spark, sf).select(*_ROW, epoch_ms("timestamp").alias("timestamp_ms"), "key", "value",
                                       header(EVENT_TYPE).alias("event_type"))


@query("src_offsets", f"""WITH {LOG} SELECT destination, "partition",
  row_number() OVER (PARTITION BY destination, "partition" ORDER BY ts, "offset") - 1 AS "offset", "offset" AS event_id FROM log""")
def src_offsets(spark, sf):
    log = event_log(spark, sf).withColumn("event_id", F.col("offset"))
    return src.assign_offsets(log, F.col("event_id"), hour()).select(*_ROW, "event_id")


@query("src_multi", f"""WITH {LOG} SELECT destination, "partition", "offset", value FROM log
  WHERE destination IN ('events.click', 'events.view')""".replace("FROM log", f"FROM {NUMBERED}"))
def src_multi(spark, sf):
    log = src.read_log(spark, stored_events(spark, sf))
    return src.from_destinations(log, "events.click, events.view").select(*_ROW, "value")


@query("src_pattern", f"""WITH {LOG} SELECT destination, "partition", "offset", value FROM log
  WHERE regexp_full_match(destination, 'events\\.(click|s.*)')""".replace("FROM log", f"FROM {NUMBERED}"))
def src_pattern(spark, sf):
    log = src.read_log(spark, stored_events(spark, sf))
    return src.from_pattern(log, r"events\.(click|s.*)").select(*_ROW, "value")


@query("src_start", f"""WITH {LOG}, {_COMMITTED} SELECT destination, "partition", "offset" FROM log
  LEFT JOIN committed USING (destination, "partition") WHERE committed IS NULL OR "offset" >= committed""")
def src_start(spark, sf):
    log = event_log(spark, sf)
    return src.start_from(log, committed(log), "audit").select(*_ROW)


@query("src_reset", f"""WITH {LOG} SELECT destination, "partition", "offset" FROM log""")
def src_reset(spark, sf):
    log = event_log(spark, sf)
    return src.start_from(log, committed(log), "audit", reset=True).select(*_ROW)


@query("src_seek", f"""WITH {LOG}, starts AS (SELECT destination, "partition", min("offset") AS start FROM log
    WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY ALL)
  SELECT destination, "partition", "offset" FROM log LEFT JOIN starts USING (destination, "partition")
  WHERE "offset" >= coalesce(start, 0)""")
def src_seek(spark, sf):
    log = event_log(spark, sf)
    starts = log.filter(F.col("timestamp") >= "2024-01-20").groupBy(*src.LOG).agg(F.min("offset").alias("start"))
    return src.seek(log, starts).select(*_ROW)


@query("src_group", f"""WITH {LOG}, {_COMMITTED},
  both_groups AS (SELECT 'audit' AS "group", * FROM committed
    UNION ALL SELECT 'report', destination, "partition", min("offset") FROM log GROUP BY ALL)
  SELECT "group", destination, "partition", "offset" FROM log JOIN both_groups USING (destination, "partition")
  WHERE "offset" >= committed""")
def src_group(spark, sf):
    log = event_log(spark, sf)
    groups = committed(log).unionByName(src.required_groups(log, ["report"]))
    return src.for_groups(log, groups).select("group", *_ROW)


@query("src_required_groups", f"""WITH {LOG} SELECT g AS "group", destination, "partition", "offset" FROM log,
  (VALUES ('billing'), ('report')) AS groups(g)""")
def src_required_groups(spark, sf):
    log = event_log(spark, sf)
    return src.for_groups(log, src.required_groups(log, ["billing", "report"])).select("group", *_ROW)


@query("src_instances", f"""WITH {LOG} SELECT destination, "partition", "offset" FROM log WHERE "partition" % 4 IN (1, 3)""")
def src_instances(spark, sf):
    return src.for_instance(event_log(spark, sf), 4, 1, 3).select(*_ROW)


@query("src_poll", f"""WITH {LOG}, {_COMMITTED},
  rest AS (SELECT log.*, row_number() OVER (PARTITION BY destination, "partition" ORDER BY "offset") AS n FROM log
    LEFT JOIN committed USING (destination, "partition") WHERE committed IS NULL OR "offset" >= committed)
  SELECT destination, "partition",
    coalesce(min(CASE WHEN k < 5 THEN "offset" END), max("offset") + 1) AS committed, count(*) AS polled
  FROM rest WHERE n <= 10 GROUP BY ALL""")
def src_poll(spark, sf):
    k = F.get_json_object(F.get_json_object("value", "$.props"), "$.k").cast("int")
    log = event_log(spark, sf)
    polled = src.poll(log, committed(log), "audit", 10)
    settled = src.settle(polled, F.when(k < 5, "requeue").otherwise("accept"), "audit", counted=True)
    return settled.select(*src.LOG, "committed", "polled")


@query("src_ts", """SELECT o_orderkey AS "offset", epoch_ms(o_orderdate) AS timestamp_ms FROM orders""")
def src_ts(spark, sf):
    orders = table(spark, sf, "orders")
    log = to_envelope(orders, "orders", F.to_json(F.struct("o_orderkey", F.col("o_orderdate").cast("string").alias("placed"))),
                      key=F.col("o_custkey"), offset=F.col("o_orderkey"))
    timed = src.with_event_time(log, F.get_json_object("value", "$.placed"))
    return timed.select("offset", epoch_ms("timestamp").alias("timestamp_ms"))
