"""Tables and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, epoch_ms, header
from millrace.functions.hashing import default_selector
from millrace.operators import aggregates, tables
from millrace.plans.base import LOG, NOISY, event_log, hour, noisy_log, query, table
from millrace.plans.queries.partitions import HASH_SQL, SIGNED_SQL
from millrace.session import working_path
from millrace.sinks.outputs import append
from millrace.streaming.state import count_in_stores

LATEST = """latest AS (SELECT key, last_value AS value FROM (
    SELECT key, arg_max({'v': value}, "offset").v AS last_value FROM log GROUP BY key) WHERE last_value IS NOT NULL)"""


@query("tbl_latest", f"""WITH {NOISY}, {LATEST} SELECT * FROM latest""")
def tbl_latest(spark, sf):
    return tables.latest(noisy_log(spark, sf))


@query("tbl_changelog", f"""WITH {LOG}, seen AS (SELECT key, "offset", event_type AS new, lag(event_type) OVER (PARTITION BY key ORDER BY ts, "offset") AS old FROM log)
  SELECT key, "offset", old, new FROM seen WHERE old IS DISTINCT FROM new""")
def tbl_changelog(spark, sf):
    log = event_log(spark, sf).withColumn("value", header(EVENT_TYPE))
    return tables.changelog(log, hour()).select("key", "offset", "old", F.col("value").alias("new"))


@query("tbl_compact", f"""WITH {NOISY} SELECT destination, key, "offset", ms AS timestamp_ms, value FROM log
  QUALIFY row_number() OVER (PARTITION BY destination, "partition", key ORDER BY "offset" DESC) = 1""")
def tbl_compact(spark, sf):
    return tables.compact(noisy_log(spark, sf)).select("destination", "key", "offset", epoch_ms("timestamp").alias("timestamp_ms"), "value")


@query("tbl_compact_stored", f"""WITH {NOISY}, numbered AS (SELECT * EXCLUDE ("offset"), row_number() OVER (PARTITION BY destination, "partition" ORDER BY ts, "offset") - 1 AS "offset" FROM log)
  SELECT destination, key, "offset", ms AS timestamp_ms, value FROM numbered
  QUALIFY row_number() OVER (PARTITION BY destination, "partition", key ORDER BY "offset" DESC) = 1""")
def tbl_compact_stored(spark, sf):
    """Appended in two goes and compacted after each: the second time only the later records and their buckets are read."""
    path, out, log = working_path(spark, "log"), working_path(spark, "compacted"), noisy_log(spark, sf)
    early = F.coalesce(F.col("timestamp") < "2024-01-25", F.lit(True))
    for part in (log.filter(early), log.filter(~early)):
        append(part, path, F.col("offset"), hour())
        compacted = tables.compact_log(spark, path, out)
    return compacted.select("destination", "key", "offset", epoch_ms("timestamp").alias("timestamp_ms"), "value")


@query("tbl_materialize", f"""WITH {NOISY}, {LATEST} SELECT count(*) AS keys, min(key) AS first, max(key) AS last FROM latest""")
def tbl_materialize(spark, sf):
    tables.materialize(tables.latest(noisy_log(spark, sf)), "latest_event", working_path(spark, "store"))
    return spark.sql("SELECT count(*) AS keys, min(key) AS first, max(key) AS last FROM latest_event")


@query("state_process", f"""WITH {LOG}, windows AS (SELECT key, epoch_us(date_trunc('day', ts)) // 1000 AS start_ms, count(*) AS count FROM log GROUP BY ALL)
  SELECT *, CAST(sum(count) OVER (PARTITION BY key) AS BIGINT) AS total FROM windows""")
def state_process(spark, sf):
    counted = count_in_stores(event_log(spark, sf), "1 day")
    return counted.select("key", F.unix_millis("start").alias("start_ms"), "count", "total")


@query("state_get", f"""WITH {LOG}, store AS (SELECT key, count(*) AS count FROM log GROUP BY key)
  SELECT CAST(c_custkey AS VARCHAR) AS key, count FROM customer LEFT JOIN store ON CAST(c_custkey AS VARCHAR) = key""")
def state_get(spark, sf):
    store = aggregates.count_by(event_log(spark, sf), "key")
    keys = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return tables.get(keys, store)


@query("state_locate", f"""SELECT c_name AS key, abs({SIGNED_SQL.format(h=HASH_SQL.format(c="c_name"))}) % 8 AS "partition" FROM customer""")
def state_locate(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_name").alias("key"))
    return tables.locate(keys, default_selector(F.col("key")) % 8)
