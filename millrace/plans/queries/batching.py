"""Batches and lag."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import header, header_map
from millrace.operators import batches
from millrace.operators.lag import lag
from millrace.plans.base import LOG, NUMBERED, event_log, hour, query, stored_events, table
from millrace.plans.queries.consumption import committed
from millrace.session import working_path
from millrace.sources.log import read_log, store_commits, stored_positions

_GROUP = ["destination"]


@query("batch_assemble", f"""WITH {LOG}, numbered AS (SELECT *, row_number() OVER (PARTITION BY destination ORDER BY "offset") - 1 AS n FROM log)
  SELECT destination, CAST(n // 16 AS BIGINT) AS batch, count(*) AS size, string_agg(key, ',' ORDER BY n) AS keys FROM numbered GROUP BY ALL""")
def batch_assemble(spark, sf):
    log = event_log(spark, sf).withColumn("value", F.col("key"))
    cut = batches.assemble(log, _GROUP, [F.col("offset")], 16, F.floor(F.col("offset") / 1000))
    keys = F.array_join(F.transform("items", lambda i: i["value"]), ",")
    return cut.select("destination", "batch", F.size("items").cast("bigint").alias("size"), keys.alias("keys"))


_BUFFER_SQL = f"""WITH RECURSIVE {LOG}, numbered AS (SELECT destination, ms, length(value) + 4 AS size,
    row_number() OVER (PARTITION BY destination ORDER BY ts, "offset") - 1 AS n FROM log),
  walk AS (SELECT destination, n, ms, 1 AS count, size AS used, n AS batch FROM numbered WHERE n = 0
    UNION ALL SELECT x.destination, x.n, x.ms,
      CASE WHEN fresh THEN 1 ELSE x.count + 1 END, CASE WHEN fresh THEN size ELSE x.used + size END, CASE WHEN fresh THEN x.n ELSE x.batch END
    FROM (SELECT r.destination, r.n, r.ms, r.size, w.count, w.used, w.batch,
        w.count >= 12 OR w.used >= 700 OR w.used + r.size > 700 OR r.ms - w.ms >= 3600000 AS fresh
      FROM walk w JOIN numbered r ON r.destination = w.destination AND r.n = w.n + 1) x)
  SELECT destination, batch, count(*) AS size, max(n) AS last FROM walk GROUP BY ALL"""


@query("batch_buffer", _BUFFER_SQL)
def batch_buffer(spark, sf):
    order = [F.col("timestamp"), F.col("offset")]
    buffered = batches.buffer(event_log(spark, sf), _GROUP, order, 12, 700, 3_600_000, hour(), chunk=500)
    return buffered.groupBy("destination", "batch").agg(F.count(F.lit(1)).alias("size"), F.max("position").alias("last"))


def _order_batches(spark, sf):
    """A batch for each order, of its lines by line number; lines that were returned are tombstones."""
    lines = table(spark, sf, "lineitem")
    # Line numbers repeat within an order; the part and supplier tell the lines apart.
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = lines.select(
        "l_orderkey", at.alias("at"), F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("value"),
        header_map({"line": F.col("l_linenumber")}).alias("headers"))
    return batches.build(rows, ["l_orderkey"], "at", {"source": "lineitem"})


_LINES = """lines AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN CAST(l_partkey AS VARCHAR) END AS value,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS index FROM lineitem)"""


@query("batch_build", f"""WITH {_LINES} SELECT l_orderkey, string_agg(value, ',' ORDER BY index) AS payloads,
  string_agg(l_linenumber, ',' ORDER BY index) AS lines, 'source=lineitem' AS root FROM lines GROUP BY l_orderkey""")
def batch_build(spark, sf):
    built = _order_batches(spark, sf)
    payloads = F.transform("items", lambda i: i["value"])
    shown = F.when(F.exists(payloads, lambda v: v.isNotNull()), F.array_join(payloads, ","))
    return built.select("l_orderkey", shown.alias("payloads"),
                        F.array_join(F.transform("items", lambda i: i["headers"]["line"]), ",").alias("lines"),
                        F.concat(F.lit("source="), header("source")).alias("root"))


@query("batch_explode", f"""WITH {_LINES} SELECT l_orderkey, index, value, CAST(l_linenumber AS VARCHAR) AS line FROM lines""")
def batch_explode(spark, sf):
    items = batches.explode(_order_batches(spark, sf))
    return items.select("l_orderkey", F.col("index").cast("bigint").alias("index"), "value", header("line").alias("line"))


@query("batch_nulls", f"""WITH {_LINES} SELECT l_orderkey, index FROM lines WHERE value IS NULL""")
def batch_nulls(spark, sf):
    items = batches.explode(_order_batches(spark, sf))
    return items.filter(F.col("value").isNull()).select("l_orderkey", F.col("index").cast("bigint").alias("index"))


@query("batch_nested", f"""WITH {_LINES} SELECT l_orderkey, index, value AS element FROM lines""")
def batch_nested(spark, sf):
    values = F.transform("items", lambda i: i["value"])
    lists = _order_batches(spark, sf).select("l_orderkey", F.to_json(values).alias("payload"))
    nested = batches.explode_nested(lists, F.col("payload"))
    return nested.select("l_orderkey", F.col("index").cast("bigint").alias("index"), "element")


@query("lag_group", f"""WITH {LOG}, committed AS (SELECT destination, "partition", max("offset") + 1 AS committed FROM {NUMBERED}
    WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY ALL),
  ends AS (SELECT destination, "partition", min("offset") AS first, max("offset") + 1 AS last FROM {NUMBERED} GROUP BY ALL)
  SELECT 'audit' AS "group", destination, CAST(sum(last - coalesce(committed, first)) AS BIGINT) AS lag
    FROM ends LEFT JOIN committed USING (destination, "partition") GROUP BY ALL
  UNION ALL SELECT 'new', destination, CAST(sum(last - first) AS BIGINT) FROM ends GROUP BY ALL""")
def lag_group(spark, sf):
    path = stored_events(spark, sf)
    commits = store_commits(committed(read_log(spark, path)), working_path(spark, "commits"))
    return lag(None, commits, ["audit", "new"], stored_positions(spark, path))
