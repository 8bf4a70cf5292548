"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.envelope import epoch_ms, to_envelope
from millrace.functions.content import decode_json
from millrace.operators import joins, routing, rows
from millrace.operators.aggregates import reduce_by
from millrace.operators.tables import latest
from millrace.plans.base import LOG, event_log, hour, query, table
from millrace.plans.queries.conversion import EVENT

_REGIONS_SQL = """regions AS (SELECT CAST(c_custkey AS VARCHAR) AS key, r_name AS region FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 0)"""


def user_regions(spark, sf) -> DataFrame:
    """Changelog of each user's region; customers in debt have left, which their null value says."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.when(F.col("c_acctbal") > 0, F.col("r_name"))
    return to_envelope(customers, "regions", region, key=F.col("c_custkey"), offset=F.col("c_custkey"),
                       timestamp=F.lit("2024-01-01").cast("timestamp"))


def clicks(log: DataFrame) -> DataFrame:
    amount = decode_json(F.col("value"), EVENT)["value"]
    return routing.by_event_type(log, "click").withColumn("amount", amount)


def clicks_per_region(log: DataFrame, regions: DataFrame, how: str = "left") -> DataFrame:
    """Sum of the clicks in each region, `UNKNOWN` for users without one. Runs on batch and stream."""
    table_now = latest(regions).withColumnRenamed("value", "region")
    joined = joins.join_table(clicks(log), table_now, how, {"region": "UNKNOWN"})
    rekeyed = rows.rekey(joined, F.col("region"), F.col("amount"))
    return reduce_by(rekeyed, ["key"], clicks=F.count(F.lit(1)), value=F.sum("value").cast("double"))


def _per_region_sql(how):
    return f"""WITH {LOG}, {_REGIONS_SQL} SELECT coalesce(region, 'UNKNOWN') AS key, count(*) AS clicks,
  CAST(sum(amount) AS DOUBLE) AS value FROM log {how} JOIN regions USING (key) WHERE event_type = 'click' GROUP BY ALL"""


@query("join_stream_table_left", _per_region_sql("LEFT"))
def join_stream_table_left(spark, sf):
    return clicks_per_region(event_log(spark, sf), user_regions(spark, sf))


@query("join_stream_table_inner", _per_region_sql("INNER"))
def join_stream_table_inner(spark, sf):
    return clicks_per_region(event_log(spark, sf), user_regions(spark, sf), "inner")


@query("join_global", """SELECT l_orderkey, l_linenumber, c_name AS customer, p_name AS part FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""")
def join_global(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("customer"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("part"))
    enriched = joins.join_global(joins.join_global(lines, orders, F.col("l_orderkey")), customers, F.col("o_custkey"))
    return joins.join_global(enriched, parts, F.col("l_partkey")).select("l_orderkey", "l_linenumber", "customer", "part")


@query("join_interval", f"""WITH {LOG} SELECT a.key, a."offset" AS click, b."offset" AS purchase FROM log a JOIN log b
  ON a.key = b.key AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 3600000000 WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def join_interval(spark, sf):
    log = event_log(spark, sf)
    left = routing.by_event_type(log, "click").select("key", F.col("timestamp").alias("clicked"), F.col("offset").alias("click"))
    right = routing.by_event_type(log, "purchase").select("key", F.col("timestamp").alias("purchased"), F.col("offset").alias("purchase"))
    return joins.join_interval(left, right, 3_600_000, ("clicked", "purchased")).select("key", "click", "purchase")


@query("join_asof", f"""WITH {LOG} SELECT p."offset", p.key, p.ms AS timestamp_ms, CAST(s.amount AS DOUBLE) AS plan
  FROM (SELECT * FROM log WHERE event_type = 'purchase') p
  ASOF LEFT JOIN (SELECT * FROM log WHERE event_type = 'signup') s ON p.key = s.key AND p.ts >= s.ts""")
def join_asof(spark, sf):
    log = event_log(spark, sf).withColumn("amount", F.get_json_object("value", "$.value").cast("decimal(18,2)"))
    purchases = routing.by_event_type(log, "purchase").select("key", "timestamp", "offset")
    signups = routing.by_event_type(log, "signup").select("key", "timestamp", "offset", F.col("amount").alias("plan"))
    out = joins.join_asof(purchases, signups, ["plan"], "offset", slice_by=hour())
    return out.select("offset", "key", epoch_ms("timestamp").alias("timestamp_ms"), F.col("plan").cast("double").alias("plan"))
