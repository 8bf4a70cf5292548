"""User functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, header
from millrace.operators import routing, rows
from millrace.operators.aggregates import count_by
from millrace.operators.joins import join_table
from millrace.operators.tables import latest
from millrace.plans import compose
from millrace.plans.base import LOG, event_log, hour, money, query, table
from millrace.plans.queries.joining import _REGIONS_SQL, user_regions
from millrace.session import working_path
from millrace.streaming import runner


@query("fn_apply", f"""WITH {LOG}, {_REGIONS_SQL} SELECT "offset", region FROM log JOIN regions USING (key)""")
def fn_apply(spark, sf):
    def with_region(stream, changes):
        return join_table(stream, latest(changes).withColumnRenamed("value", "region"), "inner")

    return compose.apply(with_region, event_log(spark, sf), user_regions(spark, sf)).select("offset", "region")


@query("fn_compose", f"""WITH {LOG} SELECT upper(event_type) AS key, count(*) AS count FROM log WHERE event_type IN ('click', 'view') GROUP BY ALL""")
def fn_compose(spark, sf):
    catalog = {
        "pick": lambda df: routing.by_event_type(df, "click,view"),
        "rename": lambda df: rows.rekey(df, F.upper(header(EVENT_TYPE))),
        "count": lambda df: count_by(df, "key"),
    }
    functions = compose.from_definition("pick|rename|count", catalog)
    return compose.apply(functions["pickRenameCount"], event_log(spark, sf))


@query("fn_curry", """SELECT l_orderkey, l_linenumber, o_orderpriority AS priority, p_name AS part FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def fn_curry(spark, sf):
    @compose.curried
    def enrich(lines):
        return lambda orders: lambda parts: lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            parts, F.col("l_partkey") == F.col("p_partkey"))

    joined = compose.apply(enrich, *[table(spark, sf, t) for t in ("lineitem", "orders", "part")])
    return joined.select("l_orderkey", "l_linenumber", F.col("o_orderpriority").alias("priority"), F.col("p_name").alias("part"))


@query("fn_many", """SELECT 'clicks' AS name, event_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'large', event_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) FROM events WHERE value > 200""")
def fn_many(spark, sf):
    schema = table(spark, sf, "events").schema
    functions = {"clicks": lambda df: df.filter("event_type = 'click'"), "large": lambda df: df.filter("value > 200")}
    folder = working_path(spark, "outputs")
    runner.run_functions(lambda: runner.stream_table(spark, sf, "events.parquet", schema), functions, folder)
    outputs = [runner.read_output(spark, folder, n).select(F.lit(n).alias("name"), "event_id", money("value").cast("double").alias("value")) for n in functions]
    return routing.merge(*outputs)


@query("fn_tuple", f"""WITH {LOG} SELECT 'hourly' AS output, CAST(epoch_us(date_trunc('hour', ts)) // 1000 AS VARCHAR) AS key, count(*) AS count
    FROM log WHERE event_type IN ('click', 'purchase') GROUP BY ALL
  UNION ALL SELECT 'by user', key, count(*) FROM log WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def fn_tuple(spark, sf):
    def gather(inputs):
        merged = routing.merge(*inputs)
        hourly = merged.groupBy(F.unix_millis(hour()).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("count"))
        return hourly, count_by(merged, "key")

    log = event_log(spark, sf)
    hourly, by_user = compose.apply_tuple(gather, (routing.by_event_type(log, "click"), routing.by_event_type(log, "purchase")))
    return hourly.select(F.lit("hourly").alias("output"), "key", "count").unionByName(by_user.select(F.lit("by user").alias("output"), "key", "count"))
