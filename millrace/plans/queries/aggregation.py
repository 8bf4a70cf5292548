"""Aggregation and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, epoch_ms, header
from millrace.operators import aggregates, routing, rows, windows
from millrace.plans.base import LOG, event_log, hour, query, table, word_time
from millrace.plans.queries.rowwise import WORDS_SQL
from millrace.session import stored


def amount():
    return F.get_json_object("value", "$.value").cast("decimal(18,2)")


def _ms(c):
    return F.unix_millis(c).alias(f"{c}_ms")


@query("agg_count", f"""WITH {LOG} SELECT key, count(*) AS count FROM log GROUP BY key""")
def agg_count(spark, sf):
    return aggregates.count_by(event_log(spark, sf), "key")


@query("agg_reduce", f"""WITH {LOG} SELECT key, CAST(sum(amount) AS DOUBLE) AS total, CAST(min(amount) AS DOUBLE) AS least,
  CAST(max(amount) AS DOUBLE) AS greatest, bool_or(event_type = 'error') AS any_error FROM log GROUP BY key""")
def agg_reduce(spark, sf):
    v = amount()
    return aggregates.reduce_by(
        event_log(spark, sf), ["key"], total=F.sum(v).cast("double"), least=F.min(v).cast("double"),
        greatest=F.max(v).cast("double"), any_error=F.bool_or(header(EVENT_TYPE) == "error"))


@query("agg_reduce_custom", f"""WITH {LOG} SELECT event_type AS key,
  list_reduce(list(CAST(key AS BIGINT) ORDER BY ts, "offset"), lambda h, visitor: (h * 31 + visitor) % 1000000007) AS digest FROM log GROUP BY ALL""")
def agg_reduce_custom(spark, sf):
    """A digest of each type's visitors in order: maps x -> factor * x + add, composed, which need only two numbers."""
    prime = 1_000_000_007
    visitor = F.struct(F.lit(31).cast("bigint").alias("factor"), F.col("key").cast("bigint").alias("add"))
    log = event_log(spark, sf).select(header(EVENT_TYPE).alias("key"), visitor.alias("digest"), "timestamp", "offset")
    then = lambda a, b: F.struct((a["factor"] * b["factor"] % prime).alias("factor"),
                                 ((a["add"] * b["factor"] + b["add"]) % prime).alias("add"))
    folded = aggregates.fold(log, ["key"], "digest", [F.col("timestamp"), F.col("offset")], then, slice_by=hour(), page_size=64)
    return folded.select("key", F.col("digest.add").alias("digest"))


@query("agg_collect", f"""WITH {LOG},
  lists AS (SELECT 'list' AS kind, key, CAST("offset" AS VARCHAR) AS item, row_number() OVER (PARTITION BY key ORDER BY ts, "offset") - 1 AS n FROM log),
  sets AS (SELECT 'set' AS kind, key, event_type AS item, row_number() OVER (PARTITION BY key ORDER BY event_type) - 1 AS n
    FROM (SELECT DISTINCT key, event_type FROM log)),
  queues AS (SELECT 'priority_queue' AS kind, key, event_type AS item, row_number() OVER (PARTITION BY key ORDER BY event_type, "offset") - 1 AS n FROM log),
  items AS (SELECT * FROM lists UNION ALL SELECT * FROM sets UNION ALL SELECT * FROM queues)
  SELECT kind, key, CAST(n // 20 AS BIGINT) AS page, string_agg(item, ',' ORDER BY n) AS items FROM items GROUP BY ALL""")
def agg_collect(spark, sf):
    log = event_log(spark, sf).withColumn("kind", header(EVENT_TYPE))
    log = log.withColumn("item", F.col("offset").cast("string"))
    # What the collections are made of, read from the log once.
    log = stored(log.select("key", "kind", "item", "timestamp", "offset"), "events")
    order = [F.col("timestamp"), F.col("offset")]
    lists = aggregates.collect(log, ["key"], "item", order, "list", 20, hour())
    sets = aggregates.collect(log, ["key"], "kind", order, "set", 20)
    queues = aggregates.collect(log, ["key"], "kind", [F.col("offset")], "priority_queue", 20)
    shown = [df.select(F.lit(k).alias("kind"), "key", "page", F.array_join("items", ",").alias("items"))
             for k, df in [("list", lists), ("set", sets), ("priority_queue", queues)]]
    return routing.merge(*shown)


_TALK = f"""{WORDS_SQL.format(id="conv_id, turn", table="conversations")},
  timed AS (SELECT word, 1704067200 + conv_id * 60 + turn AS s FROM words)"""


@query("win_tumbling_count", f"""WITH {_TALK} SELECT word, count(*) AS count, (s // 5) * 5000 AS start_ms, (s // 5) * 5000 + 5000 AS end_ms
  FROM timed GROUP BY ALL""")
def win_tumbling_count(spark, sf):
    talk = table(spark, sf, "conversations").withColumn("timestamp", word_time())
    words = rows.flat_map_words(talk, F.col("text"))
    counted = windows.tumbling(words, "5 seconds", "word", count=F.count(F.lit(1)))
    return counted.select("word", "count", _ms("start"), _ms("end"))


@query("win_tumbling_rekey", f"""WITH {LOG} SELECT event_type AS key, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS total,
  epoch_us(date_trunc('day', ts)) // 1000 AS start_ms FROM log GROUP BY ALL""")
def win_tumbling_rekey(spark, sf):
    log = rows.rekey(event_log(spark, sf), header(EVENT_TYPE))
    days = windows.tumbling(log, "1 day", "key", count=F.count(F.lit(1)), total=F.sum(amount()).cast("double"))
    return days.select("key", "count", "total", _ms("start"))


@query("win_concat", """SELECT s * 5000 AS start_ms, CAST(0 AS BIGINT) AS page, string_agg(text, '' ORDER BY turn, conv_id) AS text FROM (
    SELECT *, (1704067200 + conv_id * 60 + turn) // 5 AS s FROM conversations) GROUP BY ALL""")
def win_concat(spark, sf):
    talk = table(spark, sf, "conversations").withColumn("timestamp", word_time())
    joined = windows.concat(talk, "5 seconds", "text", [F.col("timestamp"), F.col("conv_id"), F.col("turn")], slice_by=F.col("timestamp"))
    return joined.select(_ms("start"), "page", "text")


@query("win_gapfill", f"""WITH {LOG}, days AS (SELECT key, date_trunc('day', ts) AS day, count(*) AS count FROM log GROUP BY ALL),
  every AS (SELECT key, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM days GROUP BY key)
  SELECT key, epoch_us(day) // 1000 AS start_ms, coalesce(count, 0) AS count FROM every LEFT JOIN days USING (key, day)""")
def win_gapfill(spark, sf):
    days = windows.tumbling(event_log(spark, sf), "1 day", "key", count=F.count(F.lit(1))).drop("end")
    return windows.fill_gaps(days, "1 day", {"count": 0}, ["key"]).select("key", _ms("start"), "count")


@query("win_buffer", f"""WITH {LOG} SELECT epoch_us(date_trunc('hour', ts)) // 1000 AS start_ms, CAST(0 AS BIGINT) AS page,
  string_agg(CAST("offset" AS VARCHAR), ',' ORDER BY ts, "offset") AS items FROM log WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def win_buffer(spark, sf):
    log = event_log(spark, sf)
    merged = routing.merge(routing.by_event_type(log, "click"), routing.by_event_type(log, "purchase"))
    merged = merged.withColumn("item", F.col("offset").cast("string"))
    buffered = windows.gather(merged, "1 hour", "item", [F.col("timestamp"), F.col("offset")], slice_by=F.date_trunc("minute", "timestamp"))
    return buffered.select(_ms("start"), "page", F.array_join("items", ",").alias("items"))


@query("win_store", f"""WITH {LOG} SELECT key, epoch_us(date_trunc('day', ts)) // 1000 AS start_ms, count(*) AS count FROM log
  GROUP BY key, date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY > TIMESTAMP '2024-01-25' - INTERVAL 7 DAY""")
def win_store(spark, sf):
    stored = windows.store(event_log(spark, sf), "1 day", "key", retention="7 days", as_of=F.lit("2024-01-25").cast("timestamp"))
    return stored.select("key", _ms("start"), "count")


@query("late_drop", f"""WITH {LOG}, arrived AS (SELECT *, epoch_us(ts) + CAST(amount * 1000000 AS BIGINT) AS arrival FROM log),
  seen AS (SELECT *, max(ts) OVER (PARTITION BY destination ORDER BY arrival, "offset" ROWS UNBOUNDED PRECEDING) AS stream_time FROM arrived)
  SELECT destination, "offset", ts < stream_time - INTERVAL 1 MINUTE AS late FROM seen""")
def late_drop(spark, sf):
    # Records take as many seconds to arrive as their value says.
    arrival = F.timestamp_micros(F.unix_micros("timestamp") + (amount() * 1_000_000).cast("bigint"))
    arrived = event_log(spark, sf).withColumn("arrival", arrival)
    flagged = windows.flag_late(arrived, [F.col("arrival"), F.col("offset")], ["destination"], "1 minute", hour("arrival"))
    return flagged.select("destination", "offset", "late")
