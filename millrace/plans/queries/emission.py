"""Sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import CONTENT_TYPE, EVENT_TYPE, header, header_map, to_envelope
from millrace.operators.partitioning import Partitioning
from millrace.operators.routing import QueueBinding, queues
from millrace.plans.base import LOG, NOISY, event_log, hour, money, noisy_log, query, shown, table
from millrace.session import working_path
from millrace.sinks import outputs as out
from millrace.sources.log import assign_offsets, read_log
from millrace.streaming import runner

_ROW = ["destination", "partition", "offset"]


@query("sink_append", f"""WITH {NOISY} SELECT 'replies' AS destination, "partition",
  row_number() OVER (PARTITION BY "partition" ORDER BY ts, "offset") - 1 AS "offset", CAST(length(value) AS BIGINT) AS size,
  'contentType=text/plain;event_type=' || event_type || ';source=app' AS headers FROM log WHERE value IS NOT NULL""")
def sink_append(spark, sf):
    log = noisy_log(spark, sf, source="app").withColumnRenamed("headers", "request")
    replies = log.withColumns({"value": F.length("value").cast("bigint"), "headers": header_map({CONTENT_TYPE: "text/plain"})})
    sent = out.results(replies, F.col("request")).withColumn("destination", F.lit("replies"))
    path = working_path(spark, "log")
    out.append(sent, path, F.col("offset"), hour())
    return read_log(spark, path).select(*_ROW, F.col("value").cast("bigint").alias("size"), shown().alias("headers"))


@query("sink_split", """SELECT conv_id, turn, CAST(i - 1 AS BIGINT) AS index, parts[i] AS value FROM (
  SELECT conv_id, turn, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
    SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations))""")
def sink_split(spark, sf):
    lines = table(spark, sf, "conversations").withColumn("results", F.split("text", "\n"))
    return out.split(lines).select("conv_id", "turn", F.col("index").cast("bigint").alias("index"), "value")


def _orders(spark, sf, header_name):
    large = F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("orders."), "o_orderstatus"))
    return to_envelope(table(spark, sf, "orders"), "orders", F.to_json(F.struct("o_orderkey")), key=F.col("o_custkey"),
                       timestamp=F.col("o_orderdate"), headers={header_name: large}, offset=F.col("o_orderkey"))


_DYNAMIC = """SELECT o_orderkey AS "offset", CAST(0 AS BIGINT) AS left_headers,
  CASE WHEN o_totalprice > 250000 THEN 'orders.' || o_orderstatus ELSE 'orders.out' END AS destination FROM orders"""


@query("sink_dynamic", _DYNAMIC)
def sink_dynamic(spark, sf):
    sent = out.dynamic_destination(_orders(spark, sf, out.SEND_TO), "orders.out")
    return sent.select("offset", F.size("headers").cast("bigint").alias("left_headers"), "destination")


@query("sink_topic_header", _DYNAMIC)
def sink_topic_header(spark, sf):
    sent = out.dynamic_destination(_orders(spark, sf, "kafka_topic"), "orders.out", "kafka_topic")
    return sent.select("offset", F.size("headers").cast("bigint").alias("left_headers"), "destination")


@query("sink_bridge", """SELECT 'shop' AS destination, CAST(o_custkey % 6 AS BIGINT) AS "partition",
  row_number() OVER (PARTITION BY o_custkey % 6 ORDER BY o_orderkey % 2, o_orderkey) - 1 AS "offset",
  '{"o_orderkey":' || o_orderkey || ',"total":' || CAST(o_totalprice AS DECIMAL(18,2)) || '}' AS value,
  'contentType=application/json;scst_partition=' || (o_custkey % 6) AS headers FROM orders""")
def sink_bridge(spark, sf):
    rows = table(spark, sf, "orders").withColumn("headers", header_map({}))
    data = F.struct("o_orderkey", money("o_totalprice").alias("total"))
    path = working_path(spark, "log")
    # Sent twice; the second time goes on where the first one ended.
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        placed = rows.filter(part).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
        out.send(placed, path, "shop", data, F.col("o_orderkey"), partitioning=Partitioning(F.col("o_custkey"), 6, "bigint"))
    sent = read_log(spark, path)
    return sent.select("destination", F.col("partition").cast("bigint").alias("partition"), "offset", "value", shown().alias("headers"))


@query("sink_multi_txn", """SELECT 'ids' AS destination, event_id FROM events
  UNION ALL SELECT 'large', event_id FROM events WHERE value > 100""")
def sink_multi_txn(spark, sf):
    schema = table(spark, sf, "events").schema
    events = runner.stream_table(spark, sf, "events.parquet", schema)
    folder = working_path(spark, "outputs")
    write = runner.write_outputs({"ids": lambda b: b.select("event_id"),
                                  "large": lambda b: b.filter("value > 100").select("event_id")}, folder)
    runner.run_available(events, write, working_path(spark, "group"))
    return runner.read_output(spark, folder, "ids").select(F.lit("ids").alias("destination"), "event_id").unionByName(
        runner.read_output(spark, folder, "large").select(F.lit("large").alias("destination"), "event_id"))


@query("sink_receipts", f"""WITH {LOG}, numbered AS (SELECT *, row_number() OVER (
    PARTITION BY destination, "partition" ORDER BY ts, "offset") - 1 AS o FROM log)
  SELECT 'receipts' AS destination, key,
    '{{"destination":"' || destination || '","partition":' || "partition" || ',"offset":' || o || '}}' AS value FROM numbered""")
def sink_receipts(spark, sf):
    sent = assign_offsets(event_log(spark, sf), F.col("offset"), hour())
    return out.receipts(sent).select("destination", "key", "value")


@query("sink_confirm", """SELECT doc_id,
  CASE WHEN lang = 'en' OR source IN ('src1', 'src2') THEN 'acknowledged' ELSE 'returned' END AS outcome FROM documents""")
def sink_confirm(spark, sf):
    docs = table(spark, sf, "documents")
    key = F.concat_ws(".", "lang", "source")
    bound = queues("topic", [QueueBinding("english", "en.#"), QueueBinding("first", "*.src1"), QueueBinding("first", "*.src2")], key)
    taken, returned = out.confirmations(docs, bound)
    return taken.select("doc_id", F.lit("acknowledged").alias("outcome")).unionByName(
        returned.select("doc_id", F.lit("returned").alias("outcome")))


@query("sink_delay", f"""WITH {LOG} SELECT "offset", CAST(amount * 3600000 AS BIGINT) AS delay,
  ms + CAST(amount * 3600000 AS BIGINT) AS deliver_ms FROM log
  WHERE ms + CAST(amount * 3600000 AS BIGINT) <= epoch_ms(TIMESTAMP '2024-01-20')""")
def sink_delay(spark, sf):
    amount = F.get_json_object("value", "$.value").cast("decimal(18,2)")
    delayed = out.delay(event_log(spark, sf), amount * 3_600_000)
    ready = out.due(delayed, F.lit("2024-01-20").cast("timestamp"))
    return ready.select("offset", header(out.DELAY).cast("bigint").alias("delay"), F.unix_millis("deliver_at").alias("deliver_ms"))


@query("sink_key", f"""WITH {LOG} SELECT "offset", event_type || '-' || "offset" AS key FROM log""")
def sink_key(spark, sf):
    key = F.concat_ws("-", header(EVENT_TYPE), F.get_json_object("value", "$.event_id"))
    return out.with_key(event_log(spark, sf), key).select("offset", "key")
