"""Projection, filters, flat-map and headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import CONTENT_TYPE, EVENT_TYPE, JSON, header
from millrace.functions.headers import outbound_headers
from millrace.operators import rows
from millrace.plans.base import LOG, NOISY, event_log, money, noisy_log, query, shown, table
from millrace.session import working_path
from millrace.streaming import runner

WORDS_SQL = r"""words AS (SELECT {id}, unnest(CASE WHEN text = '' THEN [''] ELSE list_filter(parts,
    lambda w, i: w <> '' OR (i = 1 AND len(parts) > 1 AND parts[2] <> '')) END) AS word
  FROM (SELECT {id}, text, regexp_split_to_array(lower(text), '\W+') AS parts FROM {table}))"""


@query("map_values", f"""WITH {LOG} SELECT "offset", key, upper(value) AS value FROM log""")
def map_values(spark, sf):
    return rows.map_values(event_log(spark, sf), F.upper).select("offset", "key", "value")


@query("map_rekey", f"""WITH {LOG} SELECT "offset", event_type AS key, key AS value FROM log""")
def map_rekey(spark, sf):
    return rows.rekey(event_log(spark, sf), header(EVENT_TYPE), F.col("key")).select("offset", "key", "value")


@query("filter_rows", f"""WITH {LOG} SELECT "offset", key, value FROM log WHERE event_type = 'purchase' AND k > 50""")
def filter_rows(spark, sf):
    k = F.get_json_object(F.get_json_object("value", "$.props"), "$.k").cast("int")
    kept = rows.filter_rows(event_log(spark, sf), (header(EVENT_TYPE) == "purchase") & (k > 50))
    return kept.select("offset", "key", "value")


@query("flat_map_tokens", f"""WITH {WORDS_SQL.format(id="doc_id", table="documents")}
  SELECT word, count(*) AS count FROM words GROUP BY word""")
def flat_map_tokens(spark, sf):
    words = rows.flat_map_words(table(spark, sf, "documents"), F.col("text"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query("drop_tombstones", f"""WITH {NOISY} SELECT "offset", value FROM log WHERE value IS NOT NULL""")
def drop_tombstones(spark, sf):
    return rows.drop_tombstones(noisy_log(spark, sf)).select("offset", "value")


@query("pass_tombstones", f"""WITH {NOISY} SELECT "offset", CASE WHEN value IS NOT NULL THEN upper(value) END AS value FROM log""")
def pass_tombstones(spark, sf):
    return rows.pass_tombstones(noisy_log(spark, sf), F.upper).select("offset", "value")


@query("headers_enrich", f"""WITH {LOG} SELECT "offset", 'contentType=application/json;event_type=' || upper(event_type) || ';user=' || key AS headers FROM log""")
def headers_enrich(spark, sf):
    enriched = rows.enrich_headers(event_log(spark, sf), {
        CONTENT_TYPE: JSON, EVENT_TYPE: F.upper(header(EVENT_TYPE)), "user": F.col("key")})
    return enriched.select("offset", shown().alias("headers"))


@query("headers_map", f"""WITH {LOG} SELECT "offset", 'event_type=' || event_type || ';x-user=' || key AS headers FROM log""")
def headers_map(spark, sf):
    log = event_log(spark, sf, **{"id": "1", "timestamp": F.col("ts").cast("string"), "x-secret-token": "s",
                                  "x-user": F.col("user_id"), "other": "o"})
    kept = log.withColumn("headers", outbound_headers(["!x-secret*", "x-*", "event*"]))
    return kept.select("offset", shown().alias("headers"))


@query("observe_rows", """SELECT event_type, count(*) AS seen FROM events GROUP BY event_type
  UNION ALL SELECT 'largest user', max(user_id) FROM events""")
def observe_rows(spark, sf):
    log, seen = rows.observe(event_log(spark, sf), "events", largest=F.max(F.col("key").cast("bigint")))
    counts = log.groupBy(header(EVENT_TYPE).alias("event_type")).agg(F.count(F.lit(1)).alias("seen"))
    folder = working_path(spark, "counts")
    counts.write.parquet(folder)  # the metrics are there once the rows have passed
    tapped = spark.read.parquet(folder)
    total = spark.range(1).select(F.lit("largest user").alias("event_type"), F.lit(seen.get["largest"]).cast("bigint").alias("seen"))
    return tapped.unionByName(total)


@query("post_process", """SELECT count(*) AS sent, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events""")
def post_process(spark, sf):
    schema = table(spark, sf, "events").schema
    events = runner.stream_table(spark, sf, "events.parquet", schema)
    folder = working_path(spark, "outputs")

    def tally(batch, batch_id):
        sent = batch.agg(F.count(F.lit(1)).alias("sent"), F.sum(money("value")).alias("value"))
        sent.write.mode("overwrite").parquet(f"{folder}/tally/batch={batch_id}")

    def never(batch, batch_id):
        raise RuntimeError("only the last action runs")

    write = runner.write_outputs({"sent": lambda b: b.select("event_id")}, folder)
    runner.run_available(events, runner.then(write, never, tally), working_path(spark, "group"))
    totals = runner.read_output(spark, folder, "tally")
    return totals.agg(F.sum("sent").alias("sent"), F.sum("value").cast("double").alias("value"))
