"""Content types, decoding and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import CONTENT_TYPE, header, header_map
from millrace.functions import content, embedded
from millrace.operators.aggregates import collect
from millrace.plans.base import LOG, NOISY, event_log, noisy_log, query, shown, table

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("value", T.DecimalType(18, 2)),
    T.StructField("props", T.StringType()),
])


def _typed(event_type):
    """A content type for each type of event; views have none and take the binding's."""
    return (F.when(event_type == "click", '"text/plain"').when(event_type == "error", "application/x-custom")
            .when(event_type == "purchase", "application/json;charset=UTF-8")
            .when(event_type == "signup", "application/octet-stream"))


_TYPE_SQL = """CASE event_type WHEN 'click' THEN 'text/plain' WHEN 'error' THEN 'application/x-custom'
  WHEN 'purchase' THEN 'application/json;charset=UTF-8' WHEN 'signup' THEN 'application/octet-stream'
  ELSE 'application/json' END"""


@query("ct_resolve", f"""WITH {LOG} SELECT "offset", {_TYPE_SQL} AS content_type FROM log""")
def ct_resolve(spark, sf):
    log = event_log(spark, sf, **{CONTENT_TYPE: _typed(F.col("event_type"))})
    return log.select("offset", content.content_type().alias("content_type"))


@query("decode_json", """SELECT event_id AS "offset", event_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def decode_json(spark, sf):
    data = content.decode_json(F.col("value"), EVENT)
    k = F.from_json("data.props", "k bigint")["k"]
    return event_log(spark, sf).withColumn("data", data).select(
        "offset", "data.event_id", F.col("data.value").cast("double").alias("value"), k.alias("k"))


@query("decode_bytes", """SELECT doc_id, octet_length(encode(text)) AS size, md5(text) AS digest FROM documents""")
def decode_bytes(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("value"),
                                                header_map({CONTENT_TYPE: "application/octet-stream"}).alias("headers"))
    data = F.when(content.is_bytes(content.content_type()), F.col("value"))
    return docs.select("doc_id", F.length(data).cast("bigint").alias("size"), F.md5(data).alias("digest"))


@query("decode_text", """SELECT conv_id, turn, text, array_to_string(string_split(text, ' '), '|') AS parts FROM conversations""")
def decode_text(spark, sf):
    rows = table(spark, sf, "conversations").withColumns({
        "value": F.encode("text", "UTF-8"),
        "listed": F.transform(F.split("text", " "), lambda w: F.encode(w, "UTF-8"))})
    return rows.select("conv_id", "turn", content.decode_text(F.col("value")).alias("text"),
                       F.array_join(content.decode_text(F.col("listed"), listed=True), "|").alias("parts"))


@query("decode_auto", f"""WITH {NOISY} SELECT "offset",
  CASE WHEN event_type IN ('purchase', 'view') THEN "offset" END AS event_id,
  CASE WHEN event_type = 'click' THEN value END AS text,
  CASE WHEN event_type = 'signup' THEN CAST(length(value) AS BIGINT) END AS size,
  CASE WHEN event_type = 'error' THEN 'ConversionException' END AS error FROM log""")
def decode_auto(spark, sf):
    log = noisy_log(spark, sf, **{CONTENT_TYPE: _typed(F.col("event_type"))})
    decoded = content.decode(log, EVENT)
    return decoded.select("offset", "data.event_id", "text", F.length("bytes").cast("bigint").alias("size"), "error")


@query("encode_auto", f"""WITH {LOG} SELECT "offset",
  CASE event_type WHEN 'click' THEN '{{' || "offset" || ', ' || key || '}}' WHEN 'signup' THEN 'raw' WHEN 'error' THEN NULL
    ELSE '{{"id":' || "offset" || ',"user":"' || key || '"}}' END AS value,
  CASE event_type WHEN 'click' THEN '"text/plain"' ELSE {_TYPE_SQL} END AS content_type,
  CASE WHEN event_type = 'error' THEN 'ConversionException' END AS error FROM log""")
def encode_auto(spark, sf):
    kind = header("event_type")
    log = event_log(spark, sf, **{CONTENT_TYPE: _typed(F.col("event_type"))})
    data = F.struct(F.col("offset").alias("id"), F.col("key").alias("user"))
    out = content.encode(log, data, raw=F.when(kind == "signup", "raw"))
    return out.select("offset", "value", header(CONTENT_TYPE).alias("content_type"), "error")


@query("native_coding", """SELECT event_id AS "offset", user_id AS key, CAST(value AS DOUBLE) AS value FROM events""")
def native_coding(spark, sf):
    log = event_log(spark, sf, value=F.col("value").cast("string"))
    return content.cast_native(log, {"key": "bigint", "value": "double"}).select("offset", "key", "value")


def _tagged_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.col("html").alias("value"), header_map({
        CONTENT_TYPE: "text/html", "correlationId": F.col("page_id"), "url": F.col("url"), "dropped": "x"}).alias("headers"))


@query("encode_embedded", """SELECT page_id, 'FF03' || '0D' || hex(encode('correlationId')) ||
    printf('%08X', length(CAST(page_id AS VARCHAR)) + 2) || hex(encode('"' || page_id || '"')) ||
    '0B' || hex(encode('contentType')) || '0000000B' || hex(encode('"text/html"')) ||
    '03' || hex(encode('url')) || printf('%08X', octet_length(encode(url)) + 2) || hex(encode('"' || url || '"')) ||
    hex(encode(html)) AS bytes FROM pages""")
def encode_embedded(spark, sf):
    payload = embedded.embed_headers(F.encode("value", "UTF-8"), F.col("headers"), ["url"])
    return _tagged_pages(spark, sf).select("page_id", F.hex(payload).alias("bytes"))


@query("decode_embedded", """SELECT page_id, 'contentType=text/html;correlationId=' || page_id || ';url=' || url AS headers,
  html AS body FROM pages UNION ALL SELECT -1 - page_id, '', html FROM pages""")
def decode_embedded(spark, sf):
    pages = _tagged_pages(spark, sf)
    body = F.encode("value", "UTF-8")
    with_headers = pages.select("page_id", embedded.embed_headers(body, F.col("headers"), ["url"]).alias("payload"))
    without = pages.select((-1 - F.col("page_id")).alias("page_id"), body.alias("payload"))
    out = with_headers.unionByName(without).withColumn("_x", embedded.extract_headers(F.col("payload")))
    return out.select("page_id", shown("_x.headers").alias("headers"), F.decode("_x.body", "UTF-8").alias("body"))


@query("collect_serde", """WITH members AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
  SELECT o_custkey AS key, CAST(0 AS BIGINT) AS page,
    '[' || string_agg('"' || o_orderpriority || '"', ',' ORDER BY o_orderpriority) || ']' AS members
  FROM members GROUP BY o_custkey""")
def collect_serde(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "key")
    sets = collect(orders, ["key"], "o_orderpriority", [], "set")
    return sets.select("key", "page", F.to_json("items").alias("members"))
