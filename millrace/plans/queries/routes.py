"""Routing, branching and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, header, header_map
from millrace.functions.content import decode_json
from millrace.operators import routing
from millrace.operators.routing import QueueBinding
from millrace.plans.base import LOG, event_log, query, table
from millrace.plans.queries.conversion import EVENT
from millrace.sources.log import from_destinations


@query("route_event_type", f"""WITH {LOG} SELECT "offset", key, CAST(amount AS DOUBLE) AS value FROM log WHERE event_type IN ('click', 'view')""")
def route_event_type(spark, sf):
    kept = routing.by_event_type(event_log(spark, sf), "click,view")
    return kept.select("offset", "key", decode_json(F.col("value"), EVENT)["value"].cast("double").alias("value"))


def _routed(spark, sf, router="functionRouter"):
    kind = F.col("event_type")
    log = event_log(spark, sf, **{
        routing.DEFINITION: F.when(kind == "click", "lower"),
        routing.EXPRESSION: F.when(kind.isin("click", "view"), "by length"),
    })
    name = routing.handler_name(
        callback=F.when(header(EVENT_TYPE) == "purchase", "count"),
        expressions={"by length": F.when(F.length("key") > 1, "upper").otherwise("count")},
        default="discard")
    handlers = {"lower": F.lower, "upper": F.upper, "count": lambda v: F.length(v).cast("string"), "discard": None}
    return routing.route(log, handlers, name, router)


_ROUTED_SQL = """SELECT "offset", {}CASE WHEN event_type = 'purchase' THEN CAST(length(value) AS VARCHAR)
    WHEN event_type = 'click' THEN lower(value) WHEN length(key) > 1 THEN upper(value)
    ELSE CAST(length(value) AS VARCHAR) END AS value FROM log WHERE event_type IN ('purchase', 'click', 'view')"""


@query("route_function", f"WITH {LOG} " + _ROUTED_SQL.format(""))
def route_function(spark, sf):
    return _routed(spark, sf).select("offset", "value")


@query("route_reply", f"WITH {LOG} " + _ROUTED_SQL.format("'shop-out-0' AS destination, "))
def route_reply(spark, sf):
    return _routed(spark, sf, "shop").select("offset", "destination", "value")


def _languages(docs):
    return [F.lower("lang") == "en", F.lower("lang") == "fr", F.col("n_chars") > 500]


@query("branch_first", """SELECT doc_id, CAST(CASE WHEN lower(lang) = 'en' THEN 0 WHEN lower(lang) = 'fr' THEN 1 ELSE 2 END AS BIGINT) AS branch
  FROM documents WHERE lower(lang) IN ('en', 'fr') OR n_chars > 500""")
def branch_first(spark, sf):
    docs = table(spark, sf, "documents")
    return routing.branch(docs, _languages(docs)).select("doc_id", F.col("branch").cast("bigint").alias("branch"))


@query("multi_output", """SELECT doc_id, CASE WHEN lower(lang) = 'en' THEN 'split-out-0' WHEN lower(lang) = 'fr' THEN 'split-out-1'
  WHEN n_chars > 500 THEN 'split-out-2' ELSE 'split-out-3' END AS destination FROM documents""")
def multi_output(spark, sf):
    docs = table(spark, sf, "documents")
    number = routing.branch_number(_languages(docs), default_branch=True)
    return routing.to_outputs(docs, "split", number).select("doc_id", "destination")


@query("merge_streams", f"""WITH {LOG} SELECT "offset", value FROM log WHERE event_type IN ('click', 'view')
  UNION ALL SELECT "offset", value FROM log WHERE event_type = 'click'""")
def merge_streams(spark, sf):
    log = event_log(spark, sf)
    merged = routing.merge(from_destinations(log, "events.click"), from_destinations(log, "events.view"),
                           from_destinations(log, "events.click"))
    return merged.select("offset", "value")


_TOPIC = [QueueBinding("english", "en.#"), QueueBinding("first", "*.src1"), QueueBinding("first", "fr.*"),
          QueueBinding("all", "#"), QueueBinding("deep", "*.*.#")]
_HEADERS = [QueueBinding("french one", arguments={"lang": "fr", "source": "src1"}),
            QueueBinding("either", arguments={"lang": "de", "source": "src2"}, match_all=False)]

_BOUND_SQL = """bound AS (SELECT doc_id, lang, source,
    list_filter([CASE WHEN lang = 'en' THEN 'english' END, CASE WHEN source = 'src1' OR lang = 'fr' THEN 'first' END, 'all', 'deep'],
      lambda q: q IS NOT NULL) AS topic,
    list_filter([CASE WHEN lang = 'fr' AND source = 'src1' THEN 'french one' END, CASE WHEN lang = 'de' OR source = 'src2' THEN 'either' END],
      lambda q: q IS NOT NULL) AS by_headers,
    CASE lang || '.' || source WHEN 'en.src3' THEN ['three', 'extra'] WHEN 'fr.src3' THEN ['three'] ELSE [] END AS direct
  FROM documents)"""


def _documents(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.concat_ws(".", "lang", "source").alias("key"),
                       header_map({"lang": F.col("lang"), "source": F.col("source")}).alias("headers"))


_DIRECT = [QueueBinding("three", "en.src3"), QueueBinding("three", "fr.src3"), QueueBinding("extra", "en.src3"), QueueBinding("three", "en.src3")]


_EXCHANGES_SQL = f"""WITH {_BOUND_SQL} SELECT doc_id, 'topic' AS exchange, unnest(topic) AS queue FROM bound
  UNION ALL SELECT doc_id, 'headers', unnest(by_headers) FROM bound
  UNION ALL SELECT doc_id, 'direct', unnest(direct) FROM bound
  UNION ALL SELECT doc_id, 'fanout', unnest(['english', 'first', 'all', 'deep']) FROM bound"""


@query("route_exchange", _EXCHANGES_SQL)
def route_exchange(spark, sf):
    docs, key = _documents(spark, sf), F.col("key")
    # All exchanges in one pass over the messages.
    bound = F.array(*[
        F.struct(F.lit(kind).alias("exchange"), routing.queues(kind, bindings, key).alias("queues"))
        for kind, bindings in [("topic", _TOPIC), ("headers", _HEADERS), ("direct", _DIRECT), ("fanout", _TOPIC)]])
    each = docs.select("doc_id", F.inline(bound))
    return each.select("doc_id", "exchange", F.explode("queues").alias("queue"))


@query("route_exchange_table", _EXCHANGES_SQL)
def route_exchange_table(spark, sf):
    """As route_exchange, with the bindings in tables."""
    docs, out = _documents(spark, sf), []
    for kind, bindings in [("topic", _TOPIC), ("headers", _HEADERS), ("direct", _DIRECT), ("fanout", _TOPIC)]:
        bound = spark.createDataFrame([(b.queue, b.key, dict(b.arguments), b.match_all) for b in bindings], "queue string, key string, arguments map<string,string>, match_all boolean")
        out.append(routing.route_by_table(docs, kind, bound, F.col("key")).select("doc_id", F.lit(kind).alias("exchange"), "queue"))
    return routing.merge(*out)


@query("route_alternate", f"""WITH {_BOUND_SQL} SELECT doc_id, unnest(CASE WHEN len(by_headers) > 0 THEN by_headers ELSE ['unrouted'] END) AS queue FROM bound""")
def route_alternate(spark, sf):
    docs, key = _documents(spark, sf), F.col("key")
    main = routing.queues("headers", _HEADERS, key)
    return routing.route_alternate(docs, main, routing.queues("topic", [QueueBinding("unrouted")], key)).select("doc_id", "queue")
