"""The schema registry."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.envelope import CONTENT_TYPE, header, put_headers
from millrace.functions.avro import canonical
from millrace.operators import registry
from millrace.plans.base import event_log, query, table
from millrace.session import working_path

# A visit of the shop's site: first counted in whole hits, later with the channel it came through.
_HITS = {"name": "hits", "type": "int"}
_CHANNEL = {"name": "channel", "type": "string", "default": "direct"}


def _visit(*fields):
    return {"type": "record", "name": "Visit", "namespace": "shop.web", "fields": list(fields)}


_V1 = _visit({"name": "visitor", "type": "string"}, _HITS)
V1 = json.dumps(_V1)
V1_SPACED = json.dumps(_V1, indent=2)
V2 = json.dumps(_visit({"name": "visitor", "type": "string"}, _HITS, _CHANNEL))
BROKEN = json.dumps(_visit({"name": "device", "type": "Device"}))
DEFINITIONS = [V1, V1_SPACED, V2, BROKEN]

# One definition for each rule of validity, with what is wrong with it.
INVALID = [
    (_visit({"name": "device", "type": "Device"}), "Undefined name: shop.web.Device"),
    (_visit({"name": "x", "type": ["null", ["int"]]}), 'Nested union: ["null", ["int"]]'),
    (_visit({"name": "x", "type": ["int", "string", "int"]}), "Duplicate in union: int"),
    (_visit({"name": "x", "type": {"type": "enum", "name": "Kind", "symbols": ["a", "b", "a"]}}), "Duplicate enum symbol: a"),
    (_visit({"name": "x", "type": {"type": "enum", "name": "Kind", "symbols": ["a-b"]}}), "Illegal name: a-b"),
    (_visit({**_HITS, "default": "many"}), 'Invalid default for field hits: "many"'),
    (_visit(_HITS, _HITS), "Duplicate field in record shop.web.Visit"),
    (_visit({"name": "x", "type": {"type": "array"}}), 'No items type: {"type": "array"}'),
    # Valid: an order that is the usual one.
    (_visit({**_HITS, "order": "ascending"}), None),
]


def requests(spark, sf) -> DataFrame:
    """A registration request for each event: its type is the subject, its number picks one of the
    four definitions."""
    events = table(spark, sf, "events")
    definition = F.get(F.array(*[F.lit(d) for d in DEFINITIONS]), F.pmod("event_id", F.lit(4)).cast("int"))
    return events.select(F.col("event_type").alias("subject"), F.lit("avro").alias("format"), definition.alias("definition"),
                         F.col("event_id").alias("arrival"))


def store(spark, sf) -> DataFrame:
    return registry.save(registry.register(registry.empty_store(spark), requests(spark, sf)), working_path(spark, "schemas"))


# v: which of the two valid definitions a request's text amounts to; null if it is invalid.
_STORE = """requests AS (SELECT event_type AS subject, event_id AS arrival,
    CASE event_id % 4 WHEN 0 THEN 'v1' WHEN 1 THEN 'v1' WHEN 2 THEN 'v2' END AS v, event_id % 4 AS pick FROM events),
  firsts AS (SELECT subject, v, min(arrival) AS arrival FROM requests WHERE v IS NOT NULL GROUP BY ALL),
  store AS (SELECT *, row_number() OVER (ORDER BY arrival) AS id, row_number() OVER (PARTITION BY subject ORDER BY arrival) AS version FROM firsts)"""


def _kind():
    return F.when(F.col("canonical").contains("channel"), "v2").otherwise("v1")


@query("reg_register", f"""WITH {_STORE} SELECT id, subject, version, v AS definition FROM store
  UNION ALL SELECT id, 'asked ' || r.subject, version, CAST(count(*) AS VARCHAR) FROM requests r JOIN store USING (subject, v) GROUP BY ALL""")
def reg_register(spark, sf):
    asked, registered = requests(spark, sf), store(spark, sf)
    again = registry.register(registered, asked)  # equal definitions change nothing
    answers = registry.answer(registered, asked).groupBy("id", "subject", "version").agg(F.sum("requests").alias("n"))
    return again.select("id", "subject", "version", _kind().alias("definition")).unionByName(
        answers.select("id", F.concat(F.lit("asked "), "subject").alias("subject"), "version", F.col("n").cast("string").alias("definition")))


_PROBLEMS = ", ".join(f"({n}, " + ("NULL" if p is None else f"'{p}'") + ")" for n, (_, p) in enumerate(INVALID))


@query("reg_validate", f"""SELECT event_type AS subject, problem IS NOT NULL AS invalid, problem, count(*) AS requests
  FROM events JOIN (VALUES {_PROBLEMS}) AS rules(n, problem) ON event_id % {len(INVALID)} = n GROUP BY ALL""")
def reg_validate(spark, sf):
    texts = F.array(*[F.lit(json.dumps(d)) for d, _ in INVALID])
    asked = requests(spark, sf).withColumn("definition", F.get(texts, F.pmod("arrival", F.lit(len(INVALID))).cast("int")))
    checked = registry.validate(asked)
    return checked.groupBy("subject", F.col("problem").isNotNull().alias("invalid"), "problem").agg(F.sum("requests").alias("requests"))


@query("reg_find", f"""WITH {_STORE}, wanted AS (SELECT DISTINCT event_type AS subject, user_id % 5 AS version, user_id % 20 AS id FROM events)
  SELECT DISTINCT 'version' AS by, w.subject, w.version, s.id FROM wanted w LEFT JOIN store s USING (subject, version)
  UNION ALL SELECT DISTINCT 'id', s.subject, s.version, w.id FROM wanted w LEFT JOIN store s USING (id)
  UNION ALL SELECT 'subject', subject, version, id FROM store""")
def reg_find(spark, sf):
    registered = store(spark, sf)
    wanted = table(spark, sf, "events").select(
        F.col("event_type").alias("subject"), F.lit("avro").alias("format"), (F.col("user_id") % 5).alias("version"),
        (F.col("user_id") % 20).alias("id")).distinct()

    def shown(found, missing, by):
        lacking = [F.lit(None).cast(registered.schema[c].dataType).alias(c) for c in ("subject", "version", "id") if c not in missing.columns]
        missing = missing.distinct().select("*", *lacking)
        return found.select(F.lit(by).alias("by"), "subject", "version", "id").unionByName(
            missing.select(F.lit(by).alias("by"), "subject", "version", "id"))

    by_version = shown(*registry.find(registered, wanted, "subject", "format", "version"), "version")
    by_id = shown(*registry.find(registered, wanted, "id"), "id")
    all_versions, _ = registry.find(registered, wanted, "subject", "format")
    return by_version.unionByName(by_id).unionByName(all_versions.select(F.lit("subject").alias("by"), "subject", "version", "id"))


@query("reg_delete", f"""WITH {_STORE} SELECT 'version' AS by, subject, version, id FROM store WHERE version <> 1
  UNION ALL SELECT 'subject', subject, version, id FROM store WHERE subject NOT IN (SELECT event_type FROM events WHERE value > 400)
  UNION ALL SELECT 'id', subject, version, id FROM store WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'click')""")
def reg_delete(spark, sf):
    registered, events = store(spark, sf), table(spark, sf, "events")
    subjects = events.select(F.col("event_type").alias("subject"), F.lit("avro").alias("format"), F.lit(1).cast("bigint").alias("version")).distinct()
    large = events.filter("value > 400").select(F.col("event_type").alias("subject"))
    clicked = events.filter("event_type = 'click'").select(F.col("user_id").alias("id"))
    left = {
        "version": registry.delete(registered, subjects, "subject", "format", "version", allowed=True),
        "subject": registry.delete(registered, large, "subject", allowed=True),
        "id": registry.delete(registered, clicked, "id", allowed=True),
    }
    shown = [df.select(F.lit(by).alias("by"), "subject", "version", "id") for by, df in left.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("reg_subject", """SELECT short, "full", prefixed, prefix_only, count(*) AS events FROM (
  SELECT 'visit' AS short, 'shop.web.visit' AS "full",
    'eu-shop.web.visit' AS prefixed, 'eu' AS prefix_only FROM events) GROUP BY ALL""")
def reg_subject(spark, sf):
    d = F.col("definition")
    named = requests(spark, sf).select(
        registry.subject_name(d).alias("short"), registry.subject_name(d, "full").alias("full"),
        registry.subject_name(d, "full", "eu").alias("prefixed"), registry.subject_name(d, "prefix", "eu").alias("prefix_only"))
    return named.groupBy("short", "full", "prefixed", "prefix_only").agg(F.count(F.lit(1)).alias("events"))


def _stamped(spark, sf, registered=None) -> DataFrame:
    """Events whose payload was written with one of the valid versions of their subject."""
    visits = F.struct(F.concat(F.lit("visitor "), F.col("user_id").cast("string")).alias("visitor"), F.col("event_id").cast("int").alias("hits"),
                      F.when(F.col("event_id") % 4 == 2, "mail").alias("channel"))
    events = event_log(spark, sf, value=F.to_json(visits))
    texts = spark.createDataFrame([(i, d) for i, d in enumerate(DEFINITIONS)], "pick bigint, definition string")
    normal = texts.withColumn("canonical", canonical("definition")["canonical"]).filter("canonical IS NOT NULL").drop("definition")
    rows = events.withColumns({"pick": F.col("offset") % 4, "subject": header("event_type"), "format": F.lit("avro")}).join(normal, "pick")
    return registry.stamp(rows, registered or store(spark, sf))


_STAMPED = _STORE + """, stamped AS (SELECT e.*, s.version, r.pick, 'application/vnd.' || s.subject || '.v' || s.version || '+avro' AS ct
    FROM events e JOIN requests r ON e.event_id = r.arrival JOIN store s USING (subject, v))"""


@query("reg_stamp", f"""WITH {_STAMPED} SELECT event_id AS "offset", ct AS content_type FROM stamped""")
def reg_stamp(spark, sf):
    return _stamped(spark, sf).select("offset", header(CONTENT_TYPE).alias("content_type"))


@query("reg_reference", f"""WITH {_STAMPED} SELECT event_type AS subject, version, count(*) AS rows FROM stamped GROUP BY ALL""")
def reg_reference(spark, sf):
    named = _stamped(spark, sf).select(registry.reference(header(CONTENT_TYPE)).alias("r"))
    return named.groupBy("r.subject", "r.version").agg(F.count(F.lit(1)).alias("rows"))


# The reader counts in long numbers and knows the channel.
READER = json.dumps(_visit({"name": "hits", "type": "long"}, _CHANNEL))


@query("reg_resolve_versions", f"""WITH {_STAMPED} SELECT event_id AS "offset",
  CASE WHEN event_id % 10 <> 9 THEN CAST(event_id AS BIGINT) END AS hits,
  CASE WHEN event_id % 10 <> 9 THEN CASE WHEN pick = 2 THEN 'mail' ELSE 'direct' END END AS channel,
  CASE WHEN event_id % 10 = 9 THEN 'UnknownSchemaVersion' END AS error FROM stamped""")
def reg_resolve_versions(spark, sf):
    registered = store(spark, sf)
    rows = _stamped(spark, sf, registered).select("offset", "value", "headers")
    # Every tenth row names a version that was never registered.
    lost = registry.content_type_of(F.lit("click"), F.lit(1234567890))
    rows = rows.withColumn("headers", F.when(F.col("offset") % 10 == 9, put_headers({CONTENT_TYPE: lost})).otherwise(F.col("headers")))
    read = registry.resolve(rows, registered, READER)
    return read.select("offset", "data.hits", "data.channel", "error")


# A basket as it was first written, as it is written now, and something else under the same subject.
def _record(name, *fields, **more):
    return {"type": "record", "name": name, "namespace": "shop.web", "fields": [{"name": n, "type": t, **(rest[0] if rest else {})} for n, t, *rest in fields], **more}


_ZONE = {"type": "enum", "name": "Zone", "symbols": ["north", "south", "far"]}
_PLACE = _record("Place", ("city", "string"), ("zone", _ZONE))
BASKETS = [json.dumps(d) for d in (
    _record("Basket", ("buyer", "string"), ("count", "int"), ("place", _PLACE),
            ("lines", {"type": "array", "items": _record("Line", ("part", "int"), ("price", "float"))})),
    _record("Basket", ("buyer", "string"), ("items", "int"), ("place", ["null", _PLACE]), ("marks", {"type": "map", "values": "int"}),
            ("lines", {"type": "array", "items": _record("Line", ("part", "long"), ("price", "double"), ("gift", "boolean"))})),
    _record("Parcel", ("buyer", "string")))]

# The reader calls buyers clients, knows two zones and the country of a place, counts in long numbers and allows a note.
BASKET_READER = json.dumps(_record(
    "Basket", ("client", "string", {"aliases": ["buyer"]}), ("items", "long", {"aliases": ["count"]}),
    ("place", ["null", _record("Place", ("city", "string"), ("zone", {**_ZONE, "symbols": ["north", "south"], "default": "north"}),
                               ("country", "string", {"default": "unknown"}))], {"default": None}),
    ("lines", {"type": "array", "items": _record("Line", ("part", "long"), ("price", "double"), ("gift", "boolean", {"default": False}))}),
    ("marks", {"type": "map", "values": "long"}, {"default": {"none": 0}}), ("note", ["null", "string"], {"default": None})))

_UNKNOWN = 1234567890


def _baskets(spark, sf) -> DataFrame:
    """A basket for each event. Its number picks how it was written (case): 0 cut off, 1 a tombstone, 2 a count in
    words, 3 no buyer, 4 an unknown version, 5 a parcel, 6 and 7 the first version, 8 with a zone that the reader
    lacks, 9 the second version without place, 10 with one, 11 with one under the name of its type."""
    n, case = F.col("event_id"), F.col("event_id") % 12
    zone = F.when(case == 8, "far").when(n % 2 == 0, "south").otherwise("north")
    place = F.struct(F.concat(F.lit("city "), (n % 7).cast("string")).alias("city"), zone.alias("zone"))
    buyer = F.concat(F.lit("buyer "), F.col("user_id").cast("string"))

    def lines(*more):
        return F.slice(F.array(*[F.struct((n + k).alias("part"), ((n % 100) * 0.5 + k).alias("price"), *more) for k in (1, 2)]), F.lit(1), (n % 3).cast("int")).alias("lines")

    first = F.struct(F.when(case != 3, buyer).alias("buyer"), F.when(case == 2, "many").alias("count"), F.when(case != 2, n).alias("count_"), place.alias("place"), lines())
    first = F.regexp_replace(F.to_json(first), '"count_"', '"count"')
    second = [buyer.alias("buyer"), n.alias("items"), lines((n % 2 == 0).alias("gift")), F.create_map(F.lit("a"), n % 5).alias("marks")]
    value = (F.when(case == 0, F.substring(first, F.lit(1), F.length(first) - 1)).when(case == 1, None).when(case == 5, F.to_json(F.struct(buyer.alias("buyer"))))
             .when(case == 9, F.to_json(F.struct(*second))).when(case == 10, F.to_json(F.struct(*second, place.alias("place"))))
             .when(case == 11, F.to_json(F.struct(*second, F.struct(place.alias("shop.web.Place")).alias("place")))).otherwise(first))
    version = F.when(case == 4, _UNKNOWN).when(case == 5, 3).when(case >= 9, 2).otherwise(1)
    return table(spark, sf, "events").select(n.alias("offset"), value.alias("value"),
                                             F.create_map(F.lit(CONTENT_TYPE), registry.content_type_of(F.lit("basket"), version)).alias("headers"))


_GOOD = "event_id % 12 >= 6"


@query("reg_resolve", f"""SELECT event_id AS "offset", CASE WHEN {_GOOD} THEN 'buyer ' || user_id END AS client, CASE WHEN {_GOOD} THEN event_id END AS items,
  CASE WHEN {_GOOD} AND event_id % 12 <> 9 THEN 'city ' || event_id % 7 END AS city,
  CASE WHEN {_GOOD} AND event_id % 12 <> 9 THEN CASE WHEN event_id % 12 <> 8 AND event_id % 2 = 0 THEN 'south' ELSE 'north' END END AS zone,
  CASE WHEN {_GOOD} AND event_id % 12 <> 9 THEN 'unknown' END AS country,
  CASE WHEN {_GOOD} THEN CASE WHEN event_id % 12 < 9 THEN 0 ELSE event_id % 5 END END AS mark,
  CASE WHEN {_GOOD} THEN event_id % 3 END AS n_lines,
  CASE WHEN {_GOOD} THEN CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN event_id + 1 ELSE 2 * event_id + 3 END END AS parts,
  CASE WHEN {_GOOD} AND event_id % 3 > 0 THEN (event_id % 100) * 0.5::DOUBLE + 1 END AS price,
  CASE WHEN {_GOOD} AND event_id % 3 > 0 THEN event_id % 12 >= 9 AND event_id % 2 = 0 END AS gift,
  CASE event_id % 12 WHEN 0 THEN 'MalformedPayload' WHEN 2 THEN 'WrongType: count' WHEN 3 THEN 'MissingField: buyer'
    WHEN 4 THEN 'UnknownSchemaVersion' WHEN 5 THEN 'UnresolvableSchema: shop.web.Parcel is no shop.web.Basket' END AS error FROM events""")
def reg_resolve(spark, sf):
    asked = spark.createDataFrame([("basket", "avro", d, n) for n, d in enumerate(BASKETS)], "subject string, format string, definition string, arrival bigint")
    registered = registry.save(registry.register(registry.empty_store(spark), asked), working_path(spark, "schemas"))
    read = registry.resolve(_baskets(spark, sf), registered, BASKET_READER)
    lines = F.col("data.lines")
    return read.select(
        "offset", "data.client", "data.items", "data.place.city", "data.place.zone", "data.place.country",
        F.coalesce("data.marks.a", "data.marks.none").alias("mark"), F.when(lines.isNotNull(), F.size(lines)).cast("bigint").alias("n_lines"),
        F.aggregate(lines, F.lit(0).cast("bigint"), lambda s, x: s + x["part"]).alias("parts"), F.get(lines, F.lit(0))["price"].alias("price"),
        F.get(lines, F.lit(0))["gift"].alias("gift"), "error")


@query("reg_union", """SELECT subject, row_number() OVER (PARTITION BY subject ORDER BY v) AS version, 'v' || v AS definition
  FROM (SELECT DISTINCT event_type AS subject FROM events), (VALUES (1), (2)) AS versions(v)""")
def reg_union(spark, sf):
    asked = requests(spark, sf).withColumn("definition", F.lit(f"[{V1}, {V2}]"))
    members = registry.split_union(asked).withColumn("arrival", F.col("arrival") * 2 + F.col("definition").contains("channel").cast("int"))
    registered = registry.register(registry.empty_store(spark), members)
    return registered.select("subject", "version", _kind().alias("definition"))
