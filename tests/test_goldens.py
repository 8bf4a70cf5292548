"""Small inputs with known results."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import CONTENT_TYPE, ENVELOPE, PARTITION, PARTITION_OVERRIDE, put_headers_if_absent
from millrace.functions import avro, content, embedded
from millrace.functions.hashing import default_selector, int_hash, long_hash, string_hash
from millrace.functions.headers import passes
from millrace.functions.text import words
from millrace.operators import batches, errors, joins, partitioning, queues, registry, retry, routing, rows
from millrace.operators.tables import changelog, compact, latest, locate, range_scan
from millrace.plans import compose
from millrace.sinks import outputs
from millrace.sources import log as src


def log(spark, records, destination="in"):
    """(key, value[, headers]) records in order."""
    full = [(destination, 0, i, None, r[0], r[1], r[2] if len(r) > 2 else {}) for i, r in enumerate(records)]
    return spark.createDataFrame(full, ENVELOPE).withColumn("timestamp", F.timestamp_seconds("offset"))


def column(df, name):
    return [r[name] for r in df.collect()]


CLICKS = [("ines", "7"), ("omar", "11"), ("lea", "30"), ("omar", "2"), ("kofi", "8"), ("ines", "5"), ("yuki", "64"), ("noor", "3")]
REGIONS = [("ines", "north"), ("omar", "south"), ("lea", "north"), ("kofi", "west"), ("ines", "west"), ("yuki", "south"), ("noor", "north")]


def per_region(spark, regions, salt=1):
    table = latest(log(spark, regions)).withColumnRenamed("value", "region")
    joined = joins.join_table(log(spark, CLICKS), table, "left", {"region": "UNKNOWN"}, salt)
    return {r["region"]: r["n"] for r in joined.groupBy("region").agg(F.sum(F.col("value").cast("long")).alias("n")).collect()}


@pytest.mark.parametrize("salt", [1, 4])
def test_clicks_per_region(spark, salt):
    assert per_region(spark, REGIONS, salt) == {"north": 33, "south": 77, "west": 20}


def test_clicks_of_unknown_region(spark):
    left = [*REGIONS, ("noor", None)]
    assert per_region(spark, left) == {"north": 30, "south": 77, "west": 20, "UNKNOWN": 3}


def test_words_are_branched(spark):
    df = log(spark, [("k", w) for w in ["english", "french", "french", "spanish", "spanish", "spanish", "dutch"]])
    parts = routing.branches(df, [F.col("value") == w for w in ("english", "french", "spanish")])
    assert [p.count() for p in parts] == [1, 2, 3]
    assert routing.branches(df, [F.col("value") == "english"], default_branch=True)[1].count() == 6


@pytest.mark.parametrize("text, expected", [
    ("", [""]), ("!!!", []), (" a b", ["", "a", "b"]), ("a b.", ["a", "b"]), ("One_Two", ["one_two"]), ("é", []), ("aéb", ["a", "b"])])
def test_words(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(words(F.col("t")).alias("w")).first()["w"] == expected


@pytest.mark.parametrize("text, h", [("hello", 99162322), ("english", -1603757456), ("a😀b", 57849694), ("", 0), ("polygenelubricants", -(1 << 31))])
def test_string_hash(spark, text, h):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(string_hash(F.col("t")).alias("h"), default_selector(F.col("t")).alias("p")).first()
    assert got["h"] == h and got["p"] == (0 if h == -(1 << 31) else abs(h))


@pytest.mark.parametrize("n, h", [(5, 5), (-1, 0), (1 << 32, 1), ((1 << 31), -(1 << 31)), (-5, 4)])
def test_long_hash(spark, n, h):
    assert spark.range(1).select(long_hash(F.lit(n)).alias("h")).first()["h"] == h


def test_int_hash(spark):
    assert spark.range(1).select(int_hash(F.lit(-7)).alias("h")).first()["h"] == -7


def test_partition_members(spark):
    df = log(spark, [(v, v) for v in ("2", "1", "0")])
    df = partitioning.assign_partition(df, partitioning.Partitioning(F.col("value"), 3))
    assert column(df, "partition") == [2, 1, 0]


def test_partition_headers(spark):
    df = log(spark, [("a", "x", {PARTITION_OVERRIDE: "4", PARTITION: "2"}), ("a", "x", {PARTITION: "2"}), ("a", "x")])
    out = partitioning.assign_partition(df, partitioning.Partitioning(F.col("key"), 5)).collect()
    assert [r["partition"] for r in out] == [4, 2, 97 % 5]
    assert [r["headers"] for r in out] == [{PARTITION: "4"}, {PARTITION: "2"}, {PARTITION: "2"}]


def test_null_partition_key_is_an_error(spark):
    df = log(spark, [(None, "x")])
    with pytest.raises(Exception, match="Partition key cannot be null"):
        partitioning.assign_partition(df, partitioning.Partitioning(F.col("key"), 5)).collect()


def test_event_types(spark):
    df = log(spark, [("56", "a", {"event_type": "foo"}), ("57", "b"), ("58", "c", {"event_type": "foo"}), ("59", "d", {"event_type": "bar"}), ("60", "e", {"event_type": "baz"})])
    assert column(routing.by_event_type(df, "foo,bar"), "key") == ["56", "58", "59"]


def test_tombstones(spark):
    df = log(spark, [("a", None), ("b", "x")])
    assert column(rows.drop_tombstones(df), "key") == ["b"]
    assert column(rows.pass_tombstones(df, F.upper), "value") == [None, "X"]


def test_latest_compact_and_changelog(spark):
    df = log(spark, [("a", "1"), ("b", "1"), ("a", "1"), ("a", "2"), (None, "9"), ("b", None), ("c", None)])
    assert {(r["key"], r["value"]) for r in latest(df).collect()} == {("a", "2")}
    assert {(r["key"], r["value"]) for r in compact(df).collect()} == {("a", "2"), (None, "9"), ("b", None), ("c", None)}
    changes = changelog(df, F.col("offset")).select("key", "old", "value").collect()
    assert sorted(map(tuple, changes), key=str) == sorted([("a", None, "1"), ("b", None, "1"), ("a", "1", "2"), ("b", "1", None)], key=str)


def test_store_queries(spark):
    store = latest(log(spark, [("a", "1"), ("b", "2"), ("c", "3")]))
    assert sorted(column(range_scan(store, "a", "b"), "key")) == ["a", "b"]
    assert column(locate(store.filter("key = 'a'"), default_selector(F.col("key")) % 5), "partition") == [97 % 5]


def test_global_join(spark):
    orders = spark.createDataFrame([(1, 10, 100), (2, 11, 101), (3, 99, 100)], "id long, customer long, product long")
    people = spark.createDataFrame([(10, "c10"), (11, "c11")], "key long, name string")
    things = spark.createDataFrame([(100, "p100"), (101, "p101")], "key long, thing string")
    out = joins.join_global(joins.join_global(orders, people, F.col("customer")), things, F.col("product"))
    assert sorted((r["id"], r["name"], r["thing"]) for r in out.collect()) == [(1, "c10", "p100"), (2, "c11", "p101")]


@pytest.mark.parametrize("within", [1, 5, 7])
def test_interval_join(spark, within):
    left = [("k", t) for t in range(-20, 60, 3)] + [("other", 0)]
    right = [("k", t) for t in range(-25, 60, 4)]
    a = spark.createDataFrame(left, "key string, l long").withColumn("lt", F.timestamp_millis("l"))
    b = spark.createDataFrame(right, "key string, r long").withColumn("rt", F.timestamp_millis("r"))
    got = joins.join_interval(a, b, within, ("lt", "rt"))
    expected = sorted((x, y) for k, x in left for k2, y in right if k == k2 and abs(x - y) <= within)
    assert sorted((r["l"], r["r"]) for r in got.collect()) == expected


def test_asof_join(spark):
    table = spark.createDataFrame([("a", 10, 1, "x"), ("a", 20, 2, "y"), ("a", 20, 3, "z"), ("b", 5, 4, None)], "key string, t long, id long, v string")
    stream = spark.createDataFrame([("a", 9, 1), ("a", 10, 2), ("a", 25, 3), ("b", 6, 4), ("c", 1, 5), (None, 30, 6)], "key string, t long, id long")
    for slices in (F.col("t"), None):
        got = joins.join_asof(stream, table, ["v"], "id", ts="t", slice_by=slices)
        assert {r["id"]: r["v"] for r in got.collect()} == {1: None, 2: "x", 3: "z", 4: None, 5: None, 6: None}


@pytest.mark.parametrize("pattern, key, matches", [
    ("#", "", True), ("#", "a.b", True), ("*", "a", True), ("*", "a.b", False), ("a.#", "a", True), ("a.#", "a.b.c", True),
    ("#.c", "a.b.c", True), ("a.*.c", "a.b.c", True), ("a.*.c", "a.c", False), ("a.#.c", "a.c", True), ("a.b", "a.b", True), ("a.b", "axb", False)])
def test_topic_patterns(spark, pattern, key, matches):
    df = spark.createDataFrame([(key,)], "k string")
    got = df.select(routing.queues("topic", [routing.QueueBinding("q", pattern)], F.col("k")).alias("q")).first()["q"]
    assert got == (["q"] if matches else [])


def test_exchange_gives_a_queue_one_copy(spark):
    df = log(spark, [("a.b", "x"), ("z", "y")])
    bound = [routing.QueueBinding("q", "a.*"), routing.QueueBinding("q", "a.#"), routing.QueueBinding("r", "*.b")]
    assert sorted(column(routing.route_exchange(df, "topic", bound, F.col("key")), "queue")) == ["q", "r"]
    with pytest.raises(ValueError):
        routing.queues("unknown", bound, F.col("key"))


def test_route_precedence(spark):
    df = log(spark, [("1", "Ab", {routing.DEFINITION: "up", routing.EXPRESSION: "e"}), ("2", "Ab", {routing.EXPRESSION: "e"}), ("3", "Ab"), ("4", "Ab")])
    name = routing.handler_name(F.when(F.col("key") == "4", "eat"), {"e": F.lit("down")}, "same")
    handlers = {"up": F.upper, "down": F.lower, "same": lambda v: v, "eat": None}
    got = {r["key"]: (r["value"], r["destination"]) for r in routing.route(df, handlers, name).collect()}
    assert got == {k: (v, "functionRouter-out-0") for k, v in {"1": "AB", "2": "ab", "3": "Ab"}.items()}
    with pytest.raises(Exception, match="no handler named"):
        routing.route(df, {"up": F.upper}, name).collect()


@pytest.mark.parametrize("patterns, expected", [
    (["*"], ["a", "x-b"]), (["x-*"], ["x-b"]), (["!x-*", "*"], ["a"]), (["*", "!x-*"], ["a", "x-b"]), (["a"], ["a"]), ([], [])])
def test_header_patterns(spark, patterns, expected):
    df = spark.createDataFrame([(n,) for n in ("id", "timestamp", "deliveryAttempt", "scst_nativeHeadersPresent", "a", "x-b")], "n string")
    assert column(df.filter(passes(F.col("n"), patterns)), "n") == expected


def test_content_types(spark):
    schema = T.StructType([T.StructField("name", T.StringType())])
    records = [("1", '{"name":"bob"}'), ("2", '{"name":'), ("3", None), ("4", "plain", {CONTENT_TYPE: '"text/plain"'}),
               ("5", "raw", {CONTENT_TYPE: "application/octet-stream"}), ("6", "?", {CONTENT_TYPE: "image/png"}),
               ("7", '{"name":"jill"}', {CONTENT_TYPE: "application/vnd.x+json;v=1"})]
    got = {r["key"]: r for r in content.decode(log(spark, records), schema).collect()}
    assert {k: r["error"] for k, r in got.items() if r["error"]} == {"2": content.MALFORMED, "6": content.UNSUPPORTED}
    assert got["1"]["data"]["name"] == "bob" and got["7"]["data"]["name"] == "jill"
    assert got["2"]["data"] is None and got["3"]["data"] is None and got["4"]["text"] == "plain" and bytes(got["5"]["bytes"]) == b"raw"


def test_station_round_trip(spark):
    value = '{"readings":[{"stationid":"fgh","customerid":"12345","timestamp":"t1"},{"stationid":"hjk","customerid":"222","timestamp":"t2"}]}'
    schema = T.StructType.fromDDL("readings array<struct<stationid:string,customerid:string,timestamp:string>>")
    decoded = content.decode(log(spark, [("k", value)]), schema)
    assert content.encode(decoded, F.col("data")).first()["value"] == value


def test_embedded_headers(spark):
    headers = {"correlationId": 'say "foo" é', "sequenceNumber": "42", CONTENT_TYPE: "text/plain", "mine": "m", "other": "o"}
    df = log(spark, [("k", "body", headers)])
    packed = df.withColumn("packed", embedded.embed_headers(F.encode("value", "UTF-8"), F.col("headers"), ["mine"]))
    out = packed.select(embedded.extract_headers(F.col("packed")).alias("x")).first()["x"]
    assert out["headers"] == {k: v for k, v in headers.items() if k != "other"} and bytes(out["body"]) == b"body"
    # Written elsewhere: a number as its value.
    foreign = bytes([255, 1, 1]) + b"n" + (2).to_bytes(4, "big") + b"42" + b"rest"
    for payload, expected in [(foreign, ({"n": "42"}, b"rest")), (b"\xff\x01short", ({}, b"\xff\x01short")), (b"plain text", ({}, b"plain text"))]:
        got = spark.createDataFrame([(payload,)], "p binary").select(embedded.extract_headers(F.col("p")).alias("x")).first()["x"]
        assert (got["headers"], bytes(got["body"])) == expected


def test_headers_are_inherited_if_absent(spark):
    df = spark.createDataFrame([({"a": "own"}, {"a": "request", "b": "request"})], "headers map<string,string>, request map<string,string>")
    assert df.select(put_headers_if_absent(F.col("request")).alias("h")).first()["h"] == {"a": "own", "b": "request"}


def test_start_positions(spark):
    df = log(spark, [("a", str(i)) for i in range(5)])
    commits = src.committed_before(df, "g", F.col("offset") < 2)
    offsets = lambda frame: sorted(column(frame, "offset"))
    assert offsets(src.start_from(df, commits, "g")) == [2, 3, 4]
    assert offsets(src.start_from(df, commits, "g", start_offset=src.LATEST)) == [2, 3, 4]
    assert offsets(src.start_from(df, commits, "other")) == [0, 1, 2, 3, 4]
    assert offsets(src.start_from(df, commits)) == []
    assert offsets(src.start_from(df, commits, start_offset=src.EARLIEST)) == [0, 1, 2, 3, 4]
    assert offsets(src.start_from(df, commits, "g", reset=True)) == [0, 1, 2, 3, 4]
    assert offsets(src.start_from(df, commits, "g", src.LATEST, reset=True)) == []
    polled = src.poll(df, commits, "g", 2)
    assert offsets(polled) == [2, 3]
    assert offsets(src.poll(df, commits, "g", 2000)) == [2, 3, 4]
    settled = lambda outcome: src.settle(polled, outcome, "g").first()["committed"]
    assert settled(F.lit("accept")) == 4 and settled(F.lit("reject")) == 4
    assert settled(F.when(F.col("offset") == 3, "requeue").otherwise("accept")) == 3


def test_choice_of_destinations(spark):
    df = log(spark, [("a", "1")], "foo").unionByName(log(spark, [("b", "1")], "bar")).unionByName(log(spark, [("c", "1")], "foobar"))
    assert sorted(column(src.from_destinations(df, "foo, bar"), "key")) == ["a", "b"]
    assert sorted(column(src.from_pattern(df, "foo.*"), "key")) == ["a", "c"]
    assert [f.count() for f in src.from_bindings(df, "foo,bar")] == [1, 1]
    assert [f.count() for f in src.from_bindings(df, "foo,bar", multiplex=True)] == [2]
    with pytest.raises(ValueError):
        src.from_pattern(df, "foo.*", multiplex=True)
    with pytest.raises(ValueError):
        src.for_instance(df, 2, 2)


def test_policies(spark):
    df = log(spark, [("a", "ok"), ("b", "bad")]).withColumn("error", F.when(F.col("value") == "bad", "Broken"))
    for policy in (errors.LOG, errors.SKIP):
        split = errors.apply_policy(df, policy)
        assert column(split.good, "key") == ["a"] and split.bad is None
    split = errors.apply_policy(df, None, errors.DLQ)
    assert column(split.good, "key") == ["a"] and column(split.bad, "key") == ["b"]
    with pytest.raises(Exception, match="Broken: bad"):
        errors.apply_policy(df).good.collect()
    with pytest.raises(ValueError):
        errors.dlq_name(None)


def test_function_that_always_fails_goes_to_the_dead_letters(spark):
    def fail(value):
        raise RuntimeError("no")

    failed = retry.recover(log(spark, [("my-key", "foobar")]), fail)
    bad = errors.apply_policy(failed, errors.DLQ).bad
    sent = errors.dead_letter(bad, F.lit("hello-dlt-1"), message=F.col("message")).first()
    assert (sent["destination"], sent["key"], sent["value"]) == ("hello-dlt-1", "my-key", "foobar")
    assert sent["headers"]["x-exception-fqcn"] == "RuntimeError" and sent["headers"]["x-exception-message"] == "no"


def test_retry_rules():
    errors = (IndexError(), LookupError(), KeyError(), ValueError())
    both = retry.Retry(rules={LookupError: True, KeyError: False})
    assert [both.retryable(e) for e in errors] == [True, True, False, False]
    excluded = retry.Retry(rules={LookupError: False, KeyError: True})
    assert [excluded.retryable(e) for e in errors] == [False, False, False, False]
    only_excluded = retry.Retry(rules={KeyError: False})
    assert [only_excluded.retryable(e) for e in errors] == [True, True, False, True]
    only_included = retry.Retry(rules={LookupError: True})
    assert [only_included.retryable(e) for e in errors] == [True, True, True, False]
    assert not retry.Retry(unlisted=False).retryable(ValueError())
    assert [retry.Retry().delay_ms(n) for n in range(1, 7)] == [1000, 2000, 4000, 8000, 10000, 10000]


def test_queue_policies(spark):
    df = spark.createDataFrame([("q", i, "x" * n) for i, n in enumerate([5, 1, 4, 2, 3])], "queue string, offset long, value string")
    def kept(**o):
        out = queues.limit_length(df, "queue", [F.col("offset")], slice_by=F.col("offset"), **o)
        assert sorted(column(out.kept, "offset") + column(out.left, "offset")) == [0, 1, 2, 3, 4]
        return sorted(column(out.kept, "offset"))

    assert kept(max_messages=2) == [3, 4]
    assert kept(max_messages=2, overflow=queues.REJECT_PUBLISH) == [0, 1]
    assert kept(max_bytes=9) == [2, 3, 4]
    assert kept(max_bytes=9, max_messages=1) == [4]


def test_batches(spark):
    bare = spark.createDataFrame([(1, ["a", None, "c"])], "b long, payloads array<string>")
    assert [(r["index"], r["value"]) for r in batches.explode_bare(bare, "payloads").collect()] == [(0, "a"), (1, None), (2, "c")]
    df = spark.createDataFrame([(1, 0, "foo", {"fooKey": "1"}), (1, 1, None, {}), (1, 2, "baz", {"bazKey": "3"})], "b long, at long, value string, headers map<string,string>")
    built = batches.build(df, ["b"], "at", {"a": "a"})
    assert built.first()["headers"] == {"a": "a"}
    items = batches.explode(built).orderBy("index").collect()
    assert [(r["value"], r["headers"]) for r in items] == [("foo", {"fooKey": "1"}), (None, {}), ("baz", {"bazKey": "3"})]
    failed = df.withColumn("error", F.when(F.col("at") == 1, "Broken"))
    assert errors.dead_letter_batches(failed, "b").count() == 3


V1 = {"type": "record", "name": "User", "namespace": "n", "fields": [{"name": "a", "type": "string"}]}
V2 = {**V1, "fields": [*V1["fields"], {"name": "b", "type": ["null", "string"], "default": None}]}


def ask(spark, *definitions, subject="user", start=1):
    rows = [(subject, "avro", d if isinstance(d, str) else json.dumps(d), start + i) for i, d in enumerate(definitions)]
    return spark.createDataFrame(rows, "subject string, format string, definition string, arrival long")


def test_registry(spark, tmp_path):
    store = registry.save(registry.register(registry.empty_store(spark), ask(spark, V1, json.dumps(V1, indent=1), {**V1, "doc": "d"})), str(tmp_path / "one"))
    assert [(r["id"], r["version"]) for r in store.collect()] == [(1, 1)]
    again = registry.save(registry.register(store, ask(spark, V1, V2).unionByName(ask(spark, V2, subject="other", start=9))), str(tmp_path / "two"))
    assert sorted((r["id"], r["subject"], r["version"]) for r in again.collect()) == [(1, "user", 1), (2, "user", 2), (3, "other", 1)]
    found, missing = registry.find(again, spark.createDataFrame([("user", "avro", 2), ("user", "avro", 7)], "subject string, format string, version long"), "subject", "format", "version")
    assert column(found, "id") == [2] and column(missing, "version") == [7]
    wanted = spark.createDataFrame([("user",)], "subject string")
    assert column(registry.delete(again, wanted, "subject", allowed=True), "subject") == ["other"]
    with pytest.raises(PermissionError):
        registry.delete(again, wanted, "subject")


@pytest.mark.parametrize("definition, problem", [
    ({**V1, "fields": [{"name": "f", "type": "SomeType"}]}, "Undefined name: n.SomeType"), ("nope", ""), ({"type": "record", "name": "X"}, "no fields"),
    ({**V1, "name": "1x"}, "Illegal name"), ({"type": "array"}, "No items")])
def test_invalid_schemas(spark, definition, problem):
    checked = registry.validate(ask(spark, definition)).first()
    assert checked["problem"] is not None and problem in checked["problem"]
    assert registry.register(registry.empty_store(spark), ask(spark, definition)).count() == 0


def test_unknown_format(spark):
    asked = ask(spark, V1).withColumn("format", F.lit("proto"))
    assert "Invalid format" in registry.validate(asked).first()["problem"]


def test_named_types_resolve():
    sms = {"type": "record", "name": "Sms", "namespace": "n", "fields": [{"name": "phone", "type": "string"}]}
    command = {"type": "record", "name": "Command", "namespace": "n", "fields": [
        {"name": "payload", "type": [sms, "null"]}, {"name": "again", "type": "Sms"}, {"name": "kinds", "type": {"type": "enum", "name": "Kind", "symbols": ["A"]}},
        {"name": "many", "type": {"type": "map", "values": "n.Kind"}}]}
    form = avro.normal_form(command)
    assert form["name"] == "n.Command" and form["fields"][1]["type"] == "n.Sms"
    with pytest.raises(ValueError, match="redefine"):
        avro.normal_form([sms, sms])


def test_subjects_and_references(spark):
    df = spark.createDataFrame([(json.dumps({**V1, "name": "User"}),)], "d string")
    d = F.col("d")
    got = df.select(registry.subject_name(d), registry.subject_name(d, prefix="p"), registry.subject_name(d, "full"), registry.subject_name(d, "prefix", "p")).first()
    assert list(got) == ["user", "p-user", "n.user", "p"]
    refs = spark.createDataFrame([("application/vnd.user.v12+avro",), ("application/json",), ("application/vnd.p-user.v1+avro",)], "ct string")
    assert [tuple(r["r"]) if r["r"] else None for r in refs.select(registry.reference(F.col("ct")).alias("r")).collect()] == [("user", 12), None, None]


def test_functions(spark):
    df = log(spark, [("a", "x")])
    up, consume = (lambda d: rows.map_values(d, F.upper)), (lambda d: None)
    found = compose.from_definition("up|down;up", {"up": up, "down": lambda d: rows.map_values(d, F.lower)})
    assert set(found) == {"upDown", "up"} and column(found["upDown"](df), "value") == ["x"]
    assert compose.compose(up, consume)(df) is None
    with pytest.raises(TypeError):
        compose.compose(consume, up)(df)
    with pytest.raises(LookupError):
        compose.from_definition("nope", {})
    with pytest.raises(TypeError):
        compose.apply_tuple(lambda t: t, [df, df])
    with pytest.raises(TypeError):
        compose.apply_tuple(lambda t: [1], (df,))
    assert compose.binding_names("f", 2, 1) == (["f-in-0", "f-in-1"], ["f-out-0"])


def test_log_on_disk(spark, tmp_path):
    path = str(tmp_path / "log")
    outputs.send(log(spark, [("a", "1")]), path, "first", F.struct("key"), partitioning=partitioning.Partitioning(F.col("key"), 3))
    outputs.send(log(spark, [("b", "1")]), path, "second", F.struct("key"))
    stored = src.read_log(spark, path)
    assert {(r["destination"], r["key"], r["value"]) for r in stored.collect()} == {("first", "a", '{"key":"a"}'), ("second", "b", '{"key":"b"}')}
    plan = src.from_destinations(stored, "first")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(destination" in plan or "destination#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_broker_rows(spark):
    schema = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int, "
              "headers array<struct<key:string,value:binary>>")
    at = datetime.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(b"k", b"v", "t", 1, 5, at, 0, [("a", b"1"), ("b", b"2"), ("a", b"3")]), (None, None, "t", 0, 6, at, 0, None)], schema)
    rows_ = src.from_broker_rows(raw).orderBy("offset").collect()
    assert [(r["destination"], r["partition"], r["offset"], r["key"], r["value"], r["headers"]) for r in rows_] == [
        ("t", 1, 5, "k", "v", {"a": "3", "b": "2"}), ("t", 0, 6, None, None, {})]
    back = src.to_broker_rows(src.from_broker_rows(raw)).orderBy("partition").collect()
    assert bytes(back[1]["key"]) == b"k" and {h["key"]: bytes(h["value"]) for h in back[1]["headers"]} == {"a": b"3", "b": b"2"}
    assert back[0]["value"] is None and back[0]["headers"] == []


def test_split_keeps_bytes_whole(spark):
    df = spark.createDataFrame([(b"ab",)], "results binary")
    assert bytes(outputs.split(df).first()["value"]) == b"ab"
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, results array<string>")
    assert column(outputs.split(df), "value") == ["a", "b"]
