"""Routing by a table of bindings against routing by bindings in the plan; holding rows until they are due; small repairs."""

import datetime
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions import content
from millrace.operators import aggregates, routing
from millrace.ordering import _sliced
from millrace.operators.routing import QueueBinding
from millrace.session import working_path
from millrace.streaming import delays, runner
from tests.compare import spark_rows


def bound(spark, bindings):
    return spark.createDataFrame([(b.queue, b.key, dict(b.arguments), b.match_all) for b in bindings],
                                 "queue string, key string, arguments map<string,string>, match_all boolean")


def messages(spark, keys):
    return spark.createDataFrame([(n, k, {"h": str(n % 3), "g": None if n % 5 else "x"}) for n, k in enumerate(keys)], "n int, k string, headers map<string,string>")


def same(spark, df, exchange, bindings):
    got = routing.route_by_table(df, exchange, bound(spark, bindings), F.col("k")).select("n", "queue")
    expected = routing.route_exchange(df, exchange, bindings, F.col("k")).select("n", "queue")
    assert spark_rows(got) == spark_rows(expected)
    return got.count()


def test_topics_against_patterns(spark):
    rng = random.Random(5)
    words = ["a", "b", "ab", "", "a.b"]
    keys = [".".join(rng.choices(words[:4], k=rng.randrange(0, 6))) for _ in range(150)] + ["", ".", "a", None, "a+b.[x]", "a.a+b"]
    patterns = [".".join(rng.choices([*words, "*", "#", "#"], k=rng.randrange(1, 6))) for _ in range(120)]
    patterns += ["#", "*", "#.#", "*.#.*", "#.a.#", "a.#.#.b", "", "a+b.*", "#.#.a.#.#"]
    bindings = [QueueBinding(f"q{n % 40}", p) for n, p in enumerate(patterns)]
    assert same(spark, messages(spark, keys), "topic", bindings) > 1000


def test_other_exchanges(spark):
    df = messages(spark, ["a", "b", "a", None, "c.d", ""])
    assert same(spark, df, "direct", [QueueBinding("x", "a"), QueueBinding("y", "a"), QueueBinding("x", "a"), QueueBinding("z", "c.d"), QueueBinding("w", "")]) == 6
    assert same(spark, df, "fanout", [QueueBinding("x"), QueueBinding("y", "other"), QueueBinding("x", "b")]) == 12
    headers = [QueueBinding("all", arguments={"h": "1", "g": "x"}), QueueBinding("any", arguments={"h": "2", "g": "x"}, match_all=False),
               QueueBinding("every"), QueueBinding("none", match_all=False), QueueBinding("any", arguments={"h": "0"})]
    assert same(spark, df, "headers", headers) > 6
    with pytest.raises(ValueError, match="cannot bind"):
        routing.route_by_table(df, "other", bound(spark, headers))


def test_the_plan_does_not_grow_with_the_bindings(spark):
    df = messages(spark, ["a.b.c", "k7.x", "k99999.y.z"])
    many = spark.range(100_000).select(F.concat(F.lit("q"), "id").alias("queue"), F.concat(F.lit("k"), F.col("id").cast("string"), F.lit(".#")).alias("key"))
    routed = routing.route_by_table(df, "topic", many, F.col("k"))
    few = routing.route_by_table(df, "topic", many.limit(3), F.col("k"))
    size = lambda x: len(x._jdf.queryExecution().optimizedPlan().toString())
    assert sorted((r["n"], r["queue"]) for r in routed.collect()) == [(1, "q7"), (2, "q99999")]
    assert size(routed) == size(few)


def test_rows_are_held_until_they_are_due(spark):
    """Nothing comes out before its time, and what waits when the query stops comes out of the next one."""
    path, checkpoint, seen = working_path(spark, "delayed"), working_path(spark, "group"), []
    start = time.time() + 15
    at = lambda s: datetime.datetime.fromtimestamp(start + s, datetime.timezone.utc)
    rows = [(n, at(-100) if n % 4 == 0 else at(n % 4 * 3) if n % 4 < 3 else None, {"a": "ü\"" + str(n)}) for n in range(40)] + [(99, at(10_000), {})]
    schema = "n int, due timestamp, headers map<string,string>"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    def run(done):
        held = delays.hold_until(runner.stream_table(spark, path, "*.parquet", spark.read.parquet(path).schema), F.col("due"), slots=4, tick_ms=500)
        write = lambda batch, _: seen.extend((r["n"], r["headers"], time.time()) for r in batch.collect())
        query = held.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime="500 milliseconds").foreachBatch(write).start()
        until = time.time() + 90
        while time.time() < until and query.isActive and not done():
            time.sleep(0.2)
        query.stop()

    spark.conf.set("spark.sql.shuffle.partitions", "2")  # a state store for each makes a batch slow
    at_once = {n for n in range(40) if n % 4 in (0, 3)}
    run(lambda: {n for n, _, _ in seen} >= at_once)
    assert {n for n, _, _ in seen} >= at_once
    run(lambda: len({n for n, _, _ in seen}) >= 40)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    # A batch that was stopped is sent again; on a slow machine the last ones may be due before the first run ends.
    assert sorted(set(n for n, _, _ in seen)) == list(range(40))
    due = {n: d.timestamp() for n, d, _ in rows if d is not None}
    assert all(n not in due or when >= due[n] for n, _, when in seen) and all(h == rows[n][2] for n, h, _ in seen)
    held = runner.read_state(spark, checkpoint, stateVarName="held")
    assert held.count() == 1


def test_held_rows_by_hand():
    """The processor with a state of dictionaries and a clock of its own."""
    import pandas as pd

    class Handle:
        def __init__(self):
            self.timers, self.state = set(), {}

        def getMapState(self, *_):
            return self

        def registerTimer(self, at):
            self.timers.add(at)

        def containsKey(self, key):
            return key in self.state

        def getValue(self, key):
            return self.state[key]

        def updateValue(self, key, value):
            self.state[key] = value

        def removeKey(self, key):
            self.state.pop(key, None)

        now = 0

        def getCurrentProcessingTimeInMs(self):
            return self.now

        def getExpiryTimeInMs(self):
            return self.at

    handle, processor, out, rng = Handle(), delays.HeldRows(100), {}, random.Random(1)
    processor.init(handle)
    dues = {}
    for now in range(0, 5000, 37):
        handle.now = now
        new = {f"{now}-{n}": now + rng.randrange(-200, 900) for n in range(5)}
        dues |= new
        for frame in processor.handleInputRows((1,), iter([pd.DataFrame({"due": list(new.values()), "body": list(new)})]), handle):
            out |= {b: now for b in frame["body"]}
        for handle.at in sorted(t for t in handle.timers if t <= now):
            handle.timers.discard(handle.at)
            for frame in processor.handleExpiredTimer((1,), handle, handle):
                out |= {b: now for b in frame["body"]}
    assert all(when >= dues[b] for b, when in out.items()) and all(b in out for b, d in dues.items() if d < 4700)
    assert sum(len(v[0]) for v in handle.state.values()) + len(out) == len(dues)


def test_priority_queue_of_many_values(spark):
    df = spark.range(100_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 100_000).alias("v"), "id")
    rows = _sliced(df, ["g"], [F.col("v"), F.col("id")], None)
    assert rows.select("g", "_slice", "_part").distinct().count() < 1000
    pages = aggregates.collect(df, ["g"], "v", [F.col("id")], "priority_queue").orderBy("page").collect()
    assert [v for p in pages for v in p["items"]] == list(range(100_000)) and len(pages) == 10


def test_fold_refuses_pages_of_one(spark):
    with pytest.raises(ValueError, match="two values or more"):
        aggregates.fold(spark.range(3).withColumn("g", F.lit(1)), ["g"], "id", [F.col("id")], lambda a, b: a + b, page_size=1)


def test_an_empty_json_text_is_an_error(spark):
    rows = spark.createDataFrame([(v, {"contentType": c}) for v, c in itertools.product(["", "  ", None, '{"x":1}', "{"], ["application/json", "text/plain"])],
                                 "value string, headers map<string,string>")
    from pyspark.sql import types as T

    got = {(r["value"], r["headers"]["contentType"]): r["error"] for r in content.decode(rows, T.StructType.fromDDL("x int")).collect()}
    bad = {k for k, e in got.items() if e == content.MALFORMED}
    assert bad == {("", "application/json"), ("  ", "application/json"), ("{", "application/json")}


def test_converters_of_the_caller_come_first(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("x int, y string")
    converters = [(lambda ct: ct == "text/csv", lambda v: F.when(F.size(F.split(v, ";")) == 2, F.struct(F.get(F.split(v, ";"), F.lit(0)).try_cast("int").alias("x"), F.get(F.split(v, ";"), F.lit(1)).alias("y")))),
                  (lambda ct: ct.startswith("text/"), lambda v: F.struct(F.length(v).alias("x"), v.alias("y"))),
                  (lambda ct: ct == "application/vnd.own", lambda v: F.struct(F.lit(7).alias("x"), F.lit(None).cast("string").alias("y")))]
    rows = spark.createDataFrame([("1;a", "text/csv"), ("broken", "text/csv"), ("abc", "text/plain"), ("z", "application/vnd.own"), ('{"x":5,"y":"b"}', "application/json"),
                                  (None, "text/csv"), ("q", "image/png"), ("{", "application/json"), ("b", "application/octet-stream")], "value string, ct string")
    rows = rows.withColumn("headers", F.create_map(F.lit("contentType"), "ct"))
    got = {(r["value"], r["ct"]): (tuple(r["data"]) if r["data"] else None, r["error"]) for r in content.decode(rows, schema, converters=converters).collect()}
    assert got == {("1;a", "text/csv"): ((1, "a"), None), ("broken", "text/csv"): (None, content.MALFORMED), ("abc", "text/plain"): ((3, "abc"), None),
                   ("z", "application/vnd.own"): ((7, None), None), ('{"x":5,"y":"b"}', "application/json"): ((5, "b"), None), (None, "text/csv"): (None, None),
                   ("q", "image/png"): (None, content.UNSUPPORTED), ("{", "application/json"): (None, content.MALFORMED), ("b", "application/octet-stream"): (None, None)}
    out = content.decode(rows, schema, converters=converters)
    assert {r["text"] for r in out.collect()} == {None} and out.columns == content.decode(rows, schema).columns
