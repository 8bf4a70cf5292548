"""No row is lost: null conditions, logs that are read back, stores saved in place, hot keys."""

import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import ordering
from millrace.envelope import ENVELOPE
from millrace.functions import avro, content, embedded
from millrace.operators import aggregates, errors, joins, queues, registry, tables, windows
from millrace.operators.lag import lag
from millrace.session import working_path
from millrace.sinks import outputs
from millrace.sources import log as src


def envelopes(spark, rows):
    """rows: (destination, partition, offset, seconds, key, value)."""
    df = spark.createDataFrame(rows, "destination string, partition int, offset bigint, s bigint, key string, value string")
    return df.select("destination", "partition", "offset", F.timestamp_seconds("s").alias("timestamp"), "key", "value",
                     F.create_map().cast("map<string,string>").alias("headers"))


@pytest.fixture(scope="module")
def log(spark):
    return envelopes(spark, [("q", 0, 0, None, "a", None), ("q", 0, 1, 5, "a", "éé"), ("q", 0, 2, 6, "b", "x" * 10), ("q", 0, 3, 1, "b", "late")])


def whole(outcome, df):
    offsets = lambda d: [r["offset"] for r in d.collect()]
    assert sorted(offsets(outcome.kept) + offsets(outcome.left)) == sorted(offsets(df))
    return offsets(outcome.kept)


def test_queue_policies_keep_every_row(log):
    at = F.timestamp_seconds(F.lit(100))
    assert sorted(whole(queues.expire(log, 94_500, at), log)) == [0, 2]
    counts = F.when(F.col("offset") > 1, F.col("offset"))
    assert sorted(whole(queues.limit_deliveries(log, counts, 2), log)) == [0, 1, 2]
    # From the newest: 4 bytes, 10 bytes, then 4 bytes of two letters, then nothing.
    assert sorted(whole(queues.limit_length(log, "destination", [F.col("offset")], max_bytes=17, slice_by=F.col("offset")), log)) == [2, 3]
    assert sorted(whole(queues.limit_length(log, "destination", [F.col("offset")], max_bytes=18, slice_by=F.col("offset")), log)) == [0, 1, 2, 3]


def test_late_rows_and_confirmations_keep_rows_with_nulls(log):
    kept = windows.drop_late(log, [F.col("offset")], slice_by=F.col("offset"))
    assert sorted(r["offset"] for r in kept.collect()) == [0, 1, 2]
    bound = F.when(F.col("offset") == 1, F.array(F.lit("queue"))).when(F.col("offset") == 2, F.array().cast("array<string>"))
    taken, returned = outputs.confirmations(log, bound)
    assert taken.count() == 1 and returned.count() == 3


def test_republish_without_a_word_on_acknowledgement(log):
    ack = F.when(F.col("offset") == 1, True).when(F.col("offset") == 2, False)
    sent = errors.republish(log, "DLX", F.col("key"), ack, F.lit("m"), F.lit("t"), F.lit("e"), F.lit("k"))
    assert sorted(r["offset"] for r in sent.collect()) == [0, 2, 3]


def test_what_cannot_be_encoded_is_an_error(spark):
    df = spark.createDataFrame([(i, {"contentType": t} if t else {}) for i, t in enumerate(
        ["application/octet-stream", "application/x-foo", "text/plain", None])], "n int, headers map<string,string>")
    got = content.encode(df, F.when(F.col("n") >= 0, F.struct("n")).alias("d")).orderBy("n").collect()
    assert [r["error"] for r in got] == [content.UNSUPPORTED, content.UNSUPPORTED, None, None]
    nothing = content.encode(df, F.when(F.col("n") < 0, F.struct("n"))).collect()
    assert all(r["error"] is None and r["value"] is None for r in nothing)
    raw = content.encode(df, F.struct("n"), raw=F.lit("bytes")).collect()
    assert all(r["error"] is None and r["value"] == "bytes" for r in raw)


def test_native_decoding_of_structures_and_one_parse(spark, log):
    schema = T.StructType([T.StructField("a", T.LongType())])
    texts = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,)], "value string").withColumn("headers", F.create_map().cast("map<string,string>"))
    got = content.decode(texts, schema, native=True).collect()
    assert [r["data"] and r["data"]["a"] for r in got] == [1, None, None] and [r["error"] for r in got] == [None, content.MALFORMED, None]
    bad = errors.apply_policy(content.decode(texts, schema), errors.DLQ).bad.select("value", "error", "data")
    assert bad.count() == 1
    assert bad._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_dropped_rows_are_counted(log):
    bad = log.withColumn("error", F.when(F.col("offset") == 2, "E"))
    for policy in (errors.LOG, errors.SKIP):
        seen = Observation(policy)
        assert errors.apply_policy(bad, policy, dropped=seen).good.count() == 3
        assert seen.get["dropped"] == 1 and (policy == errors.SKIP or seen.get["errors"] == ["E"])


def test_observed_errors_are_bounded(spark):
    rows = spark.range(1000).withColumn("value", F.lit("v"))
    for first, errs in ((100, ["row 0100", "row 0999"]), (999, ["row 0999"]), (1000, [])):
        seen = Observation()
        bad = rows.withColumn("error", F.when(F.col("id") >= first, F.format_string("row %04d", "id")))
        assert errors.apply_policy(bad, errors.LOG, dropped=seen).good.count() == first
        assert seen.get == {"dropped": 1000 - first, "errors": errs}


def test_embedded_headers_that_do_not_fit():
    with pytest.raises(ValueError, match="255"):
        embedded.embed_headers(F.lit(b""), F.col("headers"), ["n" * 300])
    with pytest.raises(ValueError, match="255"):
        embedded.embed_headers(F.lit(b""), F.col("headers"), [f"n{i}" for i in range(300)])


def test_a_log_is_read_back_by_position(spark):
    path, rng = working_path(spark, "log"), random.Random(1)
    rows = [(d, rng.randrange(3), None, t, "k", f"{d}-{t}") for t in range(60) for d in ("x", "y")]
    outputs.append(envelopes(spark, rows[:50]), path, F.col("value"))
    outputs.append(envelopes(spark, rows[50:]), path)
    got = [tuple(r) for r in src.read_log(spark, path).select("destination", "partition", "offset", "timestamp", "value").collect()]
    assert len(got) == len(rows)
    for place in {r[:2] for r in got}:
        own = sorted(r[2:] for r in got if r[:2] == place)
        assert [r[0] for r in own] == list(range(len(own)))
        assert [r[1] for r in own] == sorted(r[1] for r in own)
    stored = src.read_log(spark, path)
    commits_path = working_path(spark, "commits")
    assert src.read_commits(spark, commits_path).isEmpty()
    commits = src.store_commits(src.committed_before(stored, "g", F.col("offset") < 5), commits_path)
    rest = src.start_from(stored, commits, "g")
    assert sorted({r["offset"] for r in rest.collect()}) == list(range(5, max(r[2] for r in got) + 1))
    assert sum(r["lag"] for r in lag(stored, commits, ["g"]).collect()) == rest.count()
    # Resetting is one more commit.
    again = src.store_commits(commits.withColumn("committed", F.lit(0)), commits_path)
    assert src.start_from(stored, again, "g").count() == len(rows)


def test_sends_go_on_where_the_log_ends(spark):
    path = working_path(spark, "log")
    rows = spark.range(5).withColumn("headers", F.create_map().cast("map<string,string>"))
    for _ in range(2):
        outputs.send(rows, path, "shop", F.struct("id"), F.col("id"))
    got = src.read_log(spark, path)
    assert sorted(r["offset"] for r in got.collect()) == list(range(10))
    assert [tuple(r) for r in src.positions(got).select("begin", "end").collect()] == [(0, 10)]
    assert set(got.columns) == set(ENVELOPE.names)


def ask(spark, *definitions):
    rows = [("s", "avro", json.dumps(d), i) for i, d in enumerate(definitions)]
    return spark.createDataFrame(rows, "subject string, format string, definition string, arrival bigint")


def test_a_store_is_saved_in_place(spark, tmp_path):
    path = str(tmp_path / "schemas")
    assert registry.load(spark, path).isEmpty()
    record = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}
    store = registry.save(registry.register(registry.empty_store(spark), ask(spark, record)), path)
    more = {**record, "fields": [*record["fields"], {"name": "b", "type": "string", "default": "?"}]}
    store = registry.save(registry.register(registry.load(spark, path), ask(spark, record, more)), path)
    assert sorted(r["version"] for r in store.collect()) == [1, 2] == sorted(r["version"] for r in registry.load(spark, path).collect())


def test_a_table_is_stored_over_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(5).write.parquet(path)
    again = tables.materialize(spark.read.parquet(path).withColumn("id", F.col("id") + 1), "kept_rows", path)
    assert sorted(r["id"] for r in again.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("definition, problem", [
    ([["int"], "null"], "Nested union"), (["int", "int"], "Duplicate in union: int"),
    ({"type": "enum", "name": "E", "symbols": ["A", "A"]}, "Duplicate enum symbol"), ({"type": "enum", "name": "E", "symbols": ["1"]}, "Illegal name"),
    ({"type": "record", "name": "R", "fields": [{"name": "a", "type": "int", "default": "x"}]}, "Invalid default"),
    ({"type": "record", "name": "R", "fields": [{"name": "a", "type": "boolean", "default": 1}]}, "Invalid default"),
    ({"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "int"}, "default": [1, None]}]}, "Invalid default"),
    ({"type": "record", "name": "R", "fields": [{"name": "a", "type": "int", "order": "up"}]}, "Invalid order"),
])
def test_what_avro_refuses(definition, problem):
    with pytest.raises(ValueError, match=problem):
        avro.normal_form(definition)


def test_equal_definitions():
    def field(**more):
        return avro.normal_form({"type": "record", "name": "R", "fields": [{"name": "a", "type": ["null", "int"], "default": None, **more}]})

    assert field() == field(order="ascending", doc="d") != field(order="descending")


def test_reading_with_another_definition(spark):
    writer = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}
    reader = {**writer, "fields": [{"name": "a", "type": "long"}, {"name": "tags", "type": {"type": "array", "items": "string"}, "default": ["x"]},
                                   {"name": "at", "type": {"type": "record", "name": "At", "fields": [{"name": "x", "type": "double"}]}, "default": {"x": 1.5}}]}
    store = registry.register(registry.empty_store(spark), ask(spark, writer))
    rows = spark.createDataFrame([('{"a": 7}', {"contentType": f"application/vnd.s.v{v}+avro"} if v else {}) for v in (1, 1234567890, None)],
                                 "value string, headers map<string,string>")
    got = sorted(registry.resolve(rows, store, json.dumps(reader)).collect(), key=lambda r: str(r["headers"]))
    by = {r["headers"].get("contentType", "")[-11:]: r for r in got}
    assert by["nd.s.v1+avro"[-11:]]["data"].asDict(True) == {"a": 7, "tags": ["x"], "at": {"x": 1.5}}
    assert dict(registry.resolve(rows, store, json.dumps(reader)).dtypes)["data"].startswith("struct<a:bigint")
    assert [r["error"] for r in got if r["data"] is None] == [registry.UNKNOWN_VERSION]


def test_fold_goes_on_until_one_page_is_left(spark):
    df = spark.range(300).select(F.lit("g").alias("g"), "id", F.col("id").cast("string").alias("x"))
    got = aggregates.fold(df, ["g"], "x", [F.col("id")], lambda a, b: F.concat(a, F.lit(","), b), slice_by=F.col("id"), page_size=3, levels=1)
    assert got.first()["x"] == ",".join(map(str, range(300)))


def test_a_slice_is_measured_however_small_its_estimate(spark):
    # The generator makes Spark's estimate of the size meaningless.
    df = spark.range(10).select(F.lit("g").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(9_999))).alias("i"), "id")
    rows = ordering._sliced(df, ["g"], [F.col("i"), F.col("id")], F.lit(0), 20_000)
    sizes = [r["count"] for r in rows.groupBy("g", "_slice", "_part").count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) <= 20_000
    got = ordering.with_running(df, ["g"], [F.col("i"), F.col("id")], position="n", slice_by=F.lit(0), slice_rows=20_000)
    assert got.agg(F.sum("n")).first()[0] == 100_000 * 99_999 // 2


def test_a_hot_key_is_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    stream = spark.range(60_000, numPartitions=12).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("value"))
    table = envelopes(spark, [("t", 0, i, i, "hot" if i % 2 else str(i), f"v{i}") for i in range(50)])
    lines = stream.withColumn("error", F.when(F.col("value") % 7 == 0, "E"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = joins.join_table(stream.withColumnRenamed("value", "n"), tables.latest(table), "left")
        sent = errors.dead_letter_batches(lines, "key")
        for df, rows in ((joined, 60_000), (sent, 48_000 + sum(1 for i in range(60_000) if i % 10 >= 8 and i % 7 == 0))):
            assert len(df.collect()) == rows
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
