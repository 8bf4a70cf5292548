"""The same operators on streams: equal to batch, restartable, late rows dropped."""

import pytest
from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, header
from millrace.functions import content
from millrace.operators import aggregates, errors, joins, rows, routing, windows
from millrace.operators.tables import latest
from millrace.plans.base import event_log
from millrace.plans.queries.conversion import EVENT
from millrace.plans.queries.joining import clicks_per_region, user_regions
from millrace.plans.queries.registries import READER, _stamped, store
from millrace.operators import registry
from millrace.session import working_path
from millrace.sources import log as src
from millrace.streaming import runner
from millrace.streaming.state import count_in_stores
from tests.compare import spark_rows
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def log(spark):
    return event_log(spark, SMALL)


@pytest.fixture(scope="module")
def folder(spark, log):
    """The log in six files, written one after the other in order of time."""
    path = working_path(spark, "log")
    for day in range(0, 30, 5):
        some = log.filter(F.dayofmonth("timestamp").between(day + 1, day + 5))
        some.coalesce(1).sortWithinPartitions("timestamp").write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == log.count()
    return path


def stream(spark, folder, log, files=1):
    return runner.stream_table(spark, folder, "*.parquet", log.schema, files)


def run(spark, df, mode="append", checkpoint=None):
    """Everything a query emits, as a table; with update mode, the last state of each batch."""
    out = working_path(spark, "out")
    runner.run_available(df, runner.write_outputs({"out": lambda b: b}, out), checkpoint or working_path(spark, "group"), mode)
    return spark.read.parquet(f"{out}/out")


OPERATORS = {
    "pass tombstones": lambda df: rows.pass_tombstones(df, F.upper),
    "words": lambda df: rows.flat_map_words(df, F.col("value")),
    "event types": lambda df: routing.by_event_type(df, "click,view"),
    "branch": lambda df: routing.branch(df, [header(EVENT_TYPE) == "click", F.col("partition") > 3]),
    "exchange": lambda df: routing.route_exchange(df, "topic", [routing.QueueBinding("q", "events.#"), routing.QueueBinding("c", "*.click")], F.col("destination")),
    "decode": lambda df: content.decode(df, EVENT),
    "bad rows": lambda df: errors.dead_letter(errors.apply_policy(
        content.decode(df.withColumn("value", F.substring("value", 1, 20)), EVENT), errors.DLQ).bad, errors.dlq_name("g")),
    "instance": lambda df: src.for_instance(df, 4, 1),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_row_operators(spark, log, folder, name):
    operator = OPERATORS[name]
    flat = lambda df: df.withColumn("headers", F.to_json("headers"))
    got = spark_rows(flat(run(spark, operator(stream(spark, folder, log)))).drop("batch"))
    assert got == spark_rows(flat(operator(log)))


def test_clicks_per_region(spark, log, folder):
    regions = user_regions(spark, SMALL)
    emitted = run(spark, clicks_per_region(stream(spark, folder, log, 2), regions), "complete")
    last = emitted.filter(F.col("batch") == emitted.agg(F.max("batch").alias("b")).scalar()).drop("batch")
    assert spark_rows(last) == spark_rows(clicks_per_region(log, regions))


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_latest_and_count(spark, log, folder, mode):
    for operator in (latest, lambda df: aggregates.count_by(df, "key")):
        emitted = run(spark, operator(stream(spark, folder, log)), mode)
        newest = emitted.groupBy("key").agg(F.max_by(F.struct(*[c for c in emitted.columns if c not in ("key", "batch")]), "batch").alias("s"))
        assert spark_rows(newest.select("key", "s.*")) == spark_rows(operator(log))


def test_interval_join(spark, log, folder):
    def joined(df):
        df = df.withWatermark("timestamp", "0 seconds") if df.isStreaming else df
        left = routing.by_event_type(df, "click").select("key", F.col("timestamp").alias("a_ts"), F.col("offset").alias("a"))
        right = routing.by_event_type(df, "purchase").select("key", F.col("timestamp").alias("b_ts"), F.col("offset").alias("b"))
        return joins.join_interval(left, right, 20_000_000, ("a_ts", "b_ts")).select("key", "a", "b")

    got, expected = spark_rows(run(spark, joined(stream(spark, folder, log))).drop("batch")), spark_rows(joined(log))
    assert expected[1] and got == expected


def test_closed_windows_are_final(spark, log, folder):
    """In append mode a window comes out once the watermark has passed it; the rest stays open."""
    def counts(df):
        return windows.tumbling(df, "1 day", count=F.count(F.lit(1)))

    got = spark_rows(run(spark, counts(stream(spark, folder, log).withWatermark("timestamp", "0 seconds"))).drop("batch"))
    expected = spark_rows(counts(log))
    assert set(got[1]) < set(expected[1]) and len(expected[1]) - len(got[1]) <= 1


def test_late_rows_are_dropped(spark, log):
    path = working_path(spark, "late")
    order = [("2024-01-10", "first"), ("2024-01-20", "second"), ("2024-01-01", "late"), ("2024-01-30", "third")]
    checkpoint, out = working_path(spark, "group"), working_path(spark, "out")
    write = runner.write_outputs({"out": lambda b: b}, out)
    for day, name in order:  # a run for each file fixes the order of arrival
        df = spark.createDataFrame([(day, name)], "day string, name string")
        df.select(F.col("day").cast("timestamp").alias("timestamp"), "name").coalesce(1).write.mode("append").parquet(path)
        events = runner.stream_table(spark, path, "*.parquet", spark.read.parquet(path).schema)
        counted = windows.tumbling(events.withWatermark("timestamp", "0 seconds"), "1 day", "name", count=F.count(F.lit(1)))
        runner.run_available(counted, write, checkpoint)
    assert sorted(r["name"] for r in spark.read.parquet(f"{out}/out").collect()) == ["first", "second"]


def test_restart_loses_and_repeats_nothing(spark, log, folder):
    """A batch that fails after part of its outputs is written is written again."""
    checkpoint, out = working_path(spark, "group"), working_path(spark, "out")
    outputs = {"all": lambda b: b.select("offset"), "some": lambda b: b.filter("partition = 1").select("offset")}
    write, calls = runner.write_outputs(outputs, out), []

    def failing(batch, batch_id):
        calls.append(batch_id)
        if batch_id == 2:
            runner.write_outputs({"all": outputs["all"]}, out)(batch, batch_id)
            raise RuntimeError("lost an executor")
        write(batch, batch_id)

    with pytest.raises(Exception, match="lost an executor"):
        runner.run_available(stream(spark, folder, log), failing, checkpoint)
    runner.run_available(stream(spark, folder, log), write, checkpoint)
    for name, transform in outputs.items():
        assert spark_rows(runner.read_output(spark, out, name)) == spark_rows(transform(log))
    assert calls == [0, 1, 2]


def test_groups_have_their_own_position(spark, log, folder):
    """A second group starts from the beginning; a rerun of the first finds nothing new."""
    checkpoint = working_path(spark, "group-a")
    seen = []
    count = lambda batch, batch_id: seen.append(batch.count())
    for point in (checkpoint, checkpoint, working_path(spark, "group-b")):
        seen.clear()
        runner.run_available(stream(spark, folder, log), count, point)
        assert sum(seen) == (0 if point == checkpoint and not seen else log.count())


def test_post_processing_follows_the_send(spark, log, folder):
    done = []
    sent = lambda batch, batch_id: done.append("sent")
    runner.run_available(stream(spark, folder, log, 10), runner.then(sent, lambda *_: done.append("first"), lambda *_: done.append("last")), working_path(spark, "g"))
    assert done == ["sent", "last"]

    def broken(batch, batch_id):
        raise RuntimeError("cannot send")

    done.clear()
    with pytest.raises(Exception, match="cannot send"):
        runner.run_available(stream(spark, folder, log, 10), runner.then(broken, lambda *_: done.append("never")), working_path(spark, "g"))
    assert done == []


def test_state_stores(spark, log, folder):
    """Totals over several batches, and the store read back as a table."""
    checkpoint = working_path(spark, "group")
    emitted = run(spark, count_in_stores(stream(spark, folder, log), "1 day"), "update", checkpoint)
    newest = emitted.groupBy("key", "start").agg(F.max("count").alias("count"))
    batch = count_in_stores(log, "1 day")
    assert spark_rows(newest) == spark_rows(batch.select("key", "start", "count"))
    state = runner.read_state(spark, checkpoint, stateVarName="my-store")
    stored = state.select(F.col("key.key").alias("key"), F.col("value.total").alias("total"))
    assert spark_rows(stored) == spark_rows(aggregates.count_by(log, "key", name="total"))


def test_resolve_on_a_stream(spark, log):
    registered = store(spark, SMALL)
    stamped = _stamped(spark, SMALL, registered).select("offset", "value", "headers")
    path = working_path(spark, "stamped")
    stamped.write.parquet(path)
    read = lambda df: registry.resolve(df, registered, READER).select("offset", "data.*")
    got = run(spark, read(runner.stream_table(spark, path, "*.parquet", stamped.schema)))
    assert spark_rows(got.drop("batch")) == spark_rows(read(stamped))
