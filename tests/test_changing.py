"""Tables that change while the stream runs, against the same operators in batch."""

import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.operators import joins, windows
from millrace.operators.tables import latest
from millrace.plans.base import event_log, noisy_log
from millrace.session import working_path
from millrace.streaming import changing, runner, state
from tests.compare import spark_rows
from tests.conftest import SMALL
from tests.test_streams import run

ROW = "key string, timestamp timestamp, offset bigint, value string, amount decimal(9,2), tags map<string,string>, made timestamp_ntz"


def rows_of(rng, n, start, keys, prefix):
    out = []
    for i in range(n):
        at = pd.Timestamp("2024-01-01") + pd.Timedelta(microseconds=rng.randrange(start, start + 50_000_000))
        out.append((rng.choice(keys), at.to_pydatetime(), 1000 * start // 50_000_000 + i, f"{prefix}{start}-{i}", None, {"a": f"{i}\"é"}, at.to_pydatetime()))
    return out


def files(spark, parts, schema):
    """A folder with a file for each part, in this order of arrival."""
    path = working_path(spark, "parts")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def streamed(spark, path, schema, each=1):
    return runner.stream_table(spark, path, "*.parquet", spark.read.parquet(path).schema, each)


@pytest.mark.parametrize("salt", [1, 3])
def test_join_with_a_changing_table(spark, salt):
    """Changes come late, but before the watermark passes them: the rows they concern must have waited for them."""
    rng = random.Random(1)
    keys = ["a", "b", "hot", "hot", "hot", None]
    stream_parts = [rows_of(rng, 60, 50_000_000 * n, keys, "s") for n in range(5)]
    table_parts = [rows_of(rng, 25, 50_000_000 * n, keys, "t") for n in range(5)]
    # Each file of changes comes a file later than the rows of its time.
    left, right = files(spark, stream_parts + [[]], ROW), files(spark, [[]] + table_parts, ROW)
    rename = lambda df: df.select("key", "timestamp", "offset", F.col("value").alias("plan"), F.col("tags").alias("was"))
    got = run(spark, changing.join_changing_table(streamed(spark, left, ROW), rename(streamed(spark, right, ROW)), ["plan", "was"], "offset",
                                                  delay="60 seconds", salt=salt)).drop("batch")
    batch = joins.join_asof(spark.read.parquet(left), rename(spark.read.parquet(right)), ["plan", "was"], "offset")
    flat = lambda df: df.withColumns({c: F.to_json(c) for c in ("tags", "was")}).select(sorted(df.columns))
    got, expected = flat(got).collect(), flat(batch).collect()
    # Rows that the watermark has not passed stay open.
    assert set(map(tuple, got)) <= set(map(tuple, expected)) and len(got) == len(set(map(tuple, got)))
    limit = max(r["timestamp"] for r in got if r["key"] is not None)
    assert sorted(map(str, got)) == sorted(str(r) for r in expected if r["key"] is None or r["timestamp"] <= limit)
    assert len(got) > 200 and sum(r["plan"] is not None for r in got) > 100


def test_join_inner_and_defaults(spark):
    at = lambda s: (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    schema = "key string, timestamp timestamp, offset bigint, value string"
    table = files(spark, [[("a", at(5), 0, "x"), ("a", at(5), 1, "y"), ("a", at(20), 2, None), ("z", at(100), 3, "end")]], schema)
    stream = files(spark, [[("a", at(4), 0, "1"), ("a", at(5), 1, "2"), ("a", at(19), 2, "3"), ("a", at(20), 3, "4"), ("b", at(9), 4, "5"), ("z", at(100), 5, "end")]], schema)

    def joined(**how):
        changes = streamed(spark, table, schema).withColumnRenamed("value", "plan")
        out = run(spark, changing.join_changing_table(streamed(spark, stream, schema), changes, ["plan"], "offset", **how))
        return sorted((r["value"], r["plan"]) for r in out.collect() if r["value"] != "end")

    assert joined(defaults={"plan": "none"}) == [("1", "none"), ("2", "y"), ("3", "y"), ("4", "none"), ("5", "none")]
    assert joined(how="inner") == [("2", "y"), ("3", "y")]
    with pytest.raises(ValueError, match="left or inner"):
        joined(how="full")


def test_old_versions_are_forgotten(spark):
    at = lambda s: (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    schema = "key string, timestamp timestamp, offset bigint, value string"
    table = files(spark, [[("a", at(10 * n + i), i, f"{n}-{i}") for i in range(9)] for n in range(4)], schema)
    stream = files(spark, [[("a", at(10 * n + i), i, "s") for i in range(9)] for n in range(4)], schema)
    checkpoint = working_path(spark, "group")
    changes = streamed(spark, table, schema).withColumnRenamed("value", "plan")
    run(spark, changing.join_changing_table(streamed(spark, stream, schema), changes, ["plan"], "offset"), checkpoint=checkpoint)
    held = runner.read_state(spark, checkpoint, stateVarName="versions")
    assert held.count() < 12


def test_latest_with_removals(spark):
    schema = "key string, timestamp timestamp, offset bigint, value string, n int"
    at = lambda s: (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    parts = [[("a", at(1), 0, "x", 1), ("b", at(1), 1, "y", 1), ("c", at(1), 2, None, 1), (None, at(1), 3, "z", 1)],
             [("a", at(2), 4, None, 2), ("b", at(0), 5, None, 2), ("b", at(1), 6, "y", 1)],
             [("a", at(1), 7, "late", 3), ("c", at(3), 8, "w", 3), ("c", at(2), 9, None, 3)],
             [("a", at(4), 10, "again", 4), ("c", at(5), 11, None, 4)]]
    path = files(spark, parts, schema)
    out = run(spark, changing.latest_changes(streamed(spark, path, schema), ["value", "n"]), "update")
    got = sorted((r["batch"], r["key"], r["value"], r["n"], r["removed"]) for r in out.collect())
    assert got == [(0, "a", "x", 1, False), (0, "b", "y", 1, False), (1, "a", None, None, True), (2, "c", "w", 3, False), (3, "a", "again", 4, False), (3, "c", None, None, True)]


def test_latest_changes_end_at_the_table(spark):
    log = noisy_log(spark, SMALL).select("key", "timestamp", "offset", "value")
    path = working_path(spark, "log")
    for day in range(0, 30, 6):
        log.where(F.dayofmonth("timestamp").between(day + 1, day + 6)).coalesce(1).write.mode("append").parquet(path)
    out = run(spark, changing.latest_changes(streamed(spark, path, None)), "update")
    newest = out.groupBy("key").agg(F.max_by(F.struct("value", "removed"), "batch").alias("s")).where("not s.removed").select("key", "s.value")
    assert spark_rows(newest) == spark_rows(latest(log)) and out.where("removed").count() > 0


def test_latest_reduces_in_the_task():
    batch = lambda rows: pa.RecordBatch.from_pylist([{"key": k, "at": a, "tie": t, "body": b} for k, a, t, b in rows])
    rows = [batch([("hot", n, 0, str(n)) for n in range(1000)] + [("a", 1, 2, "y"), ("a", 1, 1, "x")]), batch([("hot", 5, 0, "old"), ("b", 0, 0, "b"), ("a", 1, 2, "same")])]
    got = sorted((r["key"], r["at"], r["tie"], r["body"]) for b in changing.newest_in_task(iter(rows)) for r in b.to_pylist())
    assert got == [("a", 1, 2, "y"), ("b", 0, 0, "b"), ("hot", 999, 0, "999")]
    assert sum(b.num_rows for b in changing.newest_in_task(iter(rows), most=1)) == 5


def test_a_hot_key_is_counted_in_the_task():
    batch = lambda rows: pa.RecordBatch.from_pylist([{"key": k, "start": s, "count": 1} for k, s in rows], schema=pa.schema(
        [("key", pa.string()), ("start", pa.int64()), ("count", pa.int64())]))
    rows = [batch([("hot", n % 3) for n in range(800)] + [("k" + str(n), 0) for n in range(200)]) for _ in range(5)]
    got = [r for b in state.counted_in_task(iter(rows)) for r in b.to_pylist()]
    assert len(got) == 203 and sum(r["count"] for r in got if r["key"] == "hot") == 4000
    got = [r for b in state.counted_in_task(iter(rows), most=10) for r in b.to_pylist()]
    assert len(got) == 1015 and sum(r["count"] for r in got) == 5000


def test_late_rows_by_source(spark):
    """One source runs ahead of the other: only rows behind their own source's time are late."""
    rng = random.Random(3)
    log = []
    for n in range(300):
        source = rng.choice(["fast", "slow"])
        seconds = n * (100 if source == "fast" else 1) + rng.randrange(-40, 40)
        log.append((source, rng.randrange(2), n, None if n % 37 == 0 else (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=seconds)).to_pydatetime(), {"h": str(n)}))
    schema = "destination string, partition int, offset bigint, timestamp timestamp, headers map<string,string>"
    path = files(spark, [log[i : i + 60] for i in range(0, 300, 60)], schema)
    flat = lambda df: spark_rows(df.withColumn("headers", F.to_json("headers")))
    for grace in (0, 25_000):
        got = run(spark, changing.flag_late_rows(streamed(spark, path, schema), grace_ms=grace)).drop("batch")
        expected = windows.flag_late(spark.createDataFrame(log, schema), [F.col("offset")], grace=f"{grace // 1000} seconds")
        assert flat(got) == flat(expected) and 0 < got.where("late").count() < 200


@pytest.mark.parametrize("width", [7, 100_000])
def test_late_rows_in_slices(spark, width):
    """The rows of a source are judged slice by slice, with the time before each; its processor sees a time for a slice."""
    rng = random.Random(5)
    at = lambda s: (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    log = [(rng.choice("ab"), 0, n - 100, None if n % 41 == 0 else at(n + rng.randrange(-30, 30))) for n in range(200)]
    schema = "destination string, partition int, offset bigint, timestamp timestamp"
    path = files(spark, [log[:90], log[90:]], schema)
    got = run(spark, changing.flag_late_rows(streamed(spark, path, schema), width=width)).drop("batch")
    expected = windows.flag_late(spark.createDataFrame(log, schema), [F.col("offset")], grace="0 seconds")
    assert spark_rows(got) == spark_rows(expected) and 20 < got.where("late").count() < 200


def test_times_of_slices_are_reduced_in_the_task():
    batch = lambda rows: pa.RecordBatch.from_pylist([{"source0": s, "slice": n, "at": a} for s, n, a in rows])
    rows = [batch([("a", n % 2, n) for n in range(1000)]), batch([("a", 1, 5), ("b", 0, 7)])]
    got = sorted((r["source0"], r["slice"], r["at"]) for b in changing.greatest_in_task(iter(rows)) for r in b.to_pylist())
    assert got == [("a", 0, 998), ("a", 1, 999), ("b", 0, 7)]


def test_latest_asks_its_state_once_a_key():
    """Each call of a state goes through a socket: one to read, and one to write only if there is something newer."""

    class State:
        calls, held = [], None

        def exists(self):
            self.calls.append("exists")
            return self.held is not None

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

    processor = changing.LatestValue(None)
    processor.last = State()
    put = lambda *rows: [tuple(r) for r in processor.handleInputRows(("a",), iter([Row(at=t, tie=i, body=b, removed=b is None) for t, i, b in rows]), None)]
    assert put((1, 0, "x"), (2, 0, "y"), (0, 9, "old")) == [("a", "y", False)] and put((1, 5, "late")) == [] and put((3, 0, None)) == [("a", None, True)]
    assert processor.last.calls == ["get", "update", "get", "get", "update"]
