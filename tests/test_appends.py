"""Appends to a stored log: numbered, known by their ends, one at a time; outputs of a stream that are done together."""

import threading

import pytest
from pyspark.sql import functions as F

from millrace.operators import tables
from millrace.operators.lag import lag
from millrace.session import create_file, path_exists, working_path
from millrace.sinks import outputs
from millrace.sources import log as src
from millrace.streaming import runner


def rows(spark, n, start=0, destination="d"):
    return spark.range(start, start + n).select(
        F.lit(destination).alias("destination"), (F.col("id") % 3).cast("int").alias("partition"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.col("id").cast("string").alias("value"), "id")


def offsets(spark, path):
    return sorted((r["destination"], r["partition"], r["offset"]) for r in src.read_log(spark, path).collect())


def expected(counts):
    return sorted((d, p, o) for (d, p), n in counts.items() for o in range(n))


def test_appends_go_on_without_a_look_at_the_log(spark):
    path = working_path(spark, "log")
    outputs.append(rows(spark, 30), path, F.col("id"))
    outputs.append(rows(spark, 6, 100).unionByName(rows(spark, 3, 0, "e")), path, F.col("id"))
    assert offsets(spark, path) == expected({("d", p): 12 for p in range(3)} | {("e", p): 1 for p in range(3)})
    # With the log's files gone, the next append still knows where it goes on.
    known = src.stored_positions(spark, path)
    assert {(r["destination"], r["partition"], r["begin"], r["end"]) for r in known.collect()} == {("d", p, 0, 12) for p in range(3)} | {("e", p, 0, 1) for p in range(3)}
    assert known.inputFiles() and all("/_ends/" in f for f in known.inputFiles())
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/destination=d/append=1")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    outputs.append(rows(spark, 3, 200), path, F.col("id"))
    assert max(o for d, _, o in offsets(spark, path) if d == "d") == 12
    commits = spark.createDataFrame([("g", "d", 0, 5)], "`group` string, destination string, partition int, committed bigint")
    got = {(r["group"], r["destination"]): r["lag"] for r in lag(None, commits, ["g"], src.stored_positions(spark, path)).collect()}
    assert got == {("g", "d"): 8 + 13 + 13, ("g", "e"): 3}


def test_an_empty_append_and_an_empty_log(spark):
    path = working_path(spark, "log")
    outputs.append(rows(spark, 0), path, F.col("id"))
    assert src.read_log(spark, path).count() == 0 and src.stored_positions(spark, path).count() == 0
    outputs.append(rows(spark, 3), path, F.col("id"))
    assert offsets(spark, path) == expected({("d", p): 1 for p in range(3)})


def test_two_appends_at_once_lose_nothing(spark):
    path, failed = working_path(spark, "log"), []
    outputs.append(rows(spark, 3), path, F.col("id"))

    def write(n):
        while True:
            try:
                return outputs.append(rows(spark, 30, 1000 * n), path, F.col("id"))
            except src.AppendInProgress:
                failed.append(n)
                threading.Event().wait(0.2)

    writers = [threading.Thread(target=write, args=(n,)) for n in (1, 2, 3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    assert offsets(spark, path) == expected({("d", p): 31 for p in range(3)}) and failed


def test_a_failed_append_leaves_the_log_as_it_was(spark):
    path = working_path(spark, "log")
    outputs.append(rows(spark, 3), path, F.col("id"))
    bad = rows(spark, 30, 100).withColumn("value", F.when(F.col("id") == 110, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        outputs.append(bad, path, F.col("id"))
    assert offsets(spark, path) == expected({("d", p): 1 for p in range(3)})
    outputs.append(rows(spark, 3, 200), path, F.col("id"))
    assert offsets(spark, path) == expected({("d", p): 2 for p in range(3)})


def test_a_dead_writer_is_given_up(spark):
    path = working_path(spark, "log")
    outputs.append(rows(spark, 3), path, F.col("id"))
    n = src.begin_append(spark, path)  # and then its driver dies, with some files written
    rows(spark, 9, 50).drop("id").withColumn("append", F.lit(n)).write.mode("append").partitionBy("destination", "append").parquet(path)
    with pytest.raises(src.AppendInProgress, match="abandon_append"):
        outputs.append(rows(spark, 3, 100), path, F.col("id"))
    assert src.read_log(spark, path).count() == 3
    src.abandon_append(spark, path, n)
    outputs.append(rows(spark, 3, 100), path, F.col("id"))
    assert offsets(spark, path) == expected({("d", p): 2 for p in range(3)})


def test_a_log_without_appends_is_read_as_it_is(spark):
    path = working_path(spark, "log")
    rows(spark, 5).select("destination", "partition", F.col("id").alias("offset"), "value").write.partitionBy("destination").parquet(path)
    assert src.read_log(spark, path).count() == 5


def test_files_are_created_once(spark):
    path = working_path(spark, "one") + "/deep/file"
    assert create_file(spark, path) and not create_file(spark, path) and path_exists(spark, path)


def test_a_crash_between_destinations_shows_neither(spark):
    folder = working_path(spark, "out")
    batch = lambda n: spark.range(10 * n, 10 * n + 10)
    broken = {"on": False}

    def second(df):
        if broken["on"]:
            raise RuntimeError("crash")
        return df.where("id % 2 = 0")

    write = runner.write_outputs({"a": lambda df: df, "b": second}, folder)
    write(batch(0), 0)
    broken["on"] = True
    with pytest.raises(RuntimeError, match="crash"):
        write(batch(1), 1)
    seen = lambda name: sorted(r["id"] for r in runner.read_output(spark, folder, name).collect())
    assert seen("a") == list(range(10)) and seen("b") == list(range(0, 10, 2))
    broken["on"] = False
    write(batch(1), 1)
    assert seen("a") == list(range(20)) and seen("b") == list(range(0, 20, 2))
    # A batch that is done is not written again.
    write(batch(7), 1)
    assert seen("a") == list(range(20))


def test_nothing_is_shown_before_the_first_batch_is_done(spark):
    folder = working_path(spark, "out")
    write = runner.write_outputs({"a": lambda df: df, "b": lambda df: df.select(F.raise_error(F.lit("crash")).alias("x"))}, folder)
    with pytest.raises(Exception, match="crash"):
        write(spark.range(3), 0)
    runner.write_outputs({"c": lambda df: df}, folder)(spark.range(3), 0)
    assert runner.read_output(spark, folder, "c").count() == 3


def test_compaction_reads_what_is_new(spark):
    path, out = working_path(spark, "log"), working_path(spark, "compacted")
    keyed = lambda n, start, keys: rows(spark, n, start).withColumn("key", F.concat(F.lit("k"), (F.col("id") % keys).cast("string")))
    flat = lambda df: sorted((r["destination"], r["partition"], r["offset"], r["key"], r["value"]) for r in df.collect())
    outputs.append(keyed(300, 0, 90), path, F.col("id"))
    first = tables.compact_log(spark, path, out, buckets=16)
    assert flat(first) == flat(tables.compact(src.read_log(spark, path))) and first.count() == 90
    # Two keys change, one goes, one is new: their buckets alone are written again.
    few = keyed(6, 300, 2).withColumn("value", F.when(F.col("id") % 2 == 0, F.col("value")))
    outputs.append(few.withColumn("key", F.when(F.col("id") == 305, F.lit("new")).otherwise(F.col("key"))), path, F.col("id"))
    second = tables.compact_log(spark, path, out, buckets=16)
    assert flat(second) == flat(tables.compact(src.read_log(spark, path)))
    assert flat(first) != flat(second) and len(flat(first)) == 90  # the earlier version is still there
    again = [f for f in second.inputFiles() if "append=2" in f]
    assert again and len({f.split("bucket=")[1].split("/")[0] for f in again}) <= 6 < len({f.split("bucket=")[1].split("/")[0] for f in second.inputFiles()})
    # A second run sees the records of the new append only.
    files = {r[0] for r in src.read_log(spark, path, since=1).select(F.input_file_name()).collect()}
    assert src.read_log(spark, path, since=1).count() == 6 and files and all("append=2" in f for f in files)
    assert flat(tables.compact_log(spark, path, out, buckets=16)) == flat(second)
    assert tables.compact_log(spark, working_path(spark, "none"), working_path(spark, "out")).count() == 0
