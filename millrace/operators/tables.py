"""Streams as tables and tables as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.envelope import ENVELOPE
from millrace.ordering import with_running
from millrace.session import folder_names, path_exists, stored
from millrace.sources.log import appends, read_log

_NEWEST = ("timestamp", "offset")


def _last_per_key(log: DataFrame, columns: Sequence[str], order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    # An aggregate, not a ranking: each task reduces its rows to one per key before the shuffle.
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return log.groupBy(*keys).agg(newest.alias("_last"))


def latest(log: DataFrame, columns: Sequence[str] = ("value",), order: Sequence[str] = _NEWEST) -> DataFrame:
    """Latest row of each key; a key whose latest value is null is gone, and null keys are ignored.

    On a stream, use update or complete mode."""
    wanted = list(dict.fromkeys([*columns, "value"]))
    last = _last_per_key(log.filter(F.col("key").isNotNull()), wanted, order, ["key"])
    return last.filter(F.col("_last.value").isNotNull()).select("key", *[F.col(f"_last.{c}") for c in columns])


def compact(log: DataFrame, order: Sequence[str] = ("offset",)) -> DataFrame:
    """Log compaction: the last record of each key in each partition, tombstones kept."""
    keys = ["destination", "partition", "key"]
    others = [c for c in log.columns if c not in keys]
    last = _last_per_key(log, others, order, keys)
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in log.columns])


# Folders of a compacted log: where each bucket stands, by the last append that is in it, and the buckets' rows.
_WHERE, _ROWS = "where", "rows"


def compact_log(spark: SparkSession, path: str, out: str, buckets: int = 64) -> DataFrame:
    """Compact a log that was stored by `sinks.outputs.append` into a folder, and return what `compact` gives for the
    whole log. Batch.

    Only appends since the last call are read, and of what is compacted only the buckets (of destination, partition and
    key) that they touch; these are written anew, the others stay where they are. A table says where each bucket
    stands. It is written last, and earlier ones are kept, so a call that fails changes nothing. With no new append
    nothing is written. Buckets should be so many that a task can rewrite one."""
    done = [int(n) for n in folder_names(spark, f"{out}/{_WHERE}") if path_exists(spark, f"{out}/{_WHERE}/{n}/_SUCCESS")]
    last, before = appends(spark, path).last, max(done, default=0)
    if last > before:
        bucket = F.pmod(F.xxhash64("destination", "partition", "key"), F.lit(buckets)).cast("int").alias("bucket")
        new = stored(compact(read_log(spark, path, since=before)).select("*", bucket), "new-rows")
        # At most one row for each bucket, here and in the table of places.
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        places = _places(spark, out, before)
        old = _buckets(spark, out, {b: n for b, n in places.items() if b in touched})
        merged = compact(new.drop("bucket").unionByName(old)).select("*", bucket)
        merged.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/{_ROWS}/append={last}")
        where = [(b, n) for b, n in {**places, **{b: last for b in touched}}.items()]
        spark.createDataFrame(where, "bucket int, append int").write.mode("overwrite").parquet(f"{out}/{_WHERE}/{last}")
        before = last
    return _buckets(spark, out, _places(spark, out, before))


def _places(spark: SparkSession, out: str, append: int) -> dict[int, int]:
    """Of each bucket, the append up to which it was compacted."""
    return {r["bucket"]: r["append"] for r in spark.read.parquet(f"{out}/{_WHERE}/{append}").collect()} if append else {}


def _buckets(spark: SparkSession, out: str, places: dict[int, int]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], ENVELOPE)
    return spark.read.schema(ENVELOPE).parquet(*[f"{out}/{_ROWS}/append={n}/bucket={b}" for b, n in sorted(places.items())])


def changelog(log: DataFrame, slice_by: Column | None = None) -> DataFrame:
    """The changes a table goes through: rows whose value differs from the one before it of the same
    key, with that value as `old`. Batch; on a stream, update mode of `latest` is the changelog."""
    order = [F.col(c) for c in _NEWEST]
    seen = with_running(log.filter(F.col("key").isNotNull()), ["key"], order,
                        previous={"old": F.col("value")}, slice_by=slice_by)
    return seen.filter(~F.col("old").eqNullSafe(F.col("value")))


def materialize(table: DataFrame, name: str, path: str | None = None, cached: bool = False) -> DataFrame:
    """Name a table so that it can be queried, stored as Parquet if a path is given. `cached` keeps
    it in executor storage, spilling to disk. A table can be stored over what it was read from."""
    if path:
        if path_exists(table.sparkSession, path):
            # Overwriting deletes the old files first, which the table may still have to be computed from.
            table = stored(table, "table")
        table.write.mode("overwrite").parquet(path)
        table = table.sparkSession.read.parquet(path)
    if cached:
        table = table.persist()
    table.createOrReplaceTempView(name)
    return table


def get(keys: DataFrame, store: DataFrame) -> DataFrame:
    """Look up a table of keys in a store; keys it does not hold come back with nulls."""
    return keys.join(store, "key", "left")


def range_scan(store: DataFrame, first: str, last: str) -> DataFrame:
    """Store rows whose key lies between two keys, both included."""
    return store.filter(F.col("key").between(first, last))


def locate(keys: DataFrame, partition: Column) -> DataFrame:
    """Partition that holds each key."""
    return keys.withColumn("partition", partition)
