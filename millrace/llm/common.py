"""Helpers shared by the operators: words, running sums over an order of any size, worker state."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stored, working_path

# Words are runs of anything but ASCII white space, as `bytes.split()` cuts them.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows that a task of a range-partitioned step sorts at most, about; more rows get more tasks.
ROWS_PER_TASK = 4_000_000

# Bytes of rows that Spark hands to Python at once, about. Its own bound of 64 MB is held by the JVM and by Python, twice
# while buffers grow, for each core.
BATCH_BYTES = 4 << 20


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema with more fields at its end."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def bounded_batches(spark: SparkSession) -> None:
    """From now on, rows go to Python about BATCH_BYTES at a time in this session, unless it asks for less."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m"))
    if held > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def range_tasks(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def running_total(
    rows: DataFrame, order: Sequence[str], weight: str | None = None, name: str = "before", tasks: int | None = None
) -> DataFrame:
    """Add `name`: the sum of `weight` (null: 0; no weight: 1 for each row) over all rows earlier in `order`. Batch;
    runs jobs.

    The rows are cut into ranges of the order, summed up inside each range, and written to a table, so that a lost
    executor cannot change the ranges; the base of a range is the sum of the ranges before it, out of one row for
    each range. `order` should be total: tied rows go to one range, in any order."""
    spark = rows.sparkSession
    plain = rows.withColumn("_weight", F.lit(1) if weight is None else F.coalesce(F.col(weight), F.lit(0)))
    plain = plain.withColumn("_weight", F.col("_weight").cast("bigint"))
    tasks = tasks or range_tasks(spark, rows.count())
    cut = plain.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = with_fields(cut.schema, "_part int, _upto bigint")
    names = schema.names

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            weights = batch.column("_weight").to_numpy(zero_copy_only=False)
            upto = total + np.cumsum(weights) - weights
            total += int(weights.sum())
            columns = [*batch.columns, pa.array(np.full(len(upto), part, np.int32)), pa.array(upto)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ranged = stored(cut.mapInArrow(sum_up, schema), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum("_weight").alias("_total"))
    # One row for each range.
    sums = sorted((r["_part"], r["_total"]) for r in totals.collect())
    bases = np.cumsum([0] + [total for _, total in sums]).tolist()
    # Out of Arrow, since a list of rows goes through Python workers of its own on the executors, which stay there.
    table = spark.createDataFrame(pa.table({"_part": pa.array([part for part, _ in sums], pa.int32()), "_base": pa.array(bases[:-1], pa.int64())}))
    joined = ranged.join(table, "_part")
    return joined.withColumn(name, F.col("_base") + F.col("_upto")).drop("_weight", "_part", "_upto", "_base")


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """The names, each with underscores put in front until no column has it, upper and lower case taken alike."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of a frame but those of these names, upper and lower case taken alike."""
    return [c for c in df.columns if c.lower() not in {n.lower() for n in names}]


def quoted(name: str) -> Column:
    """A column by its whole name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """Write a frame as a table under the shared root, cut into buckets by a hash of `keys` and sorted by them inside
    each, and read it back: tables of as many buckets are joined by the keys without an exchange. Nothing stays in
    the catalog."""
    spark, path = df.sparkSession, working_path(df.sparkSession, name)
    known = path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(known)
    table = spark.table(known)
    spark.sql(f"DROP TABLE {known}")
    return table


def stored_by(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """As `stored`, with a folder for each value of the columns, so that a filter on them reads its rows only."""
    path = working_path(df.sparkSession, name)
    df.write.partitionBy(*columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """A value kept by a Python worker across tasks (a loaded tokenizer, a cache)."""
    held = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def forget_worker_state() -> None:
    """Drop what earlier tasks of other operators left in this worker (a tokenizer's cache takes hundreds of MB)."""
    if sys.modules.pop("_millrace_worker", None) is not None:
        release()


def release() -> None:
    """Give freed memory back to the machine instead of keeping it for later tasks of this worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass


def releasing(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function over batches; at its end the worker, which stays for later tasks, releases its memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            del batches
            release()

    return run


def text_bytes(column: pa.Array, at_once: int = 200) -> Iterator[bytes | None]:
    """The values of a text or binary column as bytes, of which few are held at a time."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    for i in range(0, len(column), at_once):
        yield from column.slice(i, at_once).cast(kind).to_pylist()


def batch_of(schema: Sequence[tuple[str, pa.DataType]], columns: Sequence) -> pa.RecordBatch:
    """A record batch out of lists or numpy arrays."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, (_, kind) in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in schema])
