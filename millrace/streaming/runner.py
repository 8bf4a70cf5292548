"""Running operators as streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.session import create_file, delete_file, folder_names, working_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, folder: str, file_pattern: str, schema: T.StructType, files_per_batch: int = 0) -> DataFrame:
    """The Parquet files of a folder as a stream; `files_per_batch` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Process what is there and stop; the next run with the same checkpoint goes on from here.
    A checkpoint is a consumer group: each has its own position."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    query = writer.foreachBatch(write).start()
    query.awaitTermination()
    return query


def write_outputs(outputs: Mapping[str, Callable[[DataFrame], DataFrame]], folder: str) -> Callable[[DataFrame, int], None]:
    """A batch writer for several destinations of the same input.

    Each destination's part of a micro-batch is one folder named by the batch id. After the last destination a marker
    says that the batch is done; `read_output` shows the batches up to it, so readers see all destinations of a batch or
    none, and a batch that is done is not written again. A batch that fails in between is written anew when it is
    replayed, so each destination gets every row once. For several destinations the batch is written to a table first
    and read back from it, so that it is computed once even if executors are lost on the way."""
    writer = f"{folder}/{_DONE}/{'+'.join(sorted(quote(name, safe='') for name in outputs))}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, _done(batch.sparkSession, writer)
        if batch_id <= max(before, default=-1):
            return
        if len(outputs) > 1:
            staged = f"{folder}/_batch"
            batch.write.mode("overwrite").parquet(staged)
            batch = spark.read.schema(batch.schema).parquet(staged)
        for destination, transform in outputs.items():
            transform(batch).write.mode("overwrite").parquet(f"{folder}/{destination}/batch={batch_id}")
        create_file(spark, f"{writer}/{batch_id}")
        for old in before:  # the last marker is enough
            delete_file(spark, f"{writer}/{old}")

    return write


# Folder beside the destinations: for each writer the last batch that is done.
_DONE = "_done"


def _done(spark: SparkSession, writer: str) -> list[int]:
    return [int(name) for name in folder_names(spark, writer) if name.isdigit()]


def read_output(spark: SparkSession, folder: str, destination: str) -> DataFrame:
    """A destination's rows, as far as batches are done in all destinations of their writer."""
    writers = [name for name in folder_names(spark, f"{folder}/{_DONE}") if quote(destination, safe="") in name.split("+")]
    rows = spark.read.parquet(f"{folder}/{destination}")
    if writers:
        last = max((n for name in writers for n in _done(spark, f"{folder}/{_DONE}/{name}")), default=-1)
        rows = rows.where(F.col("batch") <= last)
    return rows.drop("batch")


def then(write: Callable[[DataFrame, int], None], *actions: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Do something after a batch has been sent. Of several actions only the last one runs, and none
    if sending fails."""

    def both(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if actions:
            actions[-1](batch, batch_id)

    return both


def run_functions(
    stream: Callable[[], DataFrame],
    functions: Mapping[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    mode: str = "append",
) -> dict[str, StreamingQuery]:
    """Run independent functions side by side: one query, checkpoint and state for each name."""
    spark = SparkSession.active()
    queries = {}
    for name, function in functions.items():
        write = write_outputs({name: lambda batch: batch}, folder)
        queries[name] = (function(stream()).writeStream.outputMode(mode)
                         .option("checkpointLocation", working_path(spark, f"group-{name}"))
                         .trigger(availableNow=True).foreachBatch(write).start())
    for query in queries.values():
        query.awaitTermination()
    return queries


def use_rocksdb(spark: SparkSession) -> None:
    """Keep operator state on executors' disks instead of in their memory. This sets the session's state store provider
    for all later queries; `build_session` can be given the same setting at the start."""
    spark.conf.set(STATE_STORE, ROCKSDB)
    spark.streams  # creates the state store coordinator, which a batch query needs as well


def read_state(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """The state a query left in its checkpoint, as a table."""
    return spark.read.format("statestore").options(**options).load(checkpoint)

