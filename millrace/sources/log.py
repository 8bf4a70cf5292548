"""Reading destinations: choice of log, event time, offsets and start positions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import ENVELOPE, present
from millrace.ordering import with_running
from millrace.session import create_file, folder_names, glob_names, path_exists, stored

EARLIEST, LATEST = "earliest", "latest"

LOG = ["destination", "partition"]

OFFSETS_PER_SLICE = 1_000_000


# Folder beside a log's destinations: what each append has finished, and where the partitions end after it.
ENDS = "_ends"
_APPENDED = "append"
_ENDS_TYPE = "destination string, partition int, begin bigint, end bigint"


class AppendInProgress(RuntimeError):
    """Another append to the log has begun and not finished; nothing was written."""


@dataclass(frozen=True)
class Appends:
    """The appends of a stored log by number: the last finished one, those that failed and those that run (or whose
    writer died)."""

    last: int
    failed: tuple[int, ...]
    running: tuple[int, ...]


def appends(spark: SparkSession, path: str) -> Appends:
    names = folder_names(spark, f"{path}/{ENDS}")
    finished = {int(n) for n in names if n.isdigit() and path_exists(spark, f"{path}/{ENDS}/{n}/_SUCCESS")} if names else set()
    failed = {int(n.removesuffix(".failed")) for n in names if n.endswith(".failed")}
    begun = {int(n.removesuffix(".begun")) for n in names if n.endswith(".begun")}
    return Appends(max(finished, default=0), tuple(sorted(failed)), tuple(sorted(begun - finished - failed)))


def begin_append(spark: SparkSession, path: str) -> int:
    """The number of a new append, which no other writer gets."""
    known = appends(spark, path)
    n = max([known.last, *known.failed], default=0) + 1
    if known.running or not create_file(spark, f"{path}/{ENDS}/{n:08d}.begun"):
        raise AppendInProgress(f"append {(known.running or (n,))[0]} to {path} is not finished; if its writer died, call abandon_append")
    return n


def abandon_append(spark: SparkSession, path: str, n: int) -> None:
    """Give up an append whose writer died: what it wrote is never read."""
    create_file(spark, f"{path}/{ENDS}/{n:08d}.failed")


def finish_append(spark: SparkSession, path: str, n: int) -> None:
    """Write the ends of all partitions after an append; with that its records count."""
    new = spark.createDataFrame([], _ENDS_TYPE)
    if glob_names(spark, f"{path}/destination=*/{_APPENDED}={n}"):
        files = spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField(_APPENDED, T.IntegerType())])).option("basePath", path)
        new = positions(files.parquet(f"{path}/destination=*/{_APPENDED}={n}"))
    both = stored_positions(spark, path).unionByName(new)
    both.groupBy(*LOG).agg(F.min("begin").alias("begin"), F.max("end").alias("end")).write.parquet(f"{path}/{ENDS}/{n:08d}")


def stored_positions(spark: SparkSession, path: str) -> DataFrame:
    """As `positions`, of a log that was stored by `append`: read from the ends beside it, one row for each partition,
    without a look at the log."""
    last = appends(spark, path).last
    return spark.read.schema(_ENDS_TYPE).parquet(f"{path}/{ENDS}/{last:08d}") if last else spark.createDataFrame([], _ENDS_TYPE)


def read_log(spark: SparkSession, path: str, stream: bool = False, since: int = 0, **options: str) -> DataFrame:
    """A log stored as Parquet partitioned by `destination`. Of a log stored by `append`, the appends that are finished:
    all records of one are there, or none; with `since`, of later ones only. A stream takes files as they are written, those of an append that fails
    later included."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    if not path_exists(spark, f"{path}/{ENDS}"):
        return reader.schema(ENVELOPE).parquet(path)
    log = reader.schema(T.StructType([*ENVELOPE.fields, T.StructField(_APPENDED, T.IntegerType())])).parquet(path)
    if not stream:
        known = appends(spark, path)
        log = log.where(F.col(_APPENDED).between(since + 1, known.last) & ~F.col(_APPENDED).isin(*known.failed))
    return log.select(*ENVELOPE.names)


def read_broker(spark: SparkSession, servers: str, destinations: str = "", pattern: str = "",
                starting: str = EARLIEST, stream: bool = True, **options: str) -> DataFrame:
    """A log kept by a Kafka cluster; needs Spark's Kafka connector on the class path.

    `destinations` is a comma list, `pattern` a regular expression; `starting` is earliest, latest
    or the connector's JSON of offsets."""
    choice = {"subscribePattern": pattern} if pattern else {"subscribe": destinations}
    reader = (spark.readStream if stream else spark.read).format("kafka").options(**options)
    raw = (reader.option("kafka.bootstrap.servers", servers).options(**choice)
           .option("startingOffsets", starting).option("includeHeaders", "true").load())
    return from_broker_rows(raw)


def from_broker_rows(raw: DataFrame) -> DataFrame:
    """Envelopes from the rows of Spark's Kafka source (topic, key, value, headers, ...)."""
    # A header may occur more than once in a record; the last one counts.
    none = F.create_map().cast("map<string,string>")
    merged = F.aggregate("headers", none, lambda known, h: F.map_concat(
        F.map_filter(known, lambda k, _: k != h["key"]), F.create_map(h["key"], F.decode(h["value"], "UTF-8"))))
    return raw.select(
        F.col("topic").alias("destination"), "partition", "offset", "timestamp",
        F.col("key").cast("string"), F.col("value").cast("string"),
        F.coalesce(merged, none).alias("headers"))


def to_broker_rows(log: DataFrame) -> DataFrame:
    """Rows for Spark's Kafka sink: topic, partition, key, value and headers as bytes."""
    pairs = F.transform(F.map_entries(present()), lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")))
    return log.select(F.col("destination").alias("topic"), "partition", F.encode("key", "UTF-8").alias("key"),
                      F.encode(F.col("value").cast("string"), "UTF-8").alias("value"), pairs.alias("headers"))


def names(destinations: str) -> list[str]:
    return [d.strip() for d in destinations.split(",") if d.strip()]


def from_destinations(log: DataFrame, destinations: str) -> DataFrame:
    """One binding over a comma list of destinations. A plain predicate on the column the log is
    stored by, so only the named folders are read."""
    return log.filter(F.col("destination").isin(names(destinations)))


def from_pattern(log: DataFrame, pattern: str, multiplex: bool = False) -> DataFrame:
    """One binding over all destinations whose whole name matches a regular expression."""
    if multiplex:
        raise ValueError("a destination pattern cannot be combined with multiplex")
    return log.filter(F.col("destination").rlike(f"^(?:{pattern})$"))


def from_bindings(log: DataFrame, destinations: str, multiplex: bool = False) -> list[DataFrame]:
    """One frame for each destination of a comma list, or a single one for all if multiplexed."""
    if multiplex:
        return [from_destinations(log, destinations)]
    return [from_destinations(log, name) for name in names(destinations)]


def with_event_time(log: DataFrame, field: Column | None = None, wall_clock: bool = False,
                    late_by: str | None = None) -> DataFrame:
    """Choose the event time: the record's own (default), the wall clock, or a payload field.
    `late_by` sets the watermark for streams."""
    if field is not None:
        log = log.withColumn("timestamp", field.cast("timestamp"))
    elif wall_clock:
        log = log.withColumn("timestamp", F.current_timestamp())
    return log.withWatermark("timestamp", late_by) if late_by else log


def assign_offsets(log: DataFrame, tie_breaker: Column, slice_by: Column | None = None,
                   base: DataFrame | None = None) -> DataFrame:
    """Number the records of each partition from 0 by (timestamp, tie breaker). Batch; runs jobs.

    `slice_by` must not decrease with (timestamp, tie breaker); see `millrace.ordering`. `base`, the
    `positions` of what is stored already, makes each partition go on at its end."""
    columns = list(dict.fromkeys([*log.columns, "offset"]))
    numbered = with_running(log, LOG, [F.col("timestamp"), tie_breaker], position="_offset", slice_by=slice_by)
    first = F.lit(0)
    if base is not None:
        # One row for each partition; stored, so that its size is known and the log need not be shuffled.
        ends = stored(base.select(*LOG, F.col("end").alias("_base")), "ends")
        numbered, first = numbered.join(ends, LOG, "left"), F.coalesce("_base", F.lit(0))
    return numbered.withColumn("offset", F.col("_offset") + first).select(*columns)


def positions(log: DataFrame) -> DataFrame:
    """First offset and next offset to be written of each partition."""
    return log.groupBy(*LOG).agg(F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"))


def store_commits(commits: DataFrame, path: str) -> DataFrame:
    """Add commits (group, destination, partition, committed) to a stored table and return what counts: the newest
    of each group and partition. Batch.

    Commits are appended with the time of the call, so resetting a group is one more commit; a lost call leaves the
    table as it was."""
    stamped = commits.select("group", *LOG, F.col("committed").cast("bigint").alias("committed"),
                             F.current_timestamp().alias("at"))
    stamped.write.mode("append").parquet(path)
    return read_commits(commits.sparkSession, path)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The newest commit of each group and partition; none where nothing is stored yet."""
    schema = "`group` string, destination string, partition int, committed bigint, at timestamp"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).drop("at")
    newest = spark.read.schema(schema).parquet(path).groupBy("group", *LOG)
    return newest.agg(F.max_by("committed", F.struct("at", "committed")).alias("committed"))


def _known(table: DataFrame, *columns: str) -> DataFrame:
    """A table of one row for each partition, stored: Spark then knows its size and broadcasts it where that allows,
    instead of shuffling the log to meet it."""
    return stored(table.select(*columns), "commits")


def committed_before(log: DataFrame, group: str, condition: Column) -> DataFrame:
    """The commits a group has left after reading every record that meets `condition`."""
    return (log.filter(condition).groupBy(*LOG).agg((F.max("offset") + 1).alias("committed"))
            .select(F.lit(group).alias("group"), *LOG, "committed"))


def required_groups(log: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Commits at the first offset for groups named by the producer, so that they see what was sent
    before their first consumer starts."""
    return (log.groupBy(*LOG).agg(F.min("offset").alias("committed"))
            .withColumn("group", F.explode(F.array(*[F.lit(g) for g in groups])))
            .select("group", *LOG, "committed"))


def start_from(log: DataFrame, committed: DataFrame, group: str | None = None, start_offset: str | None = None,
               reset: bool = False) -> DataFrame:
    """The records one group is given. Batch; on a stream the checkpoint plays the commits' part.

    A committed offset wins unless `reset`. Without one, a named group starts at the earliest record
    and an anonymous one (no name) at the latest, unless `start_offset` says otherwise."""
    start = start_offset or (EARLIEST if group else LATEST)
    if start not in (EARLIEST, LATEST):
        raise ValueError(f"unknown start offset: {start}")
    if reset or group is None:
        return log if start == EARLIEST else log.filter(F.lit(False))
    own = _known(committed.filter(F.col("group") == group), *LOG, "committed")
    if start == EARLIEST:
        joined = log.join(own, LOG, "left")
        return joined.filter(F.col("committed").isNull() | (F.col("offset") >= F.col("committed"))).drop("committed")
    return log.join(own, LOG).filter(F.col("offset") >= F.col("committed")).drop("committed")


def seek(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Start at an offset for each partition, from a (destination, partition, start) table.
    Partitions it does not name are read from the beginning."""
    joined = log.join(_known(starts, *LOG, "start"), LOG, "left")
    return joined.filter(F.col("offset") >= F.coalesce("start", F.lit(0))).drop("start")


def for_groups(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Every group's view of the log in one pass: a record is given once to each group that has not
    got past it. Which member of the group works on it is Spark's choice of task."""
    joined = log.join(_known(committed, "group", *LOG, "committed"), LOG)
    return joined.filter(F.col("offset") >= F.col("committed")).drop("committed")


def for_instance(log: DataFrame, count: int, *indexes: int) -> DataFrame:
    """The static share of one instance, or of several, out of `count`."""
    if any(not 0 <= i < count for i in indexes):
        raise ValueError("an instance index must be at least 0 and less than the instance count")
    return log.filter(F.pmod("partition", F.lit(count)).isin(list(indexes)))


def poll(log: DataFrame, committed: DataFrame, group: str, max_records: int,
         offsets_per_slice: int = OFFSETS_PER_SLICE) -> DataFrame:
    """The next records of a group, at most `max_records` of each partition. Batch; on a stream, use
    `Trigger.AvailableNow` with `maxFilesPerTrigger`. Runs jobs.

    Records are numbered slice by slice along their offsets, so a hot partition is no single task's work."""
    rest = start_from(log, committed, group)
    slices = F.floor(F.col("offset") / offsets_per_slice)
    numbered = with_running(rest, LOG, [F.col("offset")], position="_n", slice_by=slices)
    return numbered.filter(F.col("_n") < max_records).drop("_n")


def settle(polled: DataFrame, outcome: Column, group: str, counted: bool = False) -> DataFrame:
    """Commits after a poll. `outcome` is accept, reject or requeue for each record: accepted and
    rejected records are done with, and the partition goes on at the first requeued one. `counted`
    adds `polled`, the number of records."""
    first_again = F.min(F.when(outcome == "requeue", F.col("offset")))
    committed = F.coalesce(first_again, F.max("offset") + 1).alias("committed")
    settled = polled.groupBy(*LOG).agg(committed, F.count(F.lit(1)).alias("polled"))
    return settled.select(F.lit(group).alias("group"), *LOG, "committed", *(["polled"] if counted else []))
