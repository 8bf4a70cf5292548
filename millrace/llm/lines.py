"""Dropping lines that many documents share, with levelled sorted runs of line hashes.

A line is known by two hashes of its key. What has been seen is kept in runs: tables of (hashes, number of documents,
greatest document id), cut into buckets by hash and sorted inside them. Every batch of documents counts its own lines,
takes away by a merge anti-join with each run the lines that the run has settled already, and adds the rest as a run of
its own at level 0; whenever a level holds two runs, a full merge join makes them one of the next level. All runs have
the same buckets, so neither anti-joins nor merges move a run. Batches come from the greatest ids downwards, so a line
that reached its number of documents is settled: no later document can become the one that keeps it, and lines of
millions of documents are added a few times only.

Everything here is made of Spark's own functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import LOWER, UPPER, bucketed, quoted, stored_by, unused, without
from millrace.session import stored

# ASCII white space.
WHITE = " \t\n\x0b\x0c\r"

MIN_CHARS, MIN_DOCS = 20, 3

# Batches that one table is taken in.
BATCHES = 4

HASHES = ("h1", "h2")


def line_key(line: Column) -> Column:
    """What makes lines equal: the line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, pos (from 0), h1 and h2 of every line whose key has at least `min_chars` code points."""
    body = F.coalesce(quoted(text), F.lit(""))
    lines = docs.select(quoted(doc_id).alias("doc_id"), F.xxhash64(body).alias("text_hash"),
                        F.posexplode(F.split(body, "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Runs of the lines seen so far. A document belongs to one batch; rows that share an id are one document.

    Right for batches in any order, and least work with the greatest ids first. The driver holds the list of runs, one
    for each level at most: the level n run stands for 2 ** n batches."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, buckets: int | None = None):
        self.min_docs = min_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[DataFrame | None] = []

    def add(self, hashes: DataFrame) -> None:
        """Add a batch of `line_hashes`. Batch; runs jobs."""
        # Rows of one line are counted in the tasks before they meet; a document counts once.
        once = hashes.select(*HASHES, "doc_id").distinct()
        own = once.groupBy(*HASHES).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
        for run in self._runs():
            settled = run.where(F.col("docs") >= self.min_docs).select(*(F.col(h).alias(f"_{h}") for h in HASHES), F.col("keeper").alias("_keeper"))
            same = [F.col(h) == F.col(f"_{h}") for h in HASHES]
            own = own.join(settled, reduce(Column.__and__, [*same, F.col("_keeper") >= F.col("keeper")]), "left_anti")
        new, level = self._write(own, 0), 0
        while level < len(self.levels) and self.levels[level] is not None:
            new, self.levels[level] = self._write(merged(self.levels[level], new), level + 1), None
            level += 1
        self.levels[level:level + 1] = [new]

    def _runs(self) -> list[DataFrame]:
        return [run for run in self.levels if run is not None]

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        return bucketed(rows, f"line-run-{level}", self.buckets, *HASHES)

    def repeated(self) -> DataFrame | None:
        """h1, h2 and keeper (the greatest id that has it) of every line in at least `min_docs` documents of all that
        was added; None before the first batch."""
        if not self._runs():
            return None
        return reduce(merged, self._runs()).where(F.col("docs") >= self.min_docs).select(*HASHES, "keeper")


def merged(one: DataFrame, two: DataFrame) -> DataFrame:
    """Two runs as one: the documents of a line summed up, the greater of its keepers. (A union of tables with the same
    buckets, grouped without an exchange, gives wrong groups in Spark 4.1, so the runs are joined.)"""
    both = one.alias("one").join(two.alias("two"), list(HASHES), "full_outer")
    docs = F.coalesce("one.docs", F.lit(0)) + F.coalesce("two.docs", F.lit(0))
    return both.select(*HASHES, docs.alias("docs"), F.greatest("one.keeper", "two.keeper").alias("keeper"))


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Number of a document's batch, by its column doc_id. Numbered documents go by ranges of the id, the greatest first and null last;
    others by a hash of it. Where the ranges are cut changes the work only, not the result."""
    if not isinstance(docs.schema["doc_id"].dataType, T.NumericType):
        return F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    shares = [(batches - n) / batches for n in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares).alias("cuts")).first()["cuts"] or []
    below = [F.coalesce(F.col("doc_id") < F.lit(cut), F.lit(True)).cast("int") for cut in cuts]
    return reduce(Column.__add__, below, F.lit(0))


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """Add n_lines, n_dropped and kept_text to `docs`: lines whose key of at least `min_chars` code points stands in at
    least `min_docs` documents go from all of them but the one with the greatest id. Batch; runs jobs.

    Whole texts of any length are split at \\n. A null or empty text is one empty line; kept_text of null is null, and
    a text that loses all its lines becomes empty. Lines of one document that are equal go or stay together. Rows that
    share an id, null included, are one document, and null is the smallest id; rows that repeat id and text are treated
    alike. Other columns stay as they are; those of the added names, in upper or lower case, are replaced. An empty
    table gives no rows."""
    spark, kept = docs.sparkSession, without(docs, "n_lines", "n_dropped", "kept_text")
    batch = _batch_of(docs.select(quoted(doc_id).alias("doc_id")), batches)
    parts = stored_by(line_hashes(docs, doc_id, text, min_chars).withColumn("batch", batch), "line-hashes", "batch")
    runs = LineRuns(spark, min_docs)
    for n in range(batches):
        runs.add(parts.where(F.col("batch") == n))
    repeated = stored(runs.repeated(), "repeated-lines")

    # Lines of a hot key meet their verdict in a join of two stored tables, which adaptive execution splits.
    gone = parts.join(repeated, list(HASHES)).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    mine, ident, content = unused(docs.columns, "lines_gone", "lines_id", "lines_text")
    gone = stored(gone.groupBy(F.col("doc_id").alias(ident), F.col("text_hash").alias(content)).agg(
        F.collect_set("pos").alias(mine)), "lines-gone")
    body = F.coalesce(quoted(text), F.lit(""))
    met = docs.join(gone, quoted(doc_id).eqNullSafe(F.col(ident)) & (F.xxhash64(body) == F.col(content)), "left")
    places = F.array_except(F.sequence(F.lit(0), F.regexp_count(body, F.lit("\n"))), F.col(mine))
    # The outer function names the split text, so that it is not split again for every line.
    left = F.transform(F.array(F.split(body, "\n", -1)), lambda lines: F.transform(places, lambda p: F.get(lines, p)))
    return met.select(
        *map(quoted, kept), (F.regexp_count(body, F.lit("\n")) + 1).cast("bigint").alias("n_lines"),
        F.when(F.col(mine).isNull(), 0).otherwise(F.size(mine)).cast("bigint").alias("n_dropped"),
        F.when(F.col(mine).isNull(), quoted(text)).otherwise(F.array_join(F.get(left, F.lit(0)), "\n")).alias("kept_text"))
