"""Uniform shuffling into shards of exact sizes, by a hypergeometric communication matrix.

A uniform permutation sends a random number of a partition's rows to each shard; those numbers follow a multivariate
hypergeometric distribution. They are drawn first, exactly, for all partitions. Each partition then permutes its rows
locally and cuts the permutation at the drawn counts, the rows are exchanged, and each shard is permuted again. Every
order of all rows is equally likely and every shard has its exact size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import quoted, running_total, with_fields, without
from millrace.session import stored


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart; the first shards have the larger ones."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(counts: Sequence[int], sizes: Sequence[int], seed: int) -> np.ndarray:
    """How many rows each partition (row) sends to each shard (column): row sums are `counts`, column sums `sizes`.

    Drawn in two exact steps that work for any number of rows: each row first picks a shard on its own (a multinomial
    for each partition); then every shard that got too many gives away a uniform choice of its rows, which fill the
    others in random order. Rows are exchangeable throughout and any assignment with these sizes is a rearrangement
    of any other, so all are equally likely, and the counts are multivariate hypergeometric."""
    rng, counts, sizes = np.random.default_rng(seed), np.asarray(counts, np.int64), np.asarray(sizes, np.int64)
    if not counts.sum():
        return np.zeros((len(counts), len(sizes)), np.int64)
    matrix = rng.multinomial(counts, sizes / sizes.sum())
    excess = matrix.sum(axis=0) - sizes
    given = []
    for s in np.flatnonzero(excess > 0):
        upto = np.cumsum(matrix[:, s])
        chosen = rng.choice(int(upto[-1]), int(excess[s]), replace=False)
        givers = np.searchsorted(upto, chosen, side="right")
        np.subtract.at(matrix[:, s], givers, 1)
        given.append(givers)
    if given:
        takers = np.repeat(np.arange(len(sizes)), np.maximum(-excess, 0))
        np.add.at(matrix, (rng.permutation(np.concatenate(given)), takers), 1)
    return matrix


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (its place there, gapless from 0). Batch; runs jobs.

    All columns travel, so select what the shards need first. Shard sizes are at most one apart. Nulls and repeated
    rows are rows like others; an empty table stays empty; input columns named shard or slot, in upper or lower case, are
    replaced, others stay as they are. The same
    stored input in the same partitions gives the same result; `partitions` asks for a number of partitions first.
    The driver holds one row of `shards` numbers for each input partition."""
    spark, own = rows.sparkSession, without(rows, "shard", "slot")
    # All columns travel in one struct, which cannot be empty.
    plain = rows.select(F.struct(F.lit(0).alias("_"), *map(quoted, own)).alias("row"))
    if partitions:
        plain = plain.repartition(partitions)
    schema = with_fields(plain.schema, "_source int, _row bigint")
    names = schema.names

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [*batch.columns, pa.array(np.full(n, source, np.int32)), pa.array(np.arange(seen, seen + n))]
            seen += n
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # The place of each row in its partition is written down once; everything after follows from it.
    placed = stored(plain.mapInArrow(place, schema), "placed")
    counts = sorted((r["_source"], r["count"]) for r in placed.groupBy("_source").count().collect())
    sizes = shard_sizes(sum(n for _, n in counts), shards)
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    cuts = spark.createDataFrame(
        [(source, n, np.cumsum(row).tolist()) for (source, n), row in zip(counts, matrix)],
        "_source int, _n bigint, _cuts array<bigint>")

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, orders, shard_of, keys = None, None, None, None
        for batch in batches:
            sources, places = (batch.column(c).to_numpy() for c in ("_source", "_row"))
            starts = np.flatnonzero(np.diff(sources, prepend=sources[:1] - 1))
            for lo, hi in zip(starts, [*starts[1:], len(sources)]):
                if at != int(sources[lo]):
                    at = int(sources[lo])
                    rng = np.random.default_rng([seed, 1, at])
                    orders = rng.permutation(batch.column("_n")[lo].as_py())
                    keys = rng.integers(1 << 62, size=len(orders))
                    shard_of = np.array(batch.column("_cuts")[lo].as_py())
                mine = orders[places[lo:hi]]
                shard = np.searchsorted(shard_of, mine, side="right").astype(np.int32)
                rest = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [rest.column("row"), rest.column("_source"), rest.column("_row"),
                     pa.array(shard), pa.array(keys[places[lo:hi]])],
                    names=["row", "_source", "_row", "shard", "_order"])

    out = with_fields(plain.schema, "_source int, _row bigint, shard int, _order bigint")
    dealt = placed.join(cuts, "_source").mapInArrow(permute, out)
    # Independent random keys put each shard in uniform order; source and row settle ties.
    slots = running_total(dealt, ["shard", "_order", "_source", "_row"], name="_place")
    bases = np.cumsum([0, *sizes[:-1]]).tolist()
    base = F.element_at(F.lit(bases), F.col("shard") + 1)
    return slots.select(*[F.col("row").getField(c).alias(c) for c in own], "shard", (F.col("_place") - base).alias("slot"))
