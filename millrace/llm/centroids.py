"""Centroid clustering (Lloyd's rounds) sharded by dimensions.

Vectors are cut into blocks of rows and every block into shards of its columns, each one row of a table that stays where
it is. In a round, each column block works out exact partial distances to its slice of the centroids; these matrices,
one for each block and shard, are added up by block, and the smallest sum assigns the vector. The assignments go back to
the shards, which add up the vectors of each cluster in their own columns and from these update their own slice.
What moves are distances (a number for each vector, centroid and shard) and assignments, never vectors. All numbers are
whole, so the result does not depend on the order of adding.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import batch_of, bucketed, quoted
from millrace.session import stored

BLOCK_ROWS, SHARDS = 4096, 4

# A component's size must stay below this, or squared distances could pass 64 bits.
MAX_COMPONENT = 1 << 17


def whole_components(embedding: Column, dims: int) -> Column:
    """floor(1024 * x) of each component, or null unless there are `dims`, none null, non-finite or too large."""
    fine = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= MAX_COMPONENT))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024).cast("bigint"))
    return F.when((F.size(embedding) == dims) & fine, whole)


def _slices(dims: int, shards: int) -> list[slice]:
    edges = np.linspace(0, dims, min(shards, dims) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _cut(batches: Iterator[pa.RecordBatch], parts: Sequence[slice], block_rows: int) -> Iterator[pa.RecordBatch]:
    """A row (block, shard, cells, ids) for each block and shard; one more, shard -1, has the ids."""
    names, block = ["block", "shard", "cells", "ids"], TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, batch.num_rows, block_rows):
            rows = batch.slice(at, block_rows)
            ids = rows.column("vec_id")
            cells = rows.column("cells").flatten().to_numpy().reshape(rows.num_rows, -1)
            binary = [None, *(np.ascontiguousarray(cells[:, p], "<i4").tobytes() for p in parts)]
            lists = pa.array([ids.to_pylist(), *[None] * len(parts)], pa.list_(ids.type))
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(binary), pa.int64()), pa.array(range(-1, len(parts)), pa.int32()),
                                              pa.array(binary, pa.binary()), lists], names=names)
            block += 1


def _partial_distances(batches: Iterator[pa.RecordBatch], centroids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Of each block and shard, the squared distances along its columns, a row for each centroid."""
    for batch in batches:
        for block, shard, cells in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "cells"))):
            mine = centroids[shard]
            x = np.frombuffer(cells, "<i4").reshape(-1, mine.shape[1]).astype(np.int64)
            found = np.stack([((x - c) ** 2).sum(axis=1) for c in mine])
            yield batch_of([("block", pa.int64()), ("distances", pa.binary())], [[block], [found.astype("<i8").tobytes()]])


def _nearest(group: pa.Table, k: int) -> pa.Table:
    """Adds the shards' distances of a block: the nearest centroid of each vector, the smaller number if equal."""
    total = sum(np.frombuffer(d, "<i8").reshape(k, -1) for d in group.column("distances").to_pylist())
    nearest = total.argmin(axis=0)
    return pa.table({"block": [group.column("block")[0].as_py()], "clusters": [nearest.astype("<i4").tobytes()],
                     "nearest": [total.min(axis=0).astype("<i8").tobytes()]},
                    schema=pa.schema([("block", pa.int64()), ("clusters", pa.binary()), ("nearest", pa.binary())]))


def _sums(batches: Iterator[pa.RecordBatch], k: int, widths: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Of the vectors of each cluster in this task, the sum of each component, and how many there are."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, cells, clusters in zip(*(batch.column(c).to_pylist() for c in ("shard", "cells", "clusters"))):
            x, at = np.frombuffer(cells, "<i4").reshape(-1, widths[shard]).astype(np.int64), np.frombuffer(clusters, "<i4")
            total = sums.setdefault(shard, np.zeros((k, widths[shard]), np.int64))
            for c in range(k):
                total[c] += x[at == c].sum(axis=0)
            counts[shard] = counts.get(shard, 0) + np.bincount(at, minlength=k)
    for shard, total in sums.items():
        w = widths[shard]
        yield batch_of([("shard", pa.int32()), ("cluster", pa.int32()), ("dim", pa.int32()), ("total", pa.int64()), ("members", pa.int64())],
                       [np.full(k * w, shard, np.int32), np.repeat(np.arange(k, dtype=np.int32), w), np.tile(np.arange(w, dtype=np.int32), k),
                        total.ravel(), np.repeat(counts[shard], w)])


def _updated(group: pa.Table, centroids: list[np.ndarray]) -> pa.Table:
    """The next slice of a shard: the floor of the mean of each cluster, and the old one of an empty cluster."""
    shard = group.column("shard")[0].as_py()
    new = centroids[shard].copy()
    c, d, total, members = (group.column(n).to_numpy() for n in ("cluster", "dim", "total", "members"))
    some = members > 0
    new[c[some], d[some]] = total[some] // members[some]
    return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([new.astype("<i8").tobytes()], pa.binary())})


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            clusters, nearest = (np.frombuffer(batch.column(c)[at].as_py(), t) for c, t in (("clusters", "<i4"), ("nearest", "<i8")))
            yield pa.RecordBatch.from_arrays([batch.column("ids")[at].values, pa.array(clusters, pa.int32()), pa.array(nearest, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, vec_id: str = "vec_id", embedding: str = "embedding",
    seed: str = "3", shards: int = SHARDS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid (whole numbers) of each vector kept.
    Batch; runs a job for each round.

    Kept are rows with exactly `dims` components, none null, non-finite or of size 2^17 and more; x counts as
    floor(1024 x). Centroids start as the k kept vectors with the smallest sha256 of "seed:vec_id" (null: "null"), rows
    that share an id by their components; fewer rows give fewer centroids. Each round assigns every vector to the
    nearest centroid, equal distances to the smaller number, and replaces every centroid that has vectors by the floor
    of their mean; then vectors are assigned once more. Rows that repeat an id are vectors of their own. Inertia is null
    where it passes 64 bits. Other columns are left out; an empty table gives no rows. The driver holds the centroids,
    k times `dims` numbers."""
    spark = vectors.sparkSession
    kept = stored(vectors.select(quoted(vec_id).alias("vec_id"), whole_components(quoted(embedding), dims).alias("cells")).where("cells is not null"), "whole-vectors")
    first = kept.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256))
    start = np.array([r["cells"] for r in first.orderBy("hash", "cells").limit(k).collect()], np.int64).reshape(-1, dims)
    k, parts = len(start), _slices(dims, shards)
    widths, kind = [p.stop - p.start for p in parts], kept.schema["vec_id"].dataType
    out = T.StructType([T.StructField("vec_id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not k:
        members = spark.createDataFrame([], out)
        return members.select("*", *(F.lit(None).cast("bigint").alias(n) for n in ("cluster_inertia", "inertia")), F.lit(None).cast("array<bigint>").alias("centroid"))

    schema = T.StructType.fromDDL("block bigint, shard int, cells binary").add("ids", T.ArrayType(kind))
    table = bucketed(kept.mapInArrow(partial(_cut, parts=parts, block_rows=block_rows), schema),
                     "vector-shards", int(spark.conf.get("spark.sql.shuffle.partitions")), "block", "shard")
    cells = table.where("shard >= 0").select("block", "shard", "cells")
    slices = [start[:, p] for p in parts]

    def nearest(group: pa.Table) -> pa.Table:
        return _nearest(group, k)

    def update(group: pa.Table) -> pa.Table:
        return _updated(group, slices)

    def assigned() -> DataFrame:
        distances = cells.mapInArrow(partial(_partial_distances, centroids=slices), "block bigint, distances binary")
        return distances.groupBy("block").applyInArrow(nearest, "block bigint, clusters binary, nearest binary")

    for _ in range(rounds):
        back = assigned().select("block", F.explode(F.lit(list(range(len(parts))))).alias("shard"), "clusters")
        sums = cells.join(back, ["block", "shard"]).select("shard", "cells", "clusters").mapInArrow(
            partial(_sums, k=k, widths=widths), "shard int, cluster int, dim int, total bigint, members bigint")
        sums = sums.groupBy("shard", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
        # One row for each shard.
        new = sums.groupBy("shard").applyInArrow(update, "shard int, cells binary").collect()
        slices = [np.frombuffer(r["cells"], "<i8").reshape(k, -1) for r in sorted(new)]

    ids = table.where("shard = -1").select("block", "ids")
    members = stored(assigned().join(ids, "block").select("ids", "clusters", "nearest").mapInArrow(_members, out), "clustered")
    sums = members.groupBy("cluster").agg(F.try_sum("distance").alias("inertia"))
    # One row for each cluster.
    inertia = {r["cluster"]: r["inertia"] for r in sums.collect()}
    total = None if None in inertia.values() else sum(inertia.values())
    total = total if total is not None and total < 1 << 63 else None
    known = [(c, inertia[c], row.tolist()) for c, row in enumerate(np.concatenate(slices, axis=1)) if c in inertia]
    known = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, centroid array<bigint>")
    # k rows.
    return members.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("bigint").alias("inertia"), "centroid")
