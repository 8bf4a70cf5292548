"""Near-duplicate vectors by a PCA-ordered tiled comparison.

Vectors are turned so that their leading coordinates hold most of their length (PCA), and ordered by the first one.
Blocks of consecutive vectors are compared pair by pair, tile against tile: the products of the leading coordinates
come first, and the norms of what is left bound the rest, so a pair whose bound stays below the threshold is dropped
without looking further. Blocks that lie too far apart along the first coordinate are not compared at all. What stays
is checked with the whole vectors in double precision.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, running_total
from millrace.llm.components import components
from millrace.session import stored

# Vectors of one block and of one tile; a task holds two blocks.
BLOCK_ROWS, TILE_ROWS = 8192, 1024

# Leading coordinates that are multiplied before the first bound, and rounding allowed for in bounds.
LEAD, SLACK = 16, 1e-5


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each number of dimensions, the axes of its unit vectors (columns) from the longest to the shortest: from the
    second moments over all rows, added up in the tasks and then by Spark."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                unit = _unit(_matrix(part.column("vector"), part.num_rows))
                sums[d] = sums.get(d, 0) + unit.T @ unit
        for d, total in sums.items():
            yield batch_of([("dims", pa.int32()), ("at", pa.int64()), ("value", pa.float64())],
                           [np.full(d * d, d, np.int32), np.arange(d * d), total.ravel()])

    parts = classes.select("dims", "vector").mapInArrow(moments, "dims int, at bigint, value double")
    found: dict[int, np.ndarray] = {}
    # Dimensions squared, whatever the number of rows.
    for r in parts.groupBy("dims", "at").agg(F.sum("value").alias("value")).collect():
        found.setdefault(r["dims"], np.zeros(r["dims"] ** 2))[r["at"]] = r["value"]
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1].copy() for d, m in found.items()}


def _local_roots(rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each row reaches through the links a-b."""
    root = np.arange(rows)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != (jumped := new[new])).any():
            new = jumped
        if (new == root).all():
            return root
        root = new


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, lead: int = LEAD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of x, row of y) of unit vectors with cosine at least `threshold`, tile by tile."""
    lead = min(lead, x.shape[1])

    def bounded(u: np.ndarray) -> np.ndarray:
        turned = u @ axes
        rest = np.sqrt((turned[:, lead:] ** 2).sum(axis=1, keepdims=True))
        # The last column makes the product of two rows the greatest cosine they can still reach.
        return np.hstack([turned[:, :lead], rest]).astype(np.float32)

    left, right = bounded(x), bounded(y)
    for i in range(0, len(x), TILE_ROWS):
        for j in range(0, len(y), TILE_ROWS):
            a, b = np.nonzero(left[i : i + TILE_ROWS] @ right[j : j + TILE_ROWS].T >= threshold - SLACK)
            if len(a) > TILE_ROWS * 64:  # a dense tile is cheaper to multiply out
                a, b = np.nonzero(x[i : i + TILE_ROWS] @ y[j : j + TILE_ROWS].T >= threshold - SLACK)
            for at in range(0, len(a), 1 << 16):
                p, q = a[at : at + (1 << 16)] + i, b[at : at + (1 << 16)] + j
                near = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
                if near.any():
                    yield p[near], q[near]


def partner_spans(edges: Sequence[tuple[int, int, float, float]], reach: float) -> list[tuple[int, int, int]]:
    """block, and the first and last block it is compared with, out of (dims, block, low, high): where a block's
    vectors of these dimensions begin and end along the first axis.

    Blocks follow the dimensions first and the axis next, so a block shares only its greatest dimensions with later
    ones, and those of them that begin within `reach` of its end are consecutive. The last partner never falls from
    block to block, so the earlier partners of a block are consecutive too."""
    edges = sorted(edges)
    dims = {d: [e for e in edges if e[0] == d] for d in {e[0] for e in edges}}
    greatest = {block: (d, high) for d, block, _, high in edges}
    last = []
    for block in sorted(greatest):
        d, high = greatest[block]
        n = bisect_right(dims[d], high + reach, key=lambda e: e[2])
        last.append((block, max(block, dims[d][n - 1][1])))
    spans, first = [], 0
    for block, most in last:
        while last[first][1] < block:
            first += 1
        spans.append((block, last[first][0], most))
    return spans


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of `vectors`. Batch; runs jobs.

    Rows link whose cosine is at least `threshold` (positive); n_links counts the other rows linked directly,
    component_id is the smallest vec_id reachable, kept is whether it is the row's own. Vectors that are null, empty,
    zero or hold a null or non-finite component link with nothing; vectors of different lengths do not link. Equal
    vectors are compared once and counted as often as they occur, repeated rows included. A null vec_id is no smallest
    id unless all are null. Other columns are left out; an empty table gives no rows."""
    spark = vectors.sparkSession
    e = F.col(embedding)
    fine = F.size(e) > 0
    fine &= ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = F.coalesce(fine & F.exists(e, lambda v: v != 0), F.lit(False))
    # Two hashes stand for the content of a vector; adding 0.0 makes a negative zero a plain one.
    whole = F.transform(e, lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(fine, whole).alias("vector"))
    rows = rows.withColumns({"h1": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")),
                             "h2": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector"))})
    rows = stored(rows, "vectors")
    classes = rows.where("vector is not null").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("dims", F.size("vector")), "vector-classes")
    axes = principal_axes(classes)

    def first_axis(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, first = batch.column("dims").to_numpy(), np.zeros(batch.num_rows)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                part = batch.take(pa.array(at))
                first[at] = _unit(_matrix(part.column("vector"), len(at))) @ axes[d][:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=[*batch.schema.names, "along"])

    names = "h1 bigint, h2 bigint, copies bigint, first_id bigint, vector array<double>, dims int"
    along = classes.select("h1", "h2", "copies", F.col("first_id").cast("bigint"), "vector", "dims").mapInArrow(
        first_axis, f"{names}, along double")
    ordered = running_total(along, ["dims", "along", "h1", "h2"], name="class")
    ordered = stored(ordered.withColumn("block", F.floor(F.col("class") / block_rows).cast("int")), "ordered-vectors")

    # Unit vectors with this cosine are no farther apart than this, along any axis.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    edges = ordered.groupBy("dims", "block").agg(F.min("along").alias("low"), F.max("along").alias("high"))
    # One row for each block of `block_rows` vectors, and one more wherever the dimensions change inside a block.
    spans = partner_spans([tuple(r) for r in edges.collect()], reach)
    spans = spark.createDataFrame(spans, "block int, least int, most int")
    dealt = ordered.join(spans, "block").withColumn("partner", F.explode(F.sequence("least", "most")))
    dealt = dealt.select(F.least("block", "partner").alias("first"), F.greatest("block", "partner").alias("second"),
                         "block", "class", "copies", "dims", "vector")

    def compare(group: pa.Table) -> pa.Table:
        first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
        block, dims = group.column("block").to_numpy(), group.column("dims").to_numpy()
        ids, copies = group.column("class").to_numpy(), group.column("copies").to_numpy()
        links = np.zeros(len(ids), np.int64)
        left, right = [], []
        for d in np.unique(dims).tolist():
            one, two = np.flatnonzero((block == first) & (dims == d)), np.flatnonzero((block == second) & (dims == d))
            if not len(one) or not len(two):
                continue
            x = _unit(_matrix(group.column("vector").take(pa.array(one)), len(one)))
            y = x if first == second else _unit(_matrix(group.column("vector").take(pa.array(two)), len(two)))
            forest = np.arange(len(ids))
            for p, q in tile_links(x, y, axes[d], threshold):
                p, q = one[p], two[q]
                if first == second:
                    p, q = p[ids[p] < ids[q]], q[ids[p] < ids[q]]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                # Only links that join two trees are kept: fewer than there are rows.
                new = forest[p] != forest[q]
                if new.any():
                    left.append(forest[p[new]])
                    right.append(forest[q[new]])
                    forest = _local_roots(len(ids), np.concatenate(left), np.concatenate(right))
                    at = np.flatnonzero(forest != np.arange(len(ids)))
                    left, right = [at], [forest[at]]
        found = np.flatnonzero(links)
        root = _local_roots(len(ids), np.concatenate(left), np.concatenate(right)) if left else np.arange(len(ids))
        return pa.table({"class": ids[found], "links": links[found], "root": ids[root[found]]})

    found = stored(dealt.groupBy("first", "second").applyInArrow(compare, "class bigint, links bigint, root bigint"), "tile-links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    labelled = ordered.select("class", "h1", "h2", "copies", "first_id").join(counts, "class", "left")
    labelled = labelled.join(joined.withColumnRenamed("node", "class"), "class", "left")
    labelled = stored(labelled.withColumn("root", F.coalesce("root", "class")), "labelled-classes")
    least = stored(labelled.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    by_class = stored(labelled.join(least, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "by-class")
    out = rows.select("vec_id", "h1", "h2").join(by_class, ["h1", "h2"], "left")
    out = out.withColumn("component_id", F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
