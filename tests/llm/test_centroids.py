"""Centroid clustering against brute force."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids, queries
from tests.conftest import SMALL


def slow_cluster(rows, k=8, rounds=10, dims=64):
    """Counter of (vec_id, cluster, distance, cluster inertia, inertia, centroid) of rows (vec_id, components)."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < 2**17 for x in v)]
    at = sorted((hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    now = [v for _, v in at[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        places = assign()
        for n in range(len(now)):
            mine = [v for (_, v), (_, c) in zip(kept, places) if c == n]
            if mine:
                now[n] = [sum(column) // len(mine) for column in zip(*mine)]
    places = assign()
    inertia = Counter()
    for d, c in places:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], inertia.total(), tuple(now[c])) for (i, _), (d, c) in zip(kept, places))


def got_of(df):
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in df.collect())


def odd_rows():
    rng = random.Random(9)
    rows = [(i, [rng.gauss(i % 5, 0.7) for _ in range(12)]) for i in range(150)]
    return rows + [rows[3], (3, rows[4][1]), (None, rows[5][1]), (None, rows[6][1]), (200, None), (201, []), (202, rows[7][1][:11]), (203, rows[7][1] + [1.0]),
                   (204, [None] + rows[8][1][1:]), (205, [math.nan] + rows[8][1][1:]), (206, [-math.inf] + rows[8][1][1:]), (207, [1e300] * 12),
                   (208, [131071.9] * 12), (209, [131072.0] * 12), (210, [0.0] * 12), (211, [-0.0] * 12)]


@pytest.mark.parametrize("shards, block_rows", [(4, 4096), (5, 7)])
def test_clusters_by_hand(spark, shards, block_rows):
    rows = odd_rows()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = got_of(centroids.cluster(table, k=6, rounds=4, dims=12, shards=shards, block_rows=block_rows))
    assert got == slow_cluster(rows, 6, 4, 12) and got.total() == 157


def test_clusters_of_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SMALL, "embeddings").select("vec_id", "embedding").collect()]
    assert got_of(centroids.cluster(queries.table(spark, SMALL, "embeddings"))) == slow_cluster(rows)


def test_equal_vectors_and_few_rows(spark):
    rows = [(i, [1.0, -1.0]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    clash = table.withColumns({n: F.lit("clash") for n in ["cluster", "Distance", "cells", "hash", "block", "INERTIA"]})
    got = got_of(centroids.cluster(clash, k=8, rounds=2, dims=2))
    assert got == slow_cluster(rows, 8, 2, 2) and {c for _, c, *_ in got} == {0}
    few = table.limit(3)
    assert got_of(centroids.cluster(few, k=8, rounds=1, dims=2)) == slow_cluster([tuple(r) for r in few.collect()], 8, 1, 2)
    assert centroids.cluster(table.limit(0), dims=2).collect() == []
    assert centroids.cluster(table, dims=3).collect() == []
