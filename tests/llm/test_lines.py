"""Dropping of repeated lines against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import lines, queries
from tests.llm.test_operators import DOC, MIDDLE, ODD

WHITE = " \t\n\x0b\x0c\r"


def slow_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def slow_drop(rows, min_chars=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, kept_text) of rows (doc_id, text); null ids are one document, the smallest."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(slow_key(line)) >= min_chars:
                holders[slow_key(line)].add((i is not None, i))
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        gone = [len(holders[slow_key(x)]) >= min_docs and max(holders[slow_key(x)]) != (i is not None, i)
                if len(slow_key(x)) >= min_chars else False for x in all_lines]
        left = None if text is None else "\n".join(x for x, g in zip(all_lines, gone) if not g)
        out.append((i, len(all_lines), sum(gone), left))
    return Counter(out)


def got_of(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect())


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_by_hand(spark, batches):
    rng = random.Random(4)
    shared = [f"Shared line number {i} é   of the lot" for i in range(12)] + ["short", "", " \t", "x" * 19, "y" * 20]
    rows = []
    for i in range(120):
        parts = [rng.choice(shared) for _ in range(rng.randrange(1, 9))] + [f"a line that only document {i} has"] * rng.randrange(2)
        parts = [rng.choice(["", " ", "\t\x0b", "\r"]) + (p.upper() if rng.random() < 0.2 and p.isascii() else p) + rng.choice(["", "\r", " \x0c"]) for p in parts]
        rng.shuffle(parts)
        rows.append((None if i % 40 == 7 else i % 100, "\n".join(parts)))
    rows += [rows[3], (7000, None), (7001, ""), (7002, "\n\n"), (None, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got_of(lines.drop_repeated_lines(docs, batches=batches)) == slow_drop(rows)
    assert got_of(lines.drop_repeated_lines(docs, batches=batches, min_chars=5, min_docs=2)) == slow_drop(rows, 5, 2)


def test_lines_of_the_table(spark):
    docs = queries.table(spark, MIDDLE, "documents").select("doc_id", "text")
    expected = slow_drop([tuple(r) for r in docs.collect()])
    assert got_of(lines.drop_repeated_lines(docs)) == expected
    assert sum(k[2] * n for k, n in expected.items()) > 100


def test_lines_odd_rows(spark):
    odd = spark.createDataFrame(ODD, DOC)
    names = ["h1", "H2", "pos", "batch", "keeper", "docs", "Lines_Gone", "lines_id", "LINES_TEXT", "N_lines", "key", "line", "text_hash", "a.b"]
    clash = odd.withColumns({n: F.lit(777) for n in names})
    got = lines.drop_repeated_lines(clash)
    assert got_of(got) == slow_drop([(r[0], r[1]) for r in ODD])
    assert got.columns == [*DOC.replace(" bigint", "").replace(" string", "").split(", "), *[n for n in names if n != "N_lines"], "n_lines", "n_dropped", "kept_text"]
    assert {r["Lines_Gone"] for r in got.collect()} == {777}
    assert lines.drop_repeated_lines(spark.createDataFrame([], DOC)).collect() == []
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert got_of(lines.drop_repeated_lines(named)) == slow_drop([(None if r[0] is None else f"d{r[0]}", r[1]) for r in ODD])


def test_runs_merge_by_levels_and_settled_lines_are_not_added_again(spark):
    docs = spark.createDataFrame([(i, "a line that stands everywhere\n" + f"but this one only in document {i}") for i in range(40)],
                                 "doc_id bigint, text string")
    hashes = lines.line_hashes(docs)
    runs = lines.LineRuns(spark)
    for n, first in enumerate([32, 24, 16, 8, 0], 1):
        runs.add(hashes.where(F.col("doc_id").between(first, first + 7)))
        assert [run is not None for run in runs.levels] == [bool(n >> level & 1) for level in range(len(runs.levels))]
    assert runs.levels[2].agg(F.max("docs")).first()[0] == 8 and runs.levels[0].count() == 8
    assert [r["keeper"] for r in runs.repeated().collect()] == [39]
    upwards = lines.LineRuns(spark)
    for first in (0, 8, 16, 24, 32):
        upwards.add(hashes.where(F.col("doc_id").between(first, first + 7)))
    assert [r["keeper"] for r in upwards.repeated().collect()] == [39]


def test_runs_are_not_moved(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = lines.bucketed(spark.range(99).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).alias("docs"), F.col("id").alias("keeper")), "t", 8, "h1", "h2")
        plan = lines.merged(run, run)._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" in plan and "Exchange" not in plan and lines.merged(run, run).count() == 99
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
