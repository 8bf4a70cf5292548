"""Stages of the pipeline against brute force, each on what the stage before it kept."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import language, mixing, queries
from millrace.llm.common import BATCH_BYTES, bounded_batches, running_total, word_count
from millrace.session import stored
from tests.conftest import SMALL
from tests.llm.test_operators import DOC, ODD, check_packing, slow_cut, slow_ids, words
from tests.llm.test_similar import jaccard, slow_shingles


@pytest.fixture(scope="module")
def kept(spark):
    """Input and results of the stages on the small table with odd rows added."""
    docs = queries.table(spark, SMALL, "documents")
    lengths = docs.withColumn("doc_id", F.col("doc_id") + 1000).where("doc_id % 9 = 0")
    odd = spark.createDataFrame([(None if r[0] is None else r[0] + 5000, *r[1:]) for r in ODD], DOC)
    frames = [stored(docs.unionByName(lengths).unionByName(odd), "input")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SMALL), name))
    return frames


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_the_stages_are_registered(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near-duplicates", "passages", "mixture", "packing"]
    assert "pipeline" in entry.queries() and set(queries.SQL) <= set(entry.oracle_sql())
    assert {n for n in entry.queries() if n.startswith("op")} == set(queries.QUERIES)


def test_columns_stay(kept):
    assert all(f.columns == kept[0].columns for f in kept[:-1])
    assert all(f.dtypes == kept[0].dtypes for f in kept[:-1])


def test_language_stage(kept):
    known = language.learn(kept[0].where(~language.held_out(F.col("doc_id"))))
    judge = language.Classifier(known)
    clear = [r for r in rows_of(kept[0]) for lang, score in [judge.classify(r[1])]
             if lang != "und" and score >= language.MIN_MARGIN]
    assert Counter(rows_of(kept[1])) == Counter(clear)
    assert len(clear) > 0.95 * sum(any(c.isalpha() for c in r[1] or "") for r in rows_of(kept[0]))


def test_near_duplicate_stage(kept):
    before, after = rows_of(kept[1]), rows_of(kept[2])
    # Rows without id come last; equal rows are one.
    ids = {r: (r[0] is None, r[0] or 0) for r in before}
    sets = {ids[r]: slow_shingles(r[1]) for r in before}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, a in enumerate(sorted(sets)):
        for b in sorted(sets)[n + 1 :]:
            if jaccard(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    # So few pairs are all found here; in general some at the very similarity are not.
    assert sorted(ids[r] for r in after) == sorted({find(i) for i in sets})
    assert set(after) <= set(before) and len(after) < len(set(before))


def test_passage_stage(kept):
    before = rows_of(kept[2])
    expected = slow_cut(sorted(((10**9 if r[0] is None else r[0]), r[1]) for r in before))
    got = rows_of(kept[3])
    assert len(got) == len(before)
    for text, (order, old) in zip([r[1] for r in sorted(got, key=lambda r: (r[0] is None, r[0] or 0))], sorted(expected)):
        assert words(text) == expected[order, old][2]
    assert all(r[4] == len(r[1]) for r in got)
    assert sum(v[1] for v in expected.values()) > 0


def test_mixture_stage(kept):
    mixed = mixing.mix(kept[3], word_count(F.col("text")), seed=queries.MIX_SEED)
    expected = Counter()
    for r in mixed.collect():
        expected[r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]] += r["repeats"]
    assert Counter(rows_of(kept[4])) == +expected


def test_packing_stage(kept):
    ids = slow_ids([r[1] for r in rows_of(kept[4])])
    n = check_packing(kept[5].collect(), ids, 2048)
    assert n <= -(-sum(map(len, ids)) // 2048) * 1.02 + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "stage")
        assert docs.isEmpty()


def test_stages_give_user_columns_back(spark, kept):
    names = ["score", "text_hash", "n_words", "Size", "kept_text", "lang_pred", "Rejected", "component_id", "kept", "target", "repeats", "copy", "Key", "_content", "whole_row",
             "Whole", "cut", "_source", "source_size", "h1", "node", "_order", "_places", "n_removed", "a b", "dotted.name", "_copy", "id_or_0", "no_id", "same_text"]
    docs = kept[0].withColumns({n: F.lit(777) for n in names})
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == [*kept[0].columns, *names], name
        assert docs.dtypes[5:] == [(c, "int") for c in names] and {tuple(r)[5:] for r in docs.collect()} == {(777,) * len(names)}, name
        assert Counter(rows_of(docs)) == Counter(rows_of(kept[n + 1])), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == kept[5].count()


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 100


BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batches(spark):
    """The session's bound of Arrow batches as before, and again afterwards."""
    before = spark.conf.get(BATCHES)
    spark.conf.unset(BATCHES)
    yield
    spark.conf.set(BATCHES, before)


@pytest.mark.parametrize("name", ["language", "near-duplicates", "passages", "packing"])
def test_stages_hand_few_bytes_at_once_to_python(spark, batches, name):
    def sizes(rows):
        for b in rows:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "bytes"])

    dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame([], DOC), SMALL)
    # Texts of 100,000 bytes, and one beyond the bound.
    texts = spark.range(0, 100, 1, 1).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 50, 2 * BATCH_BYTES).otherwise(100_000).cast("int")).alias("text"))
    seen = texts.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r["n"] for r in seen) == 100 and len(seen) >= 3
    assert all(r["bytes"] <= BATCH_BYTES + 200_000 for r in seen if r["n"] > 1 and r["bytes"] < 2 * BATCH_BYTES)
    assert max(r["bytes"] for r in seen) <= 3 * BATCH_BYTES + 200_000


def test_smaller_batches_stay(spark, batches):
    spark.conf.set(BATCHES, "1m")
    bounded_batches(spark)
    assert spark.conf.get(BATCHES) == "1m"
    spark.conf.set(BATCHES, "64m")
    bounded_batches(spark)
    assert int(spark.conf.get(BATCHES)) == BATCH_BYTES


def test_bases_of_ranges_start_no_python_workers(spark):
    rows = running_total(spark.range(50).withColumn("w", F.col("id") % 3), ["id"], "w", tasks=5)
    assert [r["before"] for r in rows.orderBy("id").collect()] == [sum(i % 3 for i in range(n)) for n in range(50)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" in plan
    none = running_total(spark.range(0), ["id"])
    assert none.columns == ["id", "before"] and none.isEmpty()
