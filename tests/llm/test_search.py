"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, search
from tests.conftest import SMALL
from tests.llm.test_operators import DOC, ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_search(docs, items, k=10):
    """Counter of (item_id, rank, doc_id, score); rows are (id, text)."""
    counts = [Counter(slow_terms(t)) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for (i, _), c in zip(docs, counts):
            score = 0
            for t in slow_terms(text):
                if c[t]:
                    m = 25 + 75 * c.total() * n_docs // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if none else i, -score] += 1
    return out


def got_of(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("k, together", [(10, 20_000), (3, 40)])
def test_search_by_hand(spark, monkeypatch, k, together):
    monkeypatch.setattr(search, "QUERY_TERMS", together)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "naïve", "日本", "42", "É²"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    docs = [(i if i % 50 else None, rng.choice([" ", "-", "\n", "_"]).join(
        w.upper() if rng.random() < 0.2 and w.isascii() else w for w in rng.choices(vocabulary, weights, k=int(rng.lognormvariate(3, 1.3))))) for i in range(700)]
    docs += [docs[3], docs[3], (900, None), (901, ""), (902, "!?"), (903, "w7 " * 5000), (903, "w7 " * 5000), (None, docs[4][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(25)]
    items += [(3, "w7 w7 w9"), (None, "w8 w8"), (30, None), (31, ""), (32, "nowhere"), (33, items[5][1]), items[5], (34, "w7 " * 300)]
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    got = got_of(search.search(left, spark.createDataFrame(items, "item_id bigint, text string"), k))
    assert got == slow_search(docs, items, k)


def test_search_of_the_table(spark):
    docs = [tuple(r) for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    assert got_of(queries.op12_search(spark, SMALL)) == slow_search(docs, items)


def test_bounds_never_fall_below_scores(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 13)
    docs = [tuple(r) for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    index = search.build_index(queries.table(spark, SMALL, "documents"))
    blocks = index.collect()
    # Functions travel to the workers by reference here, so the size of blocks is the module's.
    asked = [Counter(search.terms_of(r["text"].encode())) for r in queries.table(spark, SMALL, "benchmark").collect()]
    known = search._Queries(range(len(asked)), asked, Counter({t: 7 for c in asked for t in c}))
    n_docs, n_terms = sum(b["n_docs"] for b in blocks), sum(b["n_terms"] for b in blocks)
    assert n_docs == sum(1 for _, t in docs if slow_terms(t)) and n_terms == sum(len(slow_terms(t)) for _, t in docs)
    tight = loose = 0
    for b in blocks:
        n = np.array(b["lengths"])
        m = 25 + 75 * n * n_docs // n_terms
        bits = np.frombuffer(b["bits"], np.uint8).reshape(b["rows"], -1)
        bounds = search._bounds(known, bits, len(n), m, n)
        for d, text in enumerate(search.texts_of(bytes(b["texts"]))):
            tf = Counter(text.split())
            exact = [sum(w * (10**9 * tf[t] // (1000 * tf[t] + 8 * int(m[d]))) for t, w in pairs if tf[t]) for pairs in known.pairs]
            assert (bounds[:, d] >= exact).all()
            tight, loose = tight + sum(exact), loose + int(bounds[:, d].sum())
    assert loose < 1.6 * tight


def test_search_odd_rows(spark):
    odd = spark.createDataFrame(ODD, DOC).withColumns({n: F.lit("clash") for n in ["rank", "SCORE", "number", "block", "terms", "ids", "item_id"]})
    items = spark.createDataFrame([(1, "the same WORDS", "x"), (2, None, "x"), (3, "id long", "x")], "item_id bigint, text string, doc_id string")
    expected = slow_search([(r[0], r[1]) for r in ODD], [(1, "the same WORDS"), (2, None), (3, "id long")])
    assert got_of(search.search(odd, items)) == expected and expected
    assert search.search(odd.limit(0), items).collect() == []
    assert search.search(odd, items.limit(0)).collect() == []
    named = search.search(odd.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))), items)
    assert {r["doc_id"] for r in named.collect()} <= {"d10", "d11", "d12", None}
