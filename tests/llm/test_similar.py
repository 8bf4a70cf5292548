"""Near-duplicates by similarity against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, similar
from tests.llm.test_operators import DOC, MIDDLE, ODD


def slow_shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, rng, vocabulary, least):
    """A copy with random words replaced, down to the last state at or above the similarity."""
    now, base = list(words), slow_shingles(" ".join(words))
    while True:
        new = list(now)
        new[rng.randrange(len(new))] = rng.choice(vocabulary)
        if jaccard(base, slow_shingles(" ".join(new))) < least:
            return " ".join(now)
        now = new


def groups_of(rows):
    return {r["doc_id"]: r["component_id"] for r in rows}


@pytest.mark.parametrize("least", [0.8, 0.9, 0.95])
def test_recall_of_planted_pairs(spark, least):
    rng = random.Random(8)
    texts = [r["text"] for r in queries.table(spark, MIDDLE, "documents").select("text").collect()]
    vocabulary = sorted({w for t in texts for w in (t or "").split()})
    rows, planted = [], []
    for n in range(250):
        words = rng.choices(vocabulary, k=int(rng.lognormvariate(5, 1)) + 60)[:2000]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, edited(words, rng, vocabulary, least))]
        planted.append(2 * n)
    found = groups_of(similar.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    recall = sum(found[n] == found[n + 1] for n in planted) / len(planted)
    print(f"recall at {least}: {recall}")
    assert recall >= 0.9
    assert all(found[i] // 2 == i // 2 for i in found)


def check_groups(spark, rows, **settings):
    """Links of the result are true ones; true links between groups are few."""
    got = similar.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), **settings).collect()
    group, sets = groups_of(got), {i: slow_shingles(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    true = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if jaccard(sets[a], sets[b]) >= 0.8]
    for a, b in true:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert all(find(i) == find(g) for i, g in group.items()), "a link that is none"
    lost = sum(group[a] != group[b] for a, b in true)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return len(true), lost


def test_groups_of_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, MIDDLE, "documents").select("doc_id", "text").collect()]
    true, lost = check_groups(spark, rows)
    assert true > 50 and lost <= 0.05 * true


@pytest.mark.parametrize("group", [4, 64])
def test_large_groups_of_near_copies(spark, group):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for cluster in range(3):
        base = rng.choices(vocabulary, k=150)
        for n in range(90):
            words = list(base)
            for _ in range(rng.randrange(8)):
                words[rng.randrange(150)] = rng.choice(vocabulary)
            rows.append((cluster * 1000 + n, " ".join(words)))
    rows += [(5000 + n, " ".join(rng.choices(vocabulary, k=100))) for n in range(100)]
    true, lost = check_groups(spark, rows, group=group)
    assert true > 2000 and lost <= 0.03 * true


@pytest.mark.parametrize("block", [512, 50])
def test_near_texts_that_are_not_similar_are_no_rows(spark, monkeypatch, block):
    """Copies of one text that differ from it in two or three words each: nearly all pairs are near, few are similar."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, rows = rng.choices(vocabulary, k=150), []
    for n in range(240):
        words = list(base)
        for at in rng.sample(range(150), 2 + n % 2):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compared, verified = [], similar._verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(similar, "_verified", counted)
    monkeypatch.setattr(similar, "BLOCK", block)
    whole = sorted(tuple(r) for r in similar.similar_documents(docs, group=4096).collect())
    near = compared[-1]
    assert sorted(tuple(r) for r in similar.similar_documents(docs, group=16).collect()) == whole
    assert compared[-1] < 0.3 * near, (compared, near)
    assert 1 < len({r[2] for r in whole}) < len(rows)


@pytest.mark.parametrize("group", [3, 64, 1000])
def test_no_pair_that_meets_is_lost(group):
    """Deal and pair in one process, batch by batch, twice: pairs that share a key are compared, hang together by then,
    or share a key that goes to the join."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    shape = similar.Layout(16, 4, 17, 70, group)
    base = rng.integers(0, 256, (3, 8 * shape.words), np.uint8)
    prints = base[rng.integers(0, 3, 500)]
    for row in prints:
        for bit in rng.integers(0, 64 * shape.words, rng.integers(0, 6)):
            row[bit // 8] ^= np.uint8(1 << bit % 8)
    nodes, blobs = np.arange(500), pa.array([r.tobytes() for r in prints], pa.binary())
    keys, sketch = similar.keys_of(prints, shape)

    def by_part(batches, pairs_of):
        dealt = pa.Table.from_batches(batches)
        return pa.concat_tables([pairs_of(dealt.filter(pa.array(np.array(dealt.column("part")) == p)), shape) for p in range(7)])

    table = pa.table({"node": nodes, "print": blobs})
    found = by_part([b for batch in table.to_batches(max_chunksize=200) for b in similar._deal(iter([batch]), shape, 7)], similar._pairs_of)
    pairs = {(a, b) for a, b in zip(found.column("a").to_pylist(), found.column("b").to_pylist()) if b is not None}
    hot = {}
    for key, a, b in zip(*(found.column(c).to_pylist() for c in ("key", "a", "b"))):
        if b is None:
            hot.setdefault(key, set()).add(a)
    opened = {x for p in pairs for x in p} | {x for m in hot.values() for x in m}
    pairs = {p for p in pairs if p[0] != p[1]}
    # Of the pairs found first, some turn out not to be similar.
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if (a + b) % 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    rows = sorted(opened)
    table = pa.table({"node": nodes[rows], "root": [find(i) for i in rows], "print": blobs.take(pa.array(rows))})
    again = by_part([b for batch in table.to_batches(max_chunksize=150) for b in similar._deal_again(iter([batch]), shape, 7)], similar._cross_pairs)
    crossed = list(zip(again.column("a").to_pylist(), again.column("b").to_pylist()))
    assert len(crossed) == len(set(crossed))
    meet = [(a, b) for a in range(500) for b in range(a + 1, 500) if (keys[a] == keys[b]).any() and (int(sketch[a] ^ sketch[b]) & (1 << 64) - 1).bit_count() <= 17]
    assert pairs <= set(meet) and len(meet) > 10_000
    lost = [(a, b) for a, b in meet if find(a) != find(b) and (a, b) not in pairs and (a, b) not in set(crossed) and not any(a in m and b in m for m in hot.values())]
    assert not lost and (not hot or group < 1000)


def test_wide_print_by_hand():
    hashes = similar.shingles([f"w{i}".encode() for i in range(400)])
    got = np.unpackbits(np.frombuffer(similar.wide_print(hashes, 3), np.uint8), bitorder="little")
    ones = np.zeros(192, int)
    for h in hashes.tolist():
        for j in range(3):
            x = (h + (j + 1) * 0x9E3779B97F4A7C15) % 2**64
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
            x ^= x >> 31
            ones[64 * j : 64 * j + 64] += [x >> b & 1 for b in range(64)]
    assert (got == (2 * ones > len(hashes))).all()


def test_similar_odd_rows(spark):
    odd = spark.createDataFrame(ODD, DOC)
    names = ["print", "H1", "node", "words", "kept", "component_id", "Text_Hash", "a", "key"]
    got = similar.similar_documents(odd.withColumns({n: F.lit(777) for n in names})).collect()
    assert len(got) == len(ODD)
    by = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got)
    assert by[5, 5, True] == 1 and by[7, 5, False] == 2 and by[8, 5, False] == 1 and by[None, 5, False] == 1
    assert by[11, 11, True] == 1 and by[12, 11, False] == 2 and by[10, 10, True] == 1 and by[None, None, True] == 1
    assert similar.similar_documents(odd.limit(0)).collect() == []


def test_copies_are_paired_once_a_segment():
    """Texts that are equal in a segment share a key for each of its bits, but make rows under one of them."""
    import pyarrow as pa

    shape = similar.Layout(16, 4, 17, 70, 64)
    prints = np.random.default_rng(3).integers(0, 256, 8 * shape.words, np.uint8)
    table = pa.table({"node": np.arange(60), "print": pa.array([prints.tobytes()] * 60, pa.binary())})
    dealt = pa.Table.from_batches(list(similar._deal(iter(table.to_batches()), shape, 64)))
    parts = [similar._pairs_of(dealt.filter(pa.array(np.array(dealt.column("part")) == p)), shape) for p in range(64)]
    found = pa.concat_tables(parts)
    assert found.num_rows <= shape.segments * 59
    assert set(zip(found.column("a").to_pylist(), found.column("b").to_pylist())) == {(0, n) for n in range(1, 60)}
