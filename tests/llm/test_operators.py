"""Operators against brute force, on the small tables and on rows with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import common, components, embeddings, language, mixing, packing, queries, repetition, sharding, simhash
from millrace.llm import substrings, tokens, urls
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.conftest import SMALL

MIDDLE = "/root/testdata/sf0.01"

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "long " * 30_000 + "end"

ODD = [
    (5, None, None, None, None),
    (None, "no id at all " * 10, "en", "src0", 3),
    (7, "", "en", "src1", 0),
    (7, "", "en", "src1", 0),
    (8, " \t\n\x0b ", "fr", None, 5),
    (9, "1234 5678 !!!", None, "src0", 13),
    (10, LONG, "en", "src0", 1),
    (11, "the same words stand here twice " * 8, "en", "src2", 1),
    (12, "the same words stand here twice " * 8, "en", "src2", 1),
    (12, "the same words stand here twice " * 8, "en", "src2", 1),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, MIDDLE, "documents").repartition(5).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.orderBy("doc_id").select("doc_id", "text", "lang", "source").collect()]


def words(text):
    return (text or "").encode().split()


# --- mixing

def filled(sizes, weights, budget, cap):
    """Water-filling by bisection of the level."""
    lo, hi = 0.0, float(budget + 1)
    for _ in range(200):
        level = (lo + hi) / 2
        if sum(min(cap * s, level * w) for s, w in zip(sizes, weights)) < budget:
            lo = level
        else:
            hi = level
    return [min(cap * s, hi * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[100, 1, 5, 1000], [10], [0, 0], [7, 7, 7, 7, 7, 7, 7], [1, 2, 4, 8, 16, 32, 64, 10_000]])
def test_water_fill(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    table = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "n int, source_size bigint, weight int")
    got = [r["target"] for r in mixing.water_fill(table, 1.5 * sum(sizes), 2.0).orderBy("n").collect()]
    assert got == pytest.approx(filled(sizes, weights, 1.5 * sum(sizes), 2), abs=1e-6)


def test_mix_meets_targets(docs, rows):
    mixed = mixing.mix(docs, common.word_count(F.col("text"))).collect()
    taken, target = Counter(), {}
    for r in mixed:
        assert r["size"] == len(words(r["text"])) and 0 <= r["repeats"] <= 2
        taken[r["source"]] += r["repeats"] * r["size"]
        target[r["source"]] = r["target"]
    largest = max(r["size"] for r in mixed)
    assert len(mixed) == len(rows) and all(abs(taken[s] - target[s]) <= largest / 2 + 1 for s in target)
    again = mixing.mix(docs.repartition(3), common.word_count(F.col("text"))).collect()
    assert sorted((r["doc_id"], r["repeats"]) for r in again) == sorted((r["doc_id"], r["repeats"]) for r in mixed)
    other = mixing.mix(docs, common.word_count(F.col("text")), seed=99).collect()
    assert sorted((r["doc_id"], r["repeats"]) for r in other) != sorted((r["doc_id"], r["repeats"]) for r in mixed)


def test_mix_odd_rows(odd, empty):
    mixed = mixing.mix(odd.withColumn("target", F.lit("x")).withColumn("key", F.lit(1)), common.word_count(F.col("text"))).collect()
    assert len(mixed) == len(ODD)
    assert all(r["source_size"] == sum(len(words(t)) for _, t, _, s, _ in ODD if s == r["source"]) for r in mixed)
    assert len({r["repeats"] for r in mixed if r["doc_id"] == 12}) == 1
    assert mixing.mix(empty, common.word_count(F.col("text"))).collect() == []


# --- repetition

def by_hand(text, lengths):
    w = [x.decode() for x in words(text)]
    out = {}
    for k in lengths:
        seen, covered = set(), set()
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            if g in seen:
                covered.update(range(i, i + k))
            seen.add(g)
        out[k] = sum(len(w[i]) for i in covered)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    twice = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(twice), out


def test_repetition_by_hand(rows):
    odd = [t for _, t, _, _, _ in ODD] + ["é é é é é é é é é", "a b c a b c", "# * $\n# * $\n\n  \n x"]
    for text in [t for _, t, _, _ in rows[:150]] + odd:
        found = repetition.measure(None if text is None else text.encode())
        n, chars, twice, dup = by_hand(text, (5, 7, 10))
        assert (found["n_words"], found["word_chars"], found["n_repeat_words"]) == (n, chars, twice)
        assert {k: found[f"dup_chars_{k}"] for k in dup} == dup


def test_repetition_rows(odd, empty):
    got = repetition.judge(odd.withColumn("n_words", F.lit("clash"))).collect()
    assert len(got) == len(ODD) and all(r["kept"] is not None for r in got)
    assert all(r["base_failed"] and not r["kept"] for r in got if not r["text"])
    assert repetition.judge(empty).collect() == []


# --- language

def test_language_held_out(spark):
    found = queries.op3_language(spark, MIDDLE)
    labels = queries.table(spark, MIDDLE, "documents").select("doc_id", "lang")
    got = found.join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in got) < 20 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(odd, empty, docs):
    known = language.learn(docs)
    got = {(r["doc_id"], r["text"]): r for r in language.identify(odd.withColumn("score", F.lit("clash")), known).collect()}
    for key, r in got.items():
        plain = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == plain and (not plain or (r["rejected"] and r["score"] == 0))
    assert language.learn(empty) == {}
    assert {r["lang_pred"] for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.identify(empty, known).collect() == []
    assert all(len(v) <= language.DICTIONARY_BYTES for v in known.values())


def test_language_sample_of_shared_ids(spark):
    text = F.concat_ws(" ", F.lit("words"), F.col("id"))
    many = spark.range(8000).withColumns({"text": text, "source": F.lit("s")})
    hot = many.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit("null").alias("lang"))
    for i in (1, 2, 3, 4):
        hot = hot.unionByName(many.select(F.lit(i).cast("bigint").alias("doc_id"), "text", F.lit(f"hot {i}").alias("lang")))
    same = many.select(F.lit(6).cast("bigint").alias("doc_id"), F.lit("all the same").alias("text"), F.lit("same").alias("lang"))
    known = language.learn(hot.unionByName(same))
    assert set(known) == {"null", "hot 1", "hot 2", "hot 3", "hot 4", "same"}
    assert all(len(set(v.split(b"\n"))) == (1 if l == "same" else 400) for l, v in known.items())


def test_language_is_the_smallest_compression(spark, docs, rows):
    """Predictions against compressors made here, with zstandard alone."""
    import zstandard

    known = language.learn(docs)
    settings = zstandard.ZstdCompressionParameters.from_level(language.LEVEL, dict_size=64_000, source_size=4096, write_content_size=False,
                                                              write_checksum=False, write_dict_id=False, **language.SEARCH)
    makers = {l: zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
              for l, d in known.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs.select("doc_id", "text"), known).collect()}
    for i, text, _, _ in rows[:300]:
        data, expected = (text or "").lower().encode(), ("und", 0.0)
        if any(c.isalpha() for c in text or ""):
            sizes = sorted((sum(len(m.compress(data[a : a + 4096])) for a in range(0, len(data), 4096)), l) for l, m in makers.items())
            expected = (sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0])
        assert got[i] == expected, i
    odd = ["²³ ½", "Ⅷ 12", "x²", "_", "日"]
    found = language.identify(spark.createDataFrame([(t,) for t in odd], "text string"), known).collect()
    assert [r["lang_pred"] == "und" for r in sorted(found, key=lambda r: odd.index(r["text"]))] == [True, True, False, True, False]


# --- clashing names

INTERNAL = """cut whole _source shard _row _n _order _cuts _place _content _check _first _places _begins _copy n_words lang_pred score rejected kept kept_text
  n_removed size source_size target repeats key prefix due text_hash bits h1 h2 class block partner root labels host path rule verdict part kind found
  open handed best row others mix_cut mix_source with_cut length piece start ids_crc32 _rank _part _base component_id fingerprint word_chars base_failed
  shingles node leaders a b _weight _upto before""".split()

ADDED = {"mix": {"size", "source_size", "target", "repeats"}, "shards": {"shard", "slot"}, "repeats": {"n_words", "n_removed", "kept_text"},
         "judge": {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", "base_failed", "kept"},
         "language": {"lang_pred", "score", "rejected"}, "urls": {"host", "path", "rule", "verdict"}}


@pytest.mark.parametrize("upper", [False, True])
def test_clashing_names(spark, odd, docs, upper):
    names = [n.upper() if upper else n for n in INTERNAL]
    clash = odd.withColumns({n: F.lit(777) for n in names}).cache()
    known = language.learn(docs)
    url = clash.withColumn("url", F.lit("http://a.org/x"))
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    results = {"mix": mixing.mix(clash, common.word_count(F.col("text"))), "shards": sharding.shuffle_into_shards(clash, 3), "repeats": substrings.remove_repeats(clash),
               "judge": repetition.judge(clash), "language": language.identify(clash, known), "urls": urls.filter_urls(url, rules)}
    for name, result in results.items():
        lost = {c for c in names if c.lower() in ADDED[name] or c.lower().startswith("dup_chars")}
        assert len({c.lower() for c in result.columns}) == len(result.columns), name
        assert set(clash.columns) - lost <= set(result.columns), name
        got = result.collect()
        assert len(got) == len(ODD), name
        assert all(r[c] == 777 for r in got for c in names if c not in lost), name
    assert len(simhash.near_duplicates(clash).collect()) == len(ODD)
    assert packing.pack(clash, queries.tokenizer_path()).count() >= len(ODD)


def test_mix_parts_documents_that_share_an_id(spark, docs):
    """A third of the ids are null: every source still comes near its target."""
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id")))
    taken, target, largest = Counter(), {}, 0
    for r in mixing.mix(shared, common.word_count(F.col("text"))).collect():
        taken[r["source"]] += r["repeats"] * r["size"]
        target[r["source"]], largest = r["target"], max(largest, r["size"])
    assert all(abs(taken[s] - target[s]) <= largest / 2 + 1 for s in target)


# --- simhash and components

def test_components_by_hand(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 180)] + [(500, x) for x in range(501, 560)] + [(7, 7), (None, 3)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(260)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def slow_print(text):
    w = [x for x in (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()]
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest id of each row's group, by comparing all fingerprints."""
    values = np.array(sorted(set(prints.values())), np.uint64)
    group = {int(v): int(v) for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for v in values:
        for u in values[np.bitwise_count(values ^ v) <= 4]:
            a, b = find(int(v)), find(int(u))
            group[max(a, b)] = min(a, b)
    least = {}
    for i, p in prints.items():
        least[find(p)] = min(least.get(find(p), i), i)
    return {i: least[find(p)] for i, p in prints.items()}


def test_simhash_by_hand(spark, rows):
    got = {r["doc_id"]: r for r in queries.op4_simhash(spark, MIDDLE).collect()}
    prints = {i: slow_print(t) for i, t, _, _ in rows}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == slow_groups(prints)


def test_near_links_loses_none(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for s in seeds for _ in range(20)} | {0, (1 << 64) - 1}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    table = spark.createDataFrame([(p,) for p in signed], "bits bigint")
    got = {frozenset((signed[r["a"]], signed[r["b"]])) for r in simhash.near_links(table).collect()}
    assert got == {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4}


def test_simhash_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd.withColumn("bits", F.lit("clash"))).collect()
    assert len(got) == len(ODD)
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {5}
    assert {(r["component_id"], r["kept"]) for r in got if r["doc_id"] == 12} == {(11, False)}
    assert simhash.near_duplicates(empty).collect() == []


# --- tokens and packing

def slow_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    return [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


TRICKY = ["a<|endoftext|>b", "x\x1cy !\x1d? z", "  two  spaces \n\n and lines\r\n", "it's we'll 'S !!'s", "a\u00a0 b\u2003\u3000c \u00a0", "日本語 text 12 ½²",
          "\ud7ff\u0085 nel\u0085 x", "tab\t\ttab \t x", "\n", " ", "end with space ", "🙂🙂 🙂", "w" * 500 + " " + "v" * 70]


def test_encoder_is_the_library(rows):
    texts = TRICKY + [t for _, t, _, _ in rows[:200]] + [None, ""]
    got = tokens.Encoder(queries.tokenizer_path()).encode(texts)
    assert [g.tolist() + [0] for g in got] == slow_ids(texts)


def test_token_files_round_trip(spark, docs, rows):
    got = sorted(queries.op5_tokens(spark, MIDDLE).collect())
    at = 0
    for r, (i, text, _, _), ids in zip(got, rows, slow_ids([t for _, t, _, _ in rows]), strict=True):
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_odd_rows(spark, odd, empty, tmp_path):
    tokens.write_tokens(odd, str(tmp_path / "odd"), queries.tokenizer_path(), "uint32")
    got = tokens.read_tokens(spark, str(tmp_path / "odd"), docs_per_task=3, with_ids=True).orderBy("start").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    assert [r["ids"] for r in got] == slow_ids([r[1] for r in order])
    manifest = tokens.write_tokens(empty, str(tmp_path / "empty"), queries.tokenizer_path())
    assert manifest["files"] == [] and tokens.read_tokens(spark, str(tmp_path / "empty")).collect() == []


def test_token_files_of_one_id(spark, tmp_path):
    texts = [f"text {i * 7919 % 1000:04d}" for i in range(1000)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string").repartition(4)
    manifest = tokens.write_tokens(docs, str(tmp_path / "one"), queries.tokenizer_path())
    assert sum(f["docs"] for f in manifest["files"]) == 1000 and max(f["docs"] for f in manifest["files"]) < 500
    got = tokens.read_tokens(spark, str(tmp_path / "one"), with_ids=True).orderBy("start").collect()
    assert [r["ids"] for r in got] == slow_ids(sorted(texts))


def check_packing(got, ids, capacity):
    sequences = defaultdict(list)
    for r in got:
        assert 0 < r["length"] <= capacity
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for x in ids:
        # Whole, or a first piece with what is left over and then full ones.
        first = len(x) % capacity if len(x) > capacity else len(x)
        ends = [first] * (first > 0) + list(range(first + capacity, len(x) + 1, capacity))
        for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            expected[a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes()), k] += 1
    assert Counter((r["start"], r["length"], r["ids_crc32"], r["piece"]) for r in got) == expected
    return len(sequences)


def test_packing_by_hand(spark, rows):
    ids = slow_ids([t for _, t, _, _ in rows])
    n = check_packing(queries.op7_packing(spark, MIDDLE).collect(), ids, 2048)
    assert n <= -(-sum(map(len, ids)) // 2048) * 1.01 + 1


def test_packing_odd_rows(odd, empty):
    got = packing.pack(odd.withColumn("length", F.lit("clash")), queries.tokenizer_path(), 64).collect()
    check_packing(got, slow_ids([t for _, t, _, _, _ in ODD]), 64)
    assert packing.pack(empty, queries.tokenizer_path()).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(1, 60))
    counts = np.concatenate([[0], rng.integers(0, 9, capacity)])
    plan = packing.plan_sequences(counts)
    used = np.zeros_like(counts)
    for pattern, times in plan:
        assert times > 0 and sum(pattern) <= capacity
        for x in pattern:
            used[x] += times
    assert (used == counts).all()
    index = packing.SumIndex(counts.copy())
    slow = np.zeros(2 * len(counts), np.int64)
    for a in np.flatnonzero(counts):
        for b in np.flatnonzero(counts):
            slow[a + b] += 1
    assert (index.pairs == slow).all()


def test_plan_finds_exact_complements():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 50, 30, 20, 55, 25, 15, 5]] = [4, 4, 3, 3, 3, 2, 2, 2, 2]
    plan = packing.plan_sequences(counts)
    assert sum(t for p, t in plan) == -(-int((counts * np.arange(101)).sum()) // 100)


# --- embeddings

def slow_links(vectors):
    fine = {n: np.array(v, float) for n, (_, v) in enumerate(vectors)
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = defaultdict(set)
    for a in fine:
        for b in fine:
            x, y = fine[a], fine[b]
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[a].add(b)
                links[b].add(a)
    out = []
    for n, (i, _) in enumerate(vectors):
        reach, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - reach:
                reach.add(m)
                todo.append(m)
        least = min((vectors[m][0] for m in reach if vectors[m][0] is not None), default=None)
        out.append((i, len(links[n]), least, i == least))
    return out


@pytest.mark.parametrize("block_rows", [8192, 40])
def test_embeddings_by_hand(spark, block_rows):
    rng = np.random.default_rng(1)
    seeds = rng.normal(size=(25, 24))
    rows = [(i, (seeds[i % 25] + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.4])).tolist()) for i in range(200)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(300, [2 * x for x in rows[3][1]]), (301, None), (302, []), (303, [0.0] * 24),
             (304, [float("nan")] + [1.0] * 23), (305, [None] + [1.0] * 23), (306, [1.0, 2.0]), (307, [1.0, 2.1]), (None, rows[5][1]),
             (308, [float("inf")] + [1.0] * 23), (4, rows[4][1]), (309, [1e200] * 24), (310, [1e-200] * 24), (311, [-0.0] * 23 + [1.0]), (312, [0.0] * 23 + [1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, class string")
    got = [tuple(r) for r in embeddings.near_duplicates(table, block_rows=block_rows).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    # Numbers that overflow when squared are beyond the slow version.
    huge = {309, 310}
    expected = [r for r in slow_links([v for v in rows if v[0] not in huge])]
    assert sorted((r for r in got if r[0] not in huge), key=key) == sorted(expected, key=key)
    assert sorted(r for r in got if r[0] in huge) == [(309, 1, 309, True), (310, 1, 309, False)]
    assert embeddings.near_duplicates(table.where("vec_id < 0")).collect() == []


def test_embeddings_of_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SMALL, "embeddings").select("vec_id", "embedding").collect()]
    x = np.array([v for _, v in rows])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    got = {r["vec_id"]: r["n_links"] for r in queries.op6_embeddings(spark, SMALL).collect()}
    assert got == {i: int(n) - 1 for (i, _), n in zip(rows, (x @ x.T >= 0.95).sum(axis=1))}


@pytest.mark.parametrize("seed", range(5))
def test_partner_spans_lose_no_pair(seed):
    rng = np.random.default_rng(seed)
    rows = sorted((int(d), float(x)) for d, x in zip(rng.choice([2, 3, 3, 3, 7], 400), rng.normal(size=400)))
    edges = {}
    for n, (d, x) in enumerate(rows):
        edges.setdefault((d, n // 10), []).append(x)
    spans = embeddings.partner_spans([(d, b, min(v), max(v)) for (d, b), v in edges.items()], 0.05)
    assert [b for b, _, _ in spans] == list(range(40))
    met = {(b, p) for b, least, most in spans for p in range(least, most + 1)}
    assert met == {(p, b) for b, p in met} and len(met) < 1600
    assert {(m // 10, n // 10) for m, (d, x) in enumerate(rows) for n, (e, y) in enumerate(rows) if d == e and abs(x - y) <= 0.05} <= met


def test_driver_holds_a_row_for_each_block(spark, monkeypatch):
    rng = np.random.default_rng(2)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 40)))], "vec_id bigint, embedding array<double>")
    made, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: made.append(len(data)) or make(self, data, *a, **k))
    assert len(embeddings.near_duplicates(table, threshold=0.5, block_rows=10).collect()) == 300
    assert made and max(made) <= 30


# --- substrings

def slow_cut(rows, window=20):
    """rows of (order, text) in order; repeats of a row count as the row itself."""
    seen, out = {}, {}
    for order, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if seen.setdefault(g, (order, text, i)) != (order, text, i):
                gone.update(range(i, i + window))
        out[order, text] = len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]
    return out


@pytest.mark.parametrize("window", [3, 20])
def test_substrings_by_hand(spark, window):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["Æ", "x|", "|"]
    passage = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 120))] for _ in range(6)]
    rows = []
    for i in range(80):
        w = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            w += (rng.choice(passage) if kind < 0.4 else ["|"] * rng.randrange(1, 70) if kind < 0.55 else
                  ["a", "b"] * rng.randrange(1, 40) if kind < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randrange(40))])
        rows.append((rng.randrange(1000) * 100 + i, " ".join(w)))
    rows += [(100_000, rows[0][1]), (100_001, rows[0][1].replace(" ", "\n"))]
    expected = slow_cut(sorted(rows), window)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = substrings.remove_repeats(table, window=window).collect()
    for r in got:
        n, gone, left = expected[r["doc_id"], r["text"]]
        assert (r["n_words"], r["n_removed"], words(r["kept_text"])) == (n, gone, left), r["doc_id"]


def test_substrings_odd_rows(odd, empty):
    # A row that comes twice is one document; among equal ids a hash of the text decides.
    order = sorted({(10**9 if r[0] is None else r[0], r[1]) for r in ODD}, key=lambda r: (r[0], r[1] or ""))
    expected = slow_cut(order)
    got = substrings.remove_repeats(odd.withColumn("kept_text", F.lit("clash")).withColumn("key", F.lit(1))).collect()
    assert len(got) == len(ODD)
    for r in got:
        n, gone, left = expected[10**9 if r["doc_id"] is None else r["doc_id"], r["text"]]
        assert (r["n_words"], r["n_removed"], words(r["kept_text"])) == (n, gone, left)
    assert substrings.remove_repeats(empty).collect() == []


def test_untouched_texts_stay_as_they_are(spark):
    text = "one\n two\tthree " * 3
    got = substrings.remove_repeats(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert got["kept_text"] == text and got["n_removed"] == 0
    assert hashlib.sha256(b" ".join(words(text))).hexdigest() == spark.range(1).select(
        F.sha2(substrings.joined_words(F.lit(text)), 256)).first()[0]


# --- urls

def slow_rule(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_by_hand(spark):
    rng = random.Random(2)
    labels, parts = ["a", "b", "ab", "com", "org", "x-y"], ["", "/", "/a", "/ab/", "/a/b", "/b/"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) for _ in range(40)]
    rules = list({(rng.choice(hosts), rng.choice(parts)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [(None, "/", "block"), ("com", None, "block")]
    links = [f"http://{rng.choice(hosts).upper() if rng.random() < 0.3 else rng.choice(hosts)}{rng.choice(parts)}{rng.choice(['', 'a/b', '?q=/a', '#a'])}"
             for _ in range(600)] + [None, "", "no scheme/at all", "://", "x://?q", "a://b://c/d", "http://com:80/a", "http://a\n.com/b\nc"]
    table = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(links)], "page_id bigint, url string, rule string").repartition(7)
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = urls.filter_urls(table, known).orderBy("page_id").collect()
    plain = [r for r in rules if r[0] is not None and r[1] is not None]
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [slow_rule(u, plain) for u in links]
    assert urls.filter_urls(table.where("page_id < 0"), known).collect() == []
    assert {r["verdict"] for r in urls.filter_urls(table, known.where("host = 'none'")).collect()} == {"allow"}


# --- sharding

def test_matrix_margins_and_law():
    counts, sizes = [5, 0, 9, 2], [6, 5, 5]
    drawn = [sharding.communication_matrix(counts, sizes, s) for s in range(4000)]
    assert all((m.sum(axis=1) == counts).all() and (m.sum(axis=0) == sizes).all() and (m >= 0).all() for m in drawn)
    # Entry (0, 0) is hypergeometric: 6 of 16 places, 5 drawn.
    from math import comb

    seen = Counter(int(m[0, 0]) for m in drawn)
    for k in range(6):
        share = comb(6, k) * comb(10, 5 - k) / comb(16, 5)
        assert abs(seen[k] / len(drawn) - share) < 5 * (share * (1 - share) / len(drawn)) ** 0.5 + 1e-9
    huge = sharding.communication_matrix([10**10] * 30, sharding.shard_sizes(3 * 10**11, 8), 1)
    assert (huge.sum(axis=0) == 3 * 10**11 // 8).all() and (huge.sum(axis=1) == 10**10).all()


def test_shards_by_hand(spark, rows):
    got = queries.op10_shards(spark, MIDDLE).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == sorted(sharding.shard_sizes(len(rows), 8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_odd_rows(odd, empty):
    got = sharding.shuffle_into_shards(odd.withColumn("slot", F.lit("clash")), 4, partitions=3).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in ODD)
    assert sorted(Counter(r["shard"] for r in got).values()) == [2, 3, 3, 3]
    assert sharding.shuffle_into_shards(empty, 4).collect() == []


# --- queries

def test_running_total(spark):
    rows = spark.range(1000).withColumn("w", F.when(F.col("id") % 7 != 0, F.col("id"))).repartition(9)
    got = {r["id"]: r["before"] for r in common.running_total(rows, ["id"], "w").collect()}
    at = 0
    for i in range(1000):
        assert got[i] == at
        at += i if i % 7 else 0


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = spark_rows(queries.QUERIES[name](spark, SMALL))
    assert got[1]
    if name in queries.SQL:
        assert difference(got, duck_rows(duck, queries.SQL[name])) is None
