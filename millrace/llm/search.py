"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents with about as many different terms. A document's Bloom signature has an item for
each of its terms and, if the term occurs more often, one for each of some levels of frequency. The signatures of a
block are stored sliced: row j is a bitmap of the documents that have bit j set. So a term's documents, at a level, are
the AND of a few rows, which may name too many documents but never leaves one out. Adding up the rows of a query's
terms, each with the most that its weight can bring at that level in a document of that length, bounds every score from
above. Documents are scored exactly from the greatest bound downwards, until the bound falls below the k-th score found;
what is then left cannot be among the best k.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import LOWER, UPPER, quoted, releasing, running_total, text_bytes, with_fields, worker_state
from millrace.session import stored

# Documents and bytes of text of a block; a longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 1024, 1 << 20

# Least frequencies of the levels, rows that an item sets, and rows for each item of the block's fullest document.
LEVELS = (1, 2, 3, 5, 9, 17)
ROWS_PER_ITEM, ROWS_PER_SPACE = 3, 10

# Query terms (with repeats) that are searched for at once, and places of the sums that are held at once.
QUERY_TERMS, CELLS = 20_000, 500_000

# Terms whose hashes a worker remembers.
KNOWN_TERMS = 50_000

# Terms are runs of ASCII letters and digits and of anything beyond ASCII.
_TERM_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def texts_of(packed: bytes) -> list[bytes]:
    """The documents of a block, as terms between spaces."""
    return zstandard.ZstdDecompressor().decompress(packed).split(b"\n")


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the items (term, level) out of the terms' own."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def _rows(hashes: np.ndarray, rows: int) -> list[np.ndarray]:
    """The rows that each item sets, of so many."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(k) * high) % np.uint64(rows)).astype(np.int64) for k in range(ROWS_PER_ITEM)]


class _Block:
    """Documents on their way into one row of the index."""

    def __init__(self):
        self.ids, self.lengths, self.texts, self.items, self.bytes = [], [], [], [], 0
        self.df: Counter[bytes] = Counter()

    def add(self, doc_id: pa.Scalar, text: bytes, terms: list[bytes], counts: Counter, items: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        self.texts.append(text)
        self.items.append(items)
        self.df.update(counts.keys())
        self.bytes += len(text)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        rows = max(1, ROWS_PER_SPACE * max(map(len, self.items)))
        bits = np.zeros((rows, len(self.ids)), bool)
        for n, items in enumerate(self.items):
            for row in _rows(items, rows):
                bits[row, n] = True
        known = [sum(1 for n in self.lengths if n), sum(self.lengths), rows, np.packbits(bits, axis=1).tobytes(), self.ids, self.lengths,
                 list(self.df.keys()), list(self.df.values()), zstandard.ZstdCompressor(3).compress(b"\n".join(self.texts))]
        return pa.RecordBatch.from_arrays([pa.array([v], field.type) for v, field in zip(known, schema)], schema=schema)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each block: n_docs (with a term), n_terms, rows and bits of the sliced signatures, and of each
    document its id and its number of terms; of each term its documents in the block; and, compressed together, the texts
    cut down to their terms, a line each.
    Batch; runs a job. Whole texts; null and empty texts have no terms and are left out."""
    kind = docs.schema[doc_id].dataType
    out = T.StructType.fromDDL("n_docs bigint, n_terms bigint, rows bigint, bits binary").add("ids", T.ArrayType(kind))
    out = with_fields(out, "lengths array<bigint>, terms array<binary>, dfs array<bigint>, texts binary")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[bytes, int] = worker_state("term_hashes", dict)
        blocks: dict[int, _Block] = {}
        schema = None
        for batch in batches:
            ids = batch.column("doc_id")
            schema = schema or pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("rows", pa.int64()), ("bits", pa.binary()), ("ids", pa.list_(ids.type)),
                                          ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int64())), ("texts", pa.binary())])
            for n, raw in enumerate(text_bytes(batch.column("text"))):
                terms = terms_of(raw)
                if not terms:
                    continue
                counts = Counter(terms)
                if len(hashes) > KNOWN_TERMS:
                    hashes.clear()
                for t in counts:
                    if t not in hashes:
                        hashes[t] = xxhash.xxh64_intdigest(t)
                own = np.fromiter((hashes[t] for t in counts), np.uint64, len(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                items = np.concatenate([_mixed(own[tf >= least], level) for level, least in enumerate(LEVELS)])
                size = len(items).bit_length()
                block = blocks.setdefault(size, _Block())
                if block.ids and (len(block.ids) == BLOCK_DOCS or block.bytes + len(raw) > BLOCK_BYTES):
                    yield block.batch(schema)
                    block = blocks[size] = _Block()
                block.add(ids[n].as_py(), b" ".join(terms), terms, counts, items)
        for block in blocks.values():
            yield block.batch(schema)

    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return stored(plain.mapInArrow(releasing(build), out), "search-index")


def _bounds(items: "_Queries", bits: np.ndarray, docs: int, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most that each query (row) can score in each document (column)."""
    rows, found = len(bits), np.zeros((len(items.starts), docs), np.int64)
    before, present = np.zeros(docs, np.int64), None
    for level, least in enumerate(LEVELS):
        most = np.minimum(LEVELS[level + 1] - 1, n) if level + 1 < len(LEVELS) else n
        factor = 1_000_000_000 * most // (1000 * most + 8 * m)
        mine = None
        for row in _rows(_mixed(items.hashes, level), rows):
            mine = bits[row] if mine is None else mine & bits[row]
        present = mine if present is None else present & mine
        if not present.any():
            break
        named = np.unpackbits(present, axis=1, count=docs)
        # At level 0 a term brings at least what it brings in its least frequent class, and so on upwards.
        gain = np.maximum(factor - before, 0)
        before = np.maximum(factor, before)
        step = max(1, CELLS // docs)
        for a, b, first, last in items.chunks(step):
            sums = np.add.reduceat(named[items.term[a:b]] * items.weight[a:b, None], items.starts[first:last] - a, axis=0)
            found[first:last] += sums * gain
    return found


class _Queries:
    """Queries with at least one term: their terms (as numbers into `known`), and weights times repeats."""

    def __init__(self, numbers: Sequence[int], terms: Sequence[Counter], weights: dict[bytes, int]):
        self.numbers, self.known = list(numbers), sorted({t for c in terms for t in c})
        at = {t: n for n, t in enumerate(self.known)}
        self.pairs = [[(t, weights[t] * times) for t, times in c.items()] for c in terms]
        self.term = np.array([at[t] for c in terms for t in c], np.int64)
        self.weight = np.array([w for pairs in self.pairs for _, w in pairs], np.int64)
        self.starts = np.cumsum([0, *map(len, terms)])[:-1]
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.known], np.uint64)

    def chunks(self, most: int) -> Iterator[tuple[int, int, int, int]]:
        """Consecutive queries with at most so many terms, if there are no longer ones: from and to of terms, of queries."""
        ends, first = np.append(self.starts[1:], len(self.term)), 0
        while first < len(self.starts):
            last = max(first + 1, int(np.searchsorted(ends, self.starts[first] + most, side="right")))
            yield int(self.starts[first]), int(ends[last - 1]), first, last
            first = last


def _best(index: DataFrame, queries: _Queries, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """number, doc_id and score of the best k documents of each query in each task: none of the others can be among the
    best k of all."""
    kind = index.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("number", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by falling score and rising id, null last.
        best: list[list[tuple[int, bool, object]]] = [[] for _ in queries.numbers]
        least, id_type = np.ones(len(best), np.int64), None
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for at in range(batch.num_rows):
                n = batch.column("lengths")[at].values.to_numpy()
                m = 25 + 75 * n * n_docs // n_terms
                bits = np.frombuffer(batch.column("bits")[at].as_buffer(), np.uint8).reshape(batch.column("rows")[at].as_py(), -1)
                bounds = _bounds(queries, bits, len(n), m, n)
                ids, texts = batch.column("ids")[at].values, None
                counts: dict[int, Counter] = {}
                for q in np.flatnonzero((bounds >= least[:, None]).any(axis=1)):
                    top, docs = best[q], np.flatnonzero(bounds[q] >= least[q])
                    for d in docs[np.argsort(-bounds[q][docs], kind="stable")].tolist():
                        if bounds[q, d] < least[q]:
                            break
                        texts = texts or texts_of(batch.column("texts")[at].as_py())
                        if d not in counts:
                            counts[d] = Counter(texts[d].split())
                        tf_of, damp, score = counts[d], 8 * int(m[d]), 0
                        for term, weight in queries.pairs[q]:
                            if tf := tf_of.get(term):
                                score += weight * (1_000_000_000 * tf // (1000 * tf + damp))
                        if score > 0:
                            doc = ids[d].as_py()
                            insort(top, (-score, doc is None, doc if doc is not None else 0))
                            if len(top) > k:
                                top.pop()
                            if len(top) == k:
                                least[q] = -top[-1][0]
        if id_type is not None:
            rows = [(number, None if none else doc, -score) for number, top in zip(queries.numbers, best) for score, none, doc in top]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), id_type, pa.int64()))], names=out.names)

    return index.select("lengths", "rows", "bits", "ids", "texts").mapInArrow(releasing(search), out)


def _documents_of(index: DataFrame, terms: Sequence[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms stands."""
    wanted = pa.array(terms, pa.binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            every, dfs = batch.column("terms").flatten(), batch.column("dfs").flatten()
            hit = pc.is_in(every, value_set=wanted.cast(every.type))
            for term, n in zip(every.filter(hit).to_pylist(), dfs.filter(hit).to_pylist()):
                total[term] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "df"])

    counted = index.select("terms", "dfs").mapInArrow(count, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    # One row for each term that was asked for.
    return {bytes(r["term"]): r["df"] for r in counted.collect()}


def _asked(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id, number (of the row), block and terms of each query with a term."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [terms_of(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([xxhash.xxh64_intdigest(b" ".join(t)) >> 1 for t in terms], pa.int64()),
                                              pa.array(terms, pa.list_(pa.binary())), pa.array([len(t) for t in terms], pa.int64())], names=["item_id", "hash", "terms", "size"])

    plain = queries.select(quoted(item_id).alias("item_id"), quoted(text).alias("text"))
    schema = T.StructType([T.StructField("item_id", plain.schema["item_id"].dataType)])
    cut_up = plain.mapInArrow(cut, with_fields(schema, "hash bigint, terms array<binary>, size bigint")).where("size > 0")
    placed = running_total(stored(cut_up, "query-terms"), ["item_id", "hash"], "size")
    placed = placed.withColumn("block", F.floor(F.col("before") / QUERY_TERMS))
    # A query's terms begin where those before end, so that place is its number.
    return stored(placed.select("item_id", F.col("before").alias("number"), "block", "terms"), "asked")


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    query: str = "text", index: DataFrame | None = None,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the best `k` of all documents with a score above 0 for each row of
    `queries`, equal scores by rising doc_id, null last. Batch; runs jobs; `index`, if given, is `build_index(docs)`.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document scores, for each term of the query, repeats
    included, the weight times (10^9 tf) div (1000 tf + 8m), where m = 25 + (75 n N) div L, n is its number of terms, N
    the documents with a term and L all their terms. Whole texts count. Null and empty texts score nothing and ask for
    nothing. Rows that repeat an id or a text are documents, and queries, of their own. Other columns are left out;
    empty tables give no rows. Queries are searched for in blocks of about `QUERY_TERMS` terms, of which the driver
    holds one at a time; every block reads the whole index."""
    index = build_index(docs, doc_id, text) if index is None else index
    asked = _asked(queries, item_id, query)
    total = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    blocks = asked.agg(F.max("block")).first()[0]
    found = []
    for block in range(0 if blocks is None or not total["terms"] else blocks + 1):
        mine = [(r["number"], Counter(map(bytes, r["terms"]))) for r in asked.where(F.col("block") == block).collect()]
        if not mine:
            continue
        df = _documents_of(index, sorted({t for _, c in mine for t in c}))
        weights = {t: math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df.get(t, 0) + 1))) for _, c in mine for t in c}
        found.append(stored(_best(index, _Queries([n for n, _ in mine], [c for _, c in mine], weights), total["docs"], total["terms"], k), "found"))
    kind = index.schema["ids"].dataType.elementType
    empty = T.StructType([T.StructField("number", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    rows = docs.sparkSession.createDataFrame([], empty)
    for part in found:
        rows = rows.unionByName(part)
    # The tasks' best are thinned out in parts before they meet.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("number", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= k)
    return rows.join(asked.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
