"""SimHash near-duplicates down to a similarity, verified exactly.

As `simhash`, by deletion variants, but for texts whose word shingles have at least a given Jaccard similarity. Two such
texts differ in about the share arccos(2J / (1 + J)) / pi of a fingerprint's bits, so a segment of some bits differs in at
most one of them with a probability that is known, and so many segments are taken that a pair at the similarity itself
agrees that way in one of them with the recall asked for. Every fingerprint is indexed by each segment with each of its
bits wiped out; texts that meet under a key, and whose remaining 64 bits are near as well, are compared by their shingles.

Keys are exchanged as arrays, dealt by hash. Texts that are equal in a segment share all its keys, and meet under the
first of them; texts that differ in a bit there meet under the key without it. At first only the first text of a key is compared with its others, so the
pairs to verify are fewer than the keys. Texts that may still be near another one meet again with what hangs together by
then, and only pairs from different components are compared, each under one of the keys it shares. A key that many texts
share (more than `group`, in a batch or in all) is not held by a task: its texts are dealt into blocks, and each two blocks are
compared in one place, prints first and then shingles, which only links leave. So no pair that meets under a key goes unseen,
unless it hangs together anyway.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, forget_worker_state, quoted, release, releasing, running_total, text_bytes
from millrace.llm.components import components
from millrace.session import stored

SHINGLE_WORDS, SIMILARITY, RECALL, SEED = 5, 0.8, 0.93, 42

# Texts of one key that are compared pair by pair; nodes whose keys are made at once; index bytes of a task, about.
GROUP, NODES_AT_ONCE, TASK_BYTES = 64, 1024, 4 << 20

# Texts in a block of a hot key, about, of which a task holds two; shingles that a task remembers of the texts it compares.
BLOCK, REMEMBERED = 512, 1 << 21

_PAIR = [("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """A fingerprint of `segments` segments of `width` bits and 64 bits more, of which near ones differ in `reach`, and of
    all bits in `whole_reach`; a task compares so many texts of one key pair by pair."""

    width: int
    segments: int
    reach: int
    whole_reach: int
    group: int = GROUP

    @property
    def words(self) -> int:
        return -(-self.width * self.segments // 64) + 1


def layout(rows: int, similarity: float = SIMILARITY, recall: float = RECALL, group: int = GROUP) -> Layout:
    """Segments wide enough that few of so many texts meet by chance, and as many as the recall asks for."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    width = min(28, max(16, math.ceil(math.log2(max(rows, 1))) - 2))
    meets = (1 - share) ** width + width * share * (1 - share) ** (width - 1)
    segments = math.ceil(math.log(1 - recall) / math.log(1 - meets)) if meets < 1 else 1

    def reach(bits: int) -> int:
        return int(bits * share + 2.6 * math.sqrt(bits * share * (1 - share)))

    return Layout(width, segments, reach(64), reach(64 * (-(-width * segments // 64) + 1)), group)


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or b"").lower().split()


def shingles(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the different shingles of `size` words, sorted; fewer words are one shingle, none none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    return np.unique(np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts[:-size], starts[size:])], np.uint64))


def wide_print(hashes: np.ndarray, words: int) -> bytes:
    """SimHash of so many 64-bit words: a bit is 1 if it is in over half of the shingles' hashes."""
    ones = np.zeros((8 * words, 256), np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        for j in range(words):
            x = block + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            octets = (x ^ (x >> np.uint64(31))).astype("<u8").view(np.uint8).reshape(-1, 8)
            places = octets.astype(np.int64) + 256 * np.arange(8)
            ones[8 * j : 8 * j + 8] += np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    return np.packbits((ones @ _BYTE_BITS).ravel() * 2 > len(hashes), bitorder="little").tobytes()


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _content(docs: DataFrame, text: str, doc_id: str, layout: Layout, size: int) -> DataFrame:
    """doc_id, text_hash, h1 and h2 (of the words) and print of each row."""
    plain = docs.select(quoted(doc_id).alias("doc_id"), F.when(quoted(text).isNotNull(), F.xxhash64(quoted(text))).alias("text_hash"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        for batch in batches:
            hashes, prints = [], []
            for raw in text_bytes(batch.column("text")):
                words = words_of(raw)
                hashes.append(xxhash.xxh128_digest(b" ".join(words)))
                prints.append(wide_print(shingles(words, size), layout.words))
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(prints, pa.binary())],
                                             names=["doc_id", "text_hash", "h1", "h2", "print"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(releasing(run), f"doc_id {kind}, text_hash bigint, h1 bigint, h2 bigint, print binary")


def keys_of(prints: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Of prints (rows of bytes), the keys (a column for each segment and wiped bit) and the 64 bits besides."""
    return _wiped(_whole_keys(prints, layout), layout), np.ascontiguousarray(prints[:, -8:]).view("<i8").ravel()


def _whole_keys(prints: np.ndarray, layout: Layout) -> np.ndarray:
    """The keys of prints with the bit in its place that a key wipes out."""
    bits = np.unpackbits(prints, axis=1, bitorder="little")
    powers = (1 << np.arange(layout.width, dtype=np.int64))
    columns = []
    for s in range(layout.segments):
        segment = bits[:, s * layout.width : (s + 1) * layout.width] @ powers
        for p in range(layout.width):
            columns.append(segment | (s * layout.width + p) << layout.width)
    return np.stack(columns, axis=1)


def _wiped(whole: np.ndarray, layout: Layout) -> np.ndarray:
    return whole & ~(1 << (whole >> layout.width) % layout.width)


def _meet_here(a: np.ndarray, b: np.ndarray, layout: Layout) -> np.ndarray:
    """Of two whole keys that are equal when wiped, whether texts meet under this one of the keys they share in its
    segment: the only one if they differ in the bit, else the segment's first."""
    return (a != b) | ((a >> layout.width) % layout.width == 0)


def _grouped(keys: np.ndarray, hot: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: where groups start, and which of them are hot: too large, or with a row that says so."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    return starts, (sizes > most) | (np.logical_or.reduceat(hot, starts) if len(keys) else np.zeros(0, bool))


def _near(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= reach


def _deal(batches: Iterator[pa.RecordBatch], layout: Layout, tasks: int) -> Iterator[pa.RecordBatch]:
    """Arrays of (whole key, node, sketch, hot) for each task. Of keys that are hot here only the first node goes on; all
    their rows are dealt evenly besides, each with that first node if they meet here and are near, else itself, as its
    leader."""
    names = ["part", "keys", "nodes", "sketches", "hot", "leaders"]
    for whole in batches:
        for at in range(0, whole.num_rows, NODES_AT_ONCE):
            batch = whole.slice(at, NODES_AT_ONCE)
            prints = np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            table, sketch = _whole_keys(prints, layout), np.ascontiguousarray(prints[:, -8:]).view("<i8").ravel()
            whole_keys, nodes = table.ravel(), np.repeat(batch.column("node").to_numpy(), table.shape[1])
            keys, sketches = _wiped(whole_keys, layout), np.repeat(sketch, table.shape[1])
            order = np.lexsort((nodes, keys))
            whole_keys, keys, nodes, sketches = whole_keys[order], keys[order], nodes[order], sketches[order]
            starts, hot = _grouped(keys, np.zeros(len(keys), bool), layout.group)
            first = np.zeros(len(keys), bool)
            first[starts] = True
            hot_row = np.repeat(hot, np.diff(np.append(starts, len(keys))))
            stay = ~hot_row | first
            leader = np.repeat(starts, np.diff(np.append(starts, len(keys))))
            led = _near(sketches, sketches[leader], layout.reach) & _meet_here(whole_keys, whole_keys[leader], layout)
            leader = np.where(led, nodes[leader], nodes)
            rows = []
            for chosen, dealt_by in ((np.flatnonzero(stay), keys), (np.flatnonzero(hot_row), nodes)):
                part = (dealt_by * 0x9E3779B97F4A7C1 >> 20) % tasks
                chosen = chosen[np.argsort(part[chosen], kind="stable")]
                ends = np.flatnonzero(np.diff(part[chosen], append=tasks + 1)) + 1
                for lo, hi in zip([0, *ends[:-1]], ends) if len(chosen) else ():
                    c = chosen[lo:hi]
                    rows.append((int(part[c[0]]), whole_keys[c].astype("<u4" if _short(layout) else "<i8").tobytes(), nodes[c].astype("<i8").tobytes(),
                                 sketches[c].astype("<i8").tobytes(), np.packbits(hot_row[c]).tobytes(), None if dealt_by is keys else leader[c].tobytes()))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _short(layout: Layout) -> bool:
    return layout.width + (layout.width * layout.segments).bit_length() <= 32


def _pairs_of(group: pa.Table, layout: Layout) -> pa.Table:
    """Near pairs (a < b, key null) of the first node of each key, nodes with other near pairs only (a = b), and the rows
    of hot keys (b null). Nodes that share several keys of a segment are paired or marked under one of them."""
    through = np.array([b is not None for b in group.column("leaders").to_pylist()], bool)

    def joined(name: str, chosen: np.ndarray, kind: str) -> np.ndarray:
        blobs = group.column(name).to_pylist()
        return np.frombuffer(b"".join(blobs[i] for i in np.flatnonzero(chosen)), kind)

    def parts(chosen: np.ndarray) -> list[np.ndarray]:
        keys = joined("keys", chosen, "<u4" if _short(layout) else "<i8").astype(np.int64)
        return [keys, joined("nodes", chosen, "<i8"), joined("sketches", chosen, "<i8")]

    whole_keys, nodes, sketches = parts(~through)
    keys = _wiped(whole_keys, layout)
    sizes = [len(b) // 8 for b in group.column("nodes").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n, t in zip(group.column("hot").to_pylist(), sizes, through) if not t]
    marked = np.concatenate(flags) if flags else np.zeros(0, bool)
    order = np.lexsort((nodes, keys))
    whole_keys, keys, nodes, sketches, marked = whole_keys[order], keys[order], nodes[order], sketches[order], marked[order]
    starts, hot = _grouped(keys, marked, layout.group)
    lengths = np.diff(np.append(starts, len(keys)))
    hot_row = np.repeat(hot, lengths)
    # Of a key, its first node with each of the others.
    first, every = np.repeat(starts, lengths), np.arange(len(keys))
    by_first = (first != every) & _near(sketches[first], sketches, layout.reach)
    led = by_first & _meet_here(whole_keys[first], whole_keys, layout)
    # Nodes that are near others besides are marked by a pair with themselves, if no other row here names them. Those near
    # the first one are named where they meet it.
    open_nodes, at = [], np.flatnonzero(~hot_row & (first != every))
    for d in range(1, layout.group):
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        if not len(at):
            break
        near = at[_near(sketches[at], sketches[at + d], layout.reach) & _meet_here(whole_keys[at], whole_keys[at + d], layout)]
        open_nodes += [nodes[x[~by_first[x]]] for x in (near, near + d)]
    alone = np.concatenate(open_nodes) if open_nodes else np.zeros(0, np.int64)
    more, leaders = parts(through), joined("leaders", through, "<i8")
    more[0] = _wiped(more[0], layout)
    apart = leaders != more[1]
    # Marked nodes are among the rows of the batches already.
    rows = [np.concatenate([x[hot_row & ~marked], y]) for x, y in zip((keys, nodes), more)]
    both = np.stack([np.concatenate([nodes[first[led]], leaders[apart]]), np.concatenate([nodes[led], more[1][apart]])], axis=1)
    alone = np.setdiff1d(alone, np.concatenate([both.ravel(), rows[1]]))
    pairs = np.unique(np.concatenate([np.sort(both, axis=1), np.stack([alone, alone], axis=1)]), axis=0)
    n, m = len(pairs), len(rows[0])
    none = lambda k: pa.nulls(k, pa.int64())
    return pa.table({"key": pa.chunked_array([none(n), pa.array(rows[0])]), "a": np.concatenate([pairs[:, 0], rows[1]]),
                     "b": pa.chunked_array([pa.array(pairs[:, 1]), none(m)])}, schema=pa.schema(_PAIR))


def _deal_again(batches: Iterator[pa.RecordBatch], layout: Layout, tasks: int) -> Iterator[pa.RecordBatch]:
    """Arrays of (key, node, root, print) for each task; keys that are hot here are left out."""
    names = ["part", "keys", "nodes", "roots", "prints"]
    for whole in batches:
        for at in range(0, whole.num_rows, NODES_AT_ONCE // 4):
            batch = whole.slice(at, NODES_AT_ONCE // 4)
            prints = np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            table, _ = keys_of(prints, layout)
            keys, row = table.ravel(), np.repeat(np.arange(batch.num_rows), table.shape[1])
            order = np.argsort(keys, kind="stable")
            starts, hot = _grouped(keys[order], np.zeros(len(keys), bool), layout.group)
            order = order[~np.repeat(hot, np.diff(np.append(starts, len(keys))))]
            part = (keys * 0x9E3779B97F4A7C1 >> 20) % tasks
            order = order[np.argsort(part[order], kind="stable")]
            ends = np.flatnonzero(np.diff(part[order], append=tasks + 1)) + 1
            node, root = batch.column("node").to_numpy(), batch.column("root").to_numpy()
            rows = []
            for lo, hi in zip([0, *ends[:-1]], ends) if len(order) else ():
                c = order[lo:hi]
                rows.append((int(part[c[0]]), keys[c].astype("<u4" if _short(layout) else "<i8").tobytes(), node[row[c]].astype("<i8").tobytes(),
                             root[row[c]].astype("<i8").tobytes(), prints[row[c]].tobytes()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _first_shared(differ: np.ndarray, layout: Layout) -> np.ndarray:
    """Of pairs, given which bits differ: segment and wiped bit of the first key that each shares."""
    inside = differ[:, : layout.width * layout.segments].reshape(len(differ), layout.segments, layout.width)
    segment = (inside.sum(axis=2) <= 1).argmax(axis=1)
    # A pair that is equal in the segment shares all its keys there, of which the first counts.
    return segment * layout.width + inside[np.arange(len(differ)), segment].argmax(axis=1)


def _cross_pairs(group: pa.Table, layout: Layout) -> pa.Table:
    """Near pairs (a < b) of different components among the nodes of a task's keys, each under the first key it shares;
    keys with more than `group` nodes are left to the blocks of hot keys."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)

    keys, nodes, roots = joined("keys", "<u4" if _short(layout) else "<i8").astype(np.int64), joined("nodes", "<i8"), joined("roots", "<i8")
    prints = joined("prints", np.uint8).reshape(len(keys), -1)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts, hot = _grouped(keys, np.zeros(len(keys), bool), layout.group)
    at, found = np.flatnonzero(~np.repeat(hot, np.diff(np.append(starts, len(keys))))), []
    for d in range(1, layout.group):
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        if not len(at):
            break
        a, b = order[at], order[at + d]
        apart = roots[a] != roots[b]
        for lo in range(0, int(apart.sum()), 1 << 16):
            x, y, key = (v[apart][lo : lo + (1 << 16)] for v in (a, b, keys[at]))
            differ = np.unpackbits(prints[x] ^ prints[y], axis=1, bitorder="little")
            near = differ.sum(axis=1) <= layout.whole_reach
            x, y, key = x[near], y[near], key[near]
            mine = key >> layout.width == _first_shared(differ[near], layout)
            found.append(np.sort(np.stack([nodes[x[mine]], nodes[y[mine]]], axis=1), axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _opened(size: int) -> Callable[[int, pa.Scalar], np.ndarray]:
    """Shingles of a node out of its words; so many are remembered."""
    open_up = zstandard.ZstdDecompressor().decompress
    known: dict[int, np.ndarray] = {}
    held = 0

    def of(node: int, words: pa.Scalar) -> np.ndarray:
        nonlocal held
        if node not in known:
            if held > REMEMBERED:
                known.clear()
                held = 0
            known[node] = shingles(open_up(words.as_py()).split(), size)
            held += len(known[node])
        return known[node]

    return of


def _verified(pairs: DataFrame, packed: DataFrame, similarity: float, size: int) -> DataFrame:
    """The pairs (a, b) whose shingles are similar; packed has the words of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _opened(size)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            fine = [similarity_of(of(x, batch.column("words_a")[n]), of(y, batch.column("words_b")[n])) >= similarity for n, (x, y) in enumerate(zip(a, b))]
            at = np.flatnonzero(fine)
            yield batch_of([("a", pa.int64()), ("b", pa.int64())], [[a[i] for i in at], [b[i] for i in at]])

    left = packed.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = packed.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b").mapInArrow(releasing(run), "a bigint, b bigint")


def _packed(docs: DataFrame, nodes: DataFrame, text: str, doc_id: str) -> DataFrame:
    """node and its words, compressed, for nodes (node, doc_id, text_hash: one row that has its words)."""
    plain = docs.select(quoted(doc_id).alias("doc_id"), F.when(quoted(text).isNotNull(), F.xxhash64(quoted(text))).alias("text_hash"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            words = [shrink(b" ".join(words_of(t))) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(words, pa.binary())], names=["doc_id", "text_hash", "words"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    small = plain.mapInArrow(releasing(run), f"doc_id {kind}, text_hash bigint, words binary")
    asked = nodes.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    met = small.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash")))
    return stored(met.groupBy("node").agg(F.first("words").alias("words")), "packed-words")


def _block_links(group: pa.Table, layout: Layout, similarity: float, size: int) -> pa.Table:
    """Similar pairs (a < b) between two blocks of a hot key, or inside one: of different components, with near prints, and
    compared under the first key that they share."""
    key, low, high = (group.column(c)[0].as_py() for c in ("key", "low", "high"))
    nodes, roots, block = (group.column(c).to_numpy() for c in ("a", "root", "block"))
    prints = np.frombuffer(b"".join(group.column("print").to_pylist()), np.uint8).reshape(len(nodes), -1)
    bits, words, of = prints.view("<u8"), group.column("words"), _opened(size)
    one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found = []
    for n, x in enumerate(one.tolist()):
        y = two[n + 1 :] if low == high else two
        y = y[roots[y] != roots[x]]
        y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1) <= layout.whole_reach]
        y = y[_first_shared(np.unpackbits(prints[y] ^ prints[x], axis=1, bitorder="little"), layout) == key >> layout.width] if len(y) else y
        for m in y.tolist():
            if similarity_of(of(nodes[x], words[x]), of(nodes[m], words[m])) >= similarity:
                found.append(sorted((int(nodes[x]), int(nodes[m]))))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _hot_links(hot: DataFrame, rooted: DataFrame, packed: DataFrame, layout: Layout, similarity: float, size: int) -> DataFrame:
    """Similar pairs of nodes (node, root, print) that share a hot key and do not hang together yet.

    The comparisons under a key grow with the square of its nodes, its rows only with their number times its blocks: a node
    is dealt to each pair of blocks that has its own, and a pair of blocks is a group of its own. Pairs do not leave it."""
    known = rooted.join(packed, "node").withColumnRenamed("node", "a")
    placed = stored(hot.join(known, "a").select("key", "a", "root", "print", "words"), "hot-keys")
    sizes = placed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.min("root").alias("least"), F.max("root").alias("most"))
    sizes = stored(sizes.where("least != most").select("key", "blocks"), "hot-sizes")
    dealt = placed.join(sizes, "key")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "a", "root", "print", "block", "words")

    def links_of(group: pa.Table) -> pa.Table:
        return _block_links(group, layout, similarity, size)

    return dealt.groupBy("key", "low", "high").applyInArrow(links_of, "a bigint, b bigint")


def similar_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, recall: float = RECALL, size: int = SHINGLE_WORDS,
    group: int = GROUP,
) -> DataFrame:
    """doc_id, text_hash, component_id (smallest doc_id reachable by links) and kept for each row of `docs`. Batch; runs
    jobs.

    Texts are linked if their sets of shingles of `size` words have at least the similarity and they are found, as at
    least the share `recall` of those at the very similarity is, and more of those above. No others are linked. Texts
    with equal words are one node, however many rows have them; texts without words, null ones too, are alike. kept is
    as in `simhash.near_duplicates`: true for the smallest doc_id of a group and, among repeated ids, the smallest text
    hash; rows that repeat both are kept alike. Whole texts of any length count. A null doc_id is the smallest of its
    group only if all are null. Other columns are left out; an empty table gives no rows."""
    spark = docs.sparkSession
    shape = layout(docs.count(), similarity, recall, group)
    prints = stored(_content(docs, text, doc_id, shape, size), "wide-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    classes = prints.groupBy("h1", "h2").agg(first, F.first("print").alias("print"))
    classes = stored(running_total(classes, ["h1", "h2"], name="node"), "text-classes")

    index_bytes = classes.count() * shape.width * shape.segments * (20 if _short(shape) else 24)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), index_bytes // TASK_BYTES)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _deal(batches, shape, tasks)

    def pairs_of(group: pa.Table) -> pa.Table:
        try:
            return _pairs_of(group, shape)
        finally:
            release()

    dealt = classes.select("node", "print").mapInArrow(releasing(deal), "part int, keys binary, nodes binary, sketches binary, hot binary, leaders binary")
    found = stored(dealt.groupBy("part").applyInArrow(pairs_of, "key bigint, a bigint, b bigint"), "near-prints")
    near = stored(found.where("b is not null").select("a", "b").distinct(), "near-pairs")
    pairs, hot = near.where("a != b"), found.where("b is null")

    opened = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).unionByName(hot.select(F.col("a").alias("node"))).distinct()
    named = stored(classes.join(opened, "node").select("node", "first.doc_id", "first.text_hash", "print"), "open-nodes")
    packed = _packed(docs, named, text, doc_id)
    links = stored(_verified(pairs, packed, similarity, size), "similar-pairs")
    roots = components(links)

    def deal_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _deal_again(batches, shape, tasks)

    def cross_pairs(group: pa.Table) -> pa.Table:
        try:
            return _cross_pairs(group, shape)
        finally:
            release()

    rooted = named.select("node", "print").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "print")
    again = rooted.mapInArrow(releasing(deal_again), "part int, keys binary, nodes binary, roots binary, prints binary")
    more = again.groupBy("part").applyInArrow(cross_pairs, "a bigint, b bigint")
    more = stored(more.join(pairs, ["a", "b"], "left_anti"), "near-across")
    across = []
    if not more.isEmpty():
        across.append(stored(_verified(more, packed, similarity, size), "similar-across"))
    if not hot.isEmpty():
        across.append(stored(_hot_links(hot, rooted, packed, shape, similarity, size), "similar-hot"))
    if across:
        roots = components(reduce(DataFrame.unionByName, across, links))

    labelled = stored(classes.select("node", "h1", "h2", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled-texts")
    least = stored(labelled.groupBy("root").agg(F.min("first").alias("least")), "component-firsts")
    by_text = stored(labelled.join(least, "root").select("h1", "h2", F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("component_hash")), "components")
    out = prints.select("doc_id", "text_hash", "h1", "h2").join(by_text, ["h1", "h2"])
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("text_hash").eqNullSafe(F.col("component_hash"))
    return out.select("doc_id", "text_hash", "component_id", kept.alias("kept"))
