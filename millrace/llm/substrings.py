"""Removal of repeated passages by recompression.

A window of `window` words is a repeat if the same words already stand earlier. Comparing all windows would mean to move
every word's window; recompression leaves only few to move. In rounds, runs of one word and then pairs of neighbouring
symbols are renamed: a pair is joined if a bit of the left name is 1 and that of the right name is 0. Names are hashes of
what they stand for, so they agree in all documents without any exchange, and since a round only looks at a symbol's
neighbours, equal passages get equal symbols everywhere but near their ends. For each symbol the stretch of words that
decided it, its context, is kept; wherever a window holds the whole context, it holds the symbol.

One exchange of the contexts' names then tells which contexts occur more than once. A window that holds a context that
occurs only once cannot be a repeat. The few windows that are left, nearly all of them true repeats, are exchanged by
the hash of their words, and all but the first of each kind are repeats.

Exact copies of a whole text need none of this and are found first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import batch_of, quoted, releasing, text_bytes, with_fields, without
from millrace.session import stored

WINDOW_WORDS = 20

# Rounds of pairing, and most words of a symbol: on text whose words are mostly rare, four rounds leave a context of
# about ten words for every four words, short enough to lie inside most windows.
ROUNDS, SYMBOL_WORDS = 4, 8

# Words that are renamed at once.
CHUNK_WORDS = 200_000

# Sorts documents without an id last.
NO_ID = (1 << 63) - 1

_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(32)
    x *= _MIX
    return x ^ (x >> np.uint64(29))


class Passages:
    """Several documents' words in one array, and hashes of any stretch of them."""

    def __init__(self, documents: Sequence[list[bytes]], known: dict[bytes, int]):
        self.lengths = np.array([len(d) for d in documents], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.document = np.repeat(np.arange(len(documents)), self.lengths)
        n = int(self.lengths.sum())
        for d in documents:
            for word in d:
                if word not in known:
                    known[word] = xxhash.xxh3_64_intdigest(word)
        self.values = np.fromiter((known[w] for d in documents for w in d), np.uint64, n)
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def stretch(self, begin: np.ndarray, end: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
        """Hash of the words from `begin` up to `end`: a difference of prefix sums, shifted back to the origin."""
        if base not in self._sums:
            n = len(self.values)
            powers, inverse = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
            powers[1:] = np.multiply.accumulate(np.full(n, base, np.uint64))
            inverse[1:] = np.multiply.accumulate(np.full(n, pow(base, -1, 1 << 64), np.uint64))
            sums = np.zeros(n + 1, np.uint64)
            sums[1:] = np.cumsum(self.values * powers[:-1])
            self._sums[base] = sums, inverse
        sums, inverse = self._sums[base]
        return _mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))

    def contexts(self, window: int, rounds: int = ROUNDS, symbol_words: int = SYMBOL_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the contexts of the symbols after some rounds of recompression, as far as they lie inside
        a document and a window."""
        n, outside = len(self.values), len(self.values) + window + 1
        doc = self.document
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Runs: a word that differs from its neighbours depends on both; beyond a document's end nothing is known.
        head = np.ones(n, bool)
        head[1:] = (self.values[1:] != self.values[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(head)
        end = np.append(begin[1:], n)
        count = (end - begin).astype(np.uint64)
        name = np.where(count > 1, _mixed(self.values[begin] ^ (count * np.uint64(_BASES[0]))), self.values[begin])
        first = self.starts[doc[begin]]
        low = np.where(begin > first, begin - 1, -outside)
        high = np.where(end < first + self.lengths[doc[begin]], end + 1, outside)
        doc = doc[begin]
        for k in range(rounds):
            bit = (_mixed(name + np.uint64((k + 1) * _BASES[1] & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
            beside = doc[1:] == doc[:-1]
            joins = np.zeros(len(name), bool)
            joins[:-1] = bit[:-1] & ~bit[1:] & beside & (end[1:] - begin[:-1] <= symbol_words)
            joined = np.zeros(len(name), bool)
            joined[1:] = joins[:-1]
            # A symbol that stays alone does so because of its right neighbour if its bit is 1, else of its left one.
            right = np.append(np.where(beside, high[1:], outside), outside)
            left = np.append(-outside, np.where(beside, low[:-1], -outside))
            alone = ~joins & ~joined
            new_high = np.where(alone & bit, np.maximum(high, right), high)
            new_low = np.where(alone & ~bit, np.minimum(low, left), low)
            at = np.flatnonzero(joins)
            new_name, new_end = name.copy(), end.copy()
            new_name[at] = _mixed(name[at] * np.uint64(_BASES[0]) + _mixed(name[at + 1] + np.uint64(7)))
            new_end[at] = end[at + 1]
            new_low[at], new_high[at] = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
            name, begin, end, low, high, doc = (x[~joined] for x in (new_name, begin, new_end, new_low, new_high, doc))
        usable = (low >= 0) & (high <= n) & (high - low <= window)
        return low[usable], high[usable]

    def windows(self, window: int) -> np.ndarray:
        """Whether a window begins at each word."""
        return np.arange(len(self.values)) + window <= np.repeat(self.starts + self.lengths, self.lengths)

    def holding(self, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
        """Which windows, by their first word, hold one of these stretches."""
        edges = np.zeros(len(self.values) + 1, np.int32)
        np.add.at(edges, np.maximum(high - window, self.starts[self.document[low]]), 1)
        np.add.at(edges, low + 1, -1)
        return (np.cumsum(edges[:-1]) > 0) & self.windows(window)


def _chunks(texts: Iterable[bytes | None], window: int) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Rows and words of the texts that have a window, about CHUNK_WORDS words at a time."""
    rows, documents, total = [], [], 0
    for n, text in enumerate(texts):
        words = text.split() if text else []
        if len(words) < window:
            continue
        rows.append(n)
        documents.append(words)
        total += len(words)
        if total >= CHUNK_WORDS:
            yield rows, documents
            rows, documents, total = [], [], 0
    if rows:
        yield rows, documents


_KNOWN_WORDS = 250_000


def _repeated_contexts(docs: DataFrame, window: int) -> DataFrame:
    """content, place: contexts that occur at two different places or more (place packs first word and length), and
    place -1 for contents with a window that holds no context."""
    fields = [("key", pa.int64()), ("content", pa.int64()), ("packed", pa.int64())]

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            contents = batch.column("_content").to_numpy()
            for rows, documents in _chunks(text_bytes(batch.column("text")), window):
                # A copy in the same chunk adds nothing.
                once = np.unique(contents[rows], return_index=True)[1]
                rows, documents = [rows[i] for i in once], [documents[i] for i in once]
                if len(known) > _KNOWN_WORDS:
                    known.clear()
                passages = Passages(documents, known)
                low, high = passages.contexts(window)
                doc = passages.document[low]
                content = contents[rows][doc]
                place = (low - passages.starts[doc]) * 32 + (high - low)
                key = passages.stretch(low, high).view(np.int64)
                # Contexts that are repeated within the chunk are known to be; one of each stands for them outside.
                _, first, where, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                sure = times[where] > 1
                aside = sure.copy()
                aside[first] = False
                key[aside] = _mixed((content[aside] ^ place[aside]).view(np.uint64)).view(np.int64)
                bare = np.unique(passages.document[passages.windows(window) & ~passages.holding(low, high, window)])
                own = contents[rows][bare]
                place, sure = np.append(place, np.full(len(own), -1)), np.append(sure, np.ones(len(own), bool))
                yield batch_of(fields, [np.append(key, own), np.append(content, own), place * 2 + sure])

    # Narrow rows for the exchange; whether a context is sure to be repeated is the last bit of its place.
    named = docs.select("_content", "text").mapInArrow(releasing(name), "key bigint, content bigint, packed bigint").repartition("key")
    named = named.select("key", "content", F.shiftright("packed", 1).alias("place"), (F.col("packed") % 2 != 0).alias("sure"))
    # Copies of a content name the same places.
    once = named.groupBy("key", "content", "place").agg(F.max("sure").alias("sure"))
    along = Window.partitionBy("key").orderBy("content", "place")
    again = F.col("sure") | F.lag("key").over(along).isNotNull() | F.lead("key").over(along).isNotNull()
    return once.withColumn("again", again).where("again").select("content", "place")


def _candidate_windows(joined: DataFrame, text: str, window: int) -> DataFrame:
    """One row for each window that no context of its own rules out: the hash of its words and where it begins."""
    fields = [("key", pa.int64()), ("packed", pa.int64()), ("_order", pa.int64()), ("_content", pa.int64())]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            contents, orders = batch.column("_content").to_numpy(), batch.column("_order").to_numpy()
            places = batch.column("_places")
            for rows, documents in _chunks(_plain(batch.column(text)), window):
                if len(known) > _KNOWN_WORDS:
                    known.clear()
                passages = Passages(documents, known)
                low, high = passages.contexts(window)
                doc = passages.document[low]
                # Places are compared as (document, first word, length).
                place = low * 32 + (high - low)
                again = np.concatenate([
                    p[p >= 0] + s * 32 for p, s in ((np.asarray(places[r].values), s) for r, s in zip(rows, passages.starts))])
                once = ~np.isin(place, again)
                begin = np.flatnonzero(passages.windows(window) & ~passages.holding(low[once], high[once], window))
                doc = passages.document[begin]
                order, content = orders[rows][doc], contents[rows][doc]
                at = begin - passages.starts[doc]
                key = passages.stretch(begin, begin + window)
                tail = (passages.stretch(begin, begin + window, _BASES[1]) >> np.uint64(33)).astype(np.int64)
                # The first of equal windows in the chunk stands for them; the others are later for certain.
                rank = np.lexsort((at, content, order, tail, key))
                same = (key[rank][1:] == key[rank][:-1]) & (tail[rank][1:] == tail[rank][:-1])
                later = np.zeros(len(begin), bool)
                later[rank[1:][same]] = True
                repeated = np.zeros(len(begin), bool)  # the same place, out of a row that comes twice
                repeated[rank[1:]] = same & (order[rank][1:] == order[rank][:-1]) & (content[rank][1:] == content[rank][:-1]) \
                    & (at[rank][1:] == at[rank][:-1])
                key[later] = _mixed(content[later].view(np.uint64) + begin[later].astype(np.uint64))
                keep = ~repeated
                packed = tail << 32 | at << 1 | later
                yield batch_of(fields, [key.view(np.int64)[keep], packed[keep], order[keep], content[keep]])

    # Narrow rows for the exchange: a second hash, the first word, and whether the window is a repeat for certain.
    found = joined.mapInArrow(releasing(emit), "key bigint, packed bigint, _order bigint, _content bigint").repartition("key")
    return found.select("key", "_order", "_content", F.shiftright("packed", 32).cast("int").alias("tail"),
                        F.shiftright("packed", 1).bitwiseAND((1 << 31) - 1).cast("int").alias("begin"),
                        (F.col("packed") % 2 != 0).alias("later"))


def _compressed(docs: DataFrame, text: str) -> DataFrame:
    """The same rows with `text` as bytes compressed by zstandard, which are a third smaller in an exchange than what
    Spark makes of plain text. A null text stays null."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = pa.array([None if t is None else compress(t) for t in text_bytes(batch.column(text))], pa.binary())
            yield pa.RecordBatch.from_arrays([small if n == text else batch.column(n) for n in batch.schema.names],
                                             names=batch.schema.names)

    return docs.mapInArrow(releasing(run), schema)


def _plain(column: pa.Array) -> Iterator[bytes | None]:
    decompress = zstandard.ZstdDecompressor().decompress
    return (None if t is None else decompress(t) for t in text_bytes(column))


def kept_words(words: Sequence[bytes], begins: Sequence[int], window: int) -> np.ndarray:
    """Which words stay when the windows that begin at `begins` go."""
    edges = np.zeros(len(words) + 1, np.int32)
    begins = np.asarray(begins, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + window, -1)
    return np.cumsum(edges[:-1]) == 0


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW_WORDS) -> DataFrame:
    """Add n_words, n_removed and kept_text to `docs`, as `_cut` does to its columns doc_id and text. Batch; runs jobs.

    Columns of the added names, in upper or lower case, are replaced; others stay as they are."""
    added = ["n_words", "n_removed", "kept_text"]
    kept = without(docs, *added)
    others = [c for c in kept if c not in (text, doc_id)]
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"), *([F.struct(*map(quoted, others)).alias("others")] if others else []))
    of = {doc_id: F.col("doc_id"), text: F.col("text")}
    return _cut(rows, "text", "doc_id", window).select(*[(of[c] if c in of else F.col("others").getField(c)).alias(c) for c in kept], *added)


def _cut(docs: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """Add n_words, n_removed and kept_text to `docs`: the text without the words of each window of `window` words
    that also begins earlier (in a smaller doc_id, or before in the same document). Batch; runs jobs.

    kept_text is the text itself where nothing goes, else the words that stay, joined by one space. Words are parted by
    ASCII white space and compared as they are. A null text has no words and stays null; a null doc_id comes after all
    others; documents that share an id are ordered by a hash of their text, and rows that repeat id and text are one
    document, so they are cut alike. One task holds a text whole."""
    if not 1 <= window < 32:
        raise ValueError("window must have 1 to 31 words")
    added = ["n_words", "n_removed", "kept_text"]
    kept = [c for c in docs.columns if c not in added]
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("_order"),
                        F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("_content"), F.xxhash64(F.lit(1), F.col(text)).alias("_check"))
    contents = keyed.select("_order", "_content", "_check")
    firsts = stored(contents.groupBy("_content", "_check").agg(F.min("_order").alias("_first")), "first-contents")
    copies = contents.join(firsts, ["_content", "_check"]).where("_order > _first").select("_order", "_content").distinct()

    again = _repeated_contexts(keyed.select("_content", F.col(text).alias("text")), window)
    # As many places as one document has.
    again = again.groupBy(F.col("content").alias("_content")).agg(F.collect_list("place").alias("_places"))
    again = again.join(firsts, "_content").select(F.col("_first").alias("_order"), "_content", "_places")
    # With all columns, so that this join and the last one read the same exchange of the texts.
    every = [*[F.col(f"`{c}`") for c in kept], "_order", "_content"]
    texts = _compressed(keyed.select(*every), text)
    found = _candidate_windows(texts.join(again, ["_order", "_content"]).select(*every, "_places"), text, window)
    along = Window.partitionBy("key", "tail").orderBy("_order", "_content", "begin")
    later = found.withColumn("later", F.col("later") | (F.rank().over(along) > 1)).where("later")
    begins = later.groupBy("_order", "_content").agg(F.collect_set("begin").alias("_begins"))
    outcome = copies.select("_order", "_content", F.lit(None).cast("array<int>").alias("_begins"), F.lit(True).alias("_copy"))
    outcome = outcome.unionByName(begins.withColumn("_copy", F.lit(False)))
    cut = texts.join(outcome, ["_order", "_content"], "left").select(*every, "_begins", "_copy")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            texts, copied = list(_plain(batch.column(text))), batch.column("_copy").to_pylist()
            begins = batch.column("_begins")
            counts, gone, left = [], [], []
            for n, (data, copy) in enumerate(zip(texts, copied)):
                words = data.split() if data else []
                counts.append(len(words))
                if copy and len(words) >= window:
                    gone.append(len(words))
                    left.append(b"")
                elif copy is False:
                    stays = kept_words(words, np.asarray(begins[n].values), window)
                    gone.append(len(words) - int(stays.sum()))
                    left.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s]))
                else:
                    gone.append(0)
                    left.append(data)
            more = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())]
            same = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*same, *more], names=[*kept, *added])

    schema = with_fields(keyed.select(*every[:-2]).schema, "n_words bigint, n_removed bigint, kept_text string")
    return cut.mapInArrow(releasing(apply), schema)


def joined_words(text: Column) -> Column:
    """Words of a text joined by one space; a null text gives an empty one."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.trim(spaced)
