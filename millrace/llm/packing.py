"""Best-fit packing of documents into token sequences by exact-complement hashing.

What matters for packing is only how many pieces there are of each length, and lengths are bounded by the capacity. So
the plan is made from the counts: the longest length that is left is completed by one, two or three others that fill
its gap exactly, found in an index of the sums of lengths still available, and the combination is used as often as the
counts allow. Where nothing fills a gap exactly, the best fit is taken. Pieces then find their place in the plan by
their rank among the pieces of their length: each Spark task numbers its own pieces, and the numbers of the tasks
before it are added.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, releasing
from millrace.llm.tokens import encoded
from millrace.session import stored

CAPACITY = 2048


def piece_bounds(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin and end: whole if it fits, else pieces of the capacity, the first one shorter."""
    if length <= capacity:
        return [0, length]
    first = length % capacity
    return ([0] if first else []) + list(range(first, length + 1, capacity))


class SumIndex:
    """Which sums one, two or three of the lengths still available make."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.have = counts, counts > 0
        self.capacity = len(counts) - 1
        # pairs[s]: how many ordered pairs of available lengths sum up to s.
        self.pairs = np.zeros(2 * len(counts), np.int64)
        for length in np.flatnonzero(self.have):
            self.pairs[length : length + len(counts)] += self.have

    def use(self, lengths: Sequence[int], times: int) -> None:
        for length in lengths:
            self.counts[length] -= times
        for length in set(lengths):
            if not self.counts[length]:
                partners = np.flatnonzero(self.have)
                np.subtract.at(self.pairs, partners + length, 2)
                self.pairs[2 * length] += 1
                self.have[length] = False

    def _enough(self, lengths: Sequence[int]) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def fill(self, gap: int, beside: int) -> list[int] | None:
        """One, two or three available lengths that sum up to the gap beside a piece of length `beside`, longest first."""
        if gap > 0 and self.have[gap] and self._enough([beside, gap]):
            return [gap]
        return self._pair(gap, [beside]) or self._triple(gap, beside)

    def _pair(self, gap: int, beside: list[int]) -> list[int] | None:
        if gap < 2 or not self.pairs[gap]:
            return None
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in longer[self.have[longer] & self.have[gap - longer]].tolist():
            if self._enough([*beside, a, gap - a]):
                return [a, gap - a]
        return None

    def _triple(self, gap: int, beside: int) -> list[int] | None:
        if gap < 3:
            return None
        longest = np.arange(gap - 2, 0, -1)
        for a in longest[self.have[longest] & (self.pairs[gap - longest] > 0)].tolist():
            pair = self._pair(gap - a, [beside, a]) if self._enough([beside, a]) else None
            if pair:
                return [a, *pair]
        return None


def plan_sequences(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns (lengths in one sequence) and how often each is used, for counts[length] pieces of each length up to the
    capacity, len(counts) - 1. A pattern is used until it takes more of some length than is left, so there are few times as
    many patterns as lengths at most, however many pieces there are."""
    counts = counts.copy()
    index, capacity, plan = SumIndex(counts), len(counts) - 1, []
    while True:
        left = np.flatnonzero(counts)
        if not len(left):
            return plan
        pattern = [int(left[-1])]
        gap = capacity - pattern[0]
        filling = index.fill(gap, pattern[0]) if gap else None
        if filling:
            pattern += filling
        elif gap:
            # Best fit: the longest piece that goes in, again and again; the last gap may still be filled exactly.
            while gap and (fits := [x for x in left[left <= gap][::-1].tolist() if counts[x] > pattern.count(x)]):
                pattern.append(fits[0])
                gap -= fits[0]
        times = int(min(counts[x] // pattern.count(x) for x in set(pattern)))
        index.use(pattern, times)
        plan.append((pattern, times))


def places(plan: list[tuple[list[int], int]], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset): ranks from there on go to consecutive sequences."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each document's ids; nothing is shuffled. Null and
    empty texts are one piece, the end id. _part and _rank number the pieces of a length inside a task."""
    kind = docs.schema[doc_id].dataType.simpleString()
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("_part", pa.int32()), ("_rank", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, at = [], []
            for n, ids in enumerate(encoded(batch.column("text"), tokenizer)):
                bounds, data = piece_bounds(len(ids), capacity), ids.astype("<u4")
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    rows.append((k, a, b - a, zlib.crc32(data[a:b].tobytes()), part, int(seen[b - a])))
                    at.append(n)
                    seen[b - a] += 1
            if rows:
                more = batch_of(fields, list(zip(*rows)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *more.columns],
                                                 names=["doc_id", *(n for n, _ in fields)])

    return plain.mapInArrow(
        releasing(run), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _part int, _rank bigint")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece. Batch; runs jobs.

    Sequences are numbered from 0 without gaps, and pieces fill a sequence from offset 0 without gaps. Rows are
    documents of their own, also where they repeat an id or a text; an empty table gives no rows. The driver holds one
    count for each length and the plan, which are bounded by the capacity."""
    pieces = stored(cut_pieces(docs, tokenizer, capacity, text, doc_id), "pieces")
    sums = stored(pieces.groupBy("length", "_part").count(), "length-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in sums.groupBy("length").agg(F.sum("count").alias("n")).collect():
        counts[r["length"]] = r["n"]
    table = places(plan_sequences(counts), capacity)

    # For each length, one row for each task.
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("length", "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_base"))
    ranked = pieces.join(bases, ["length", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    kept = ranked.columns[:-1]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                first, to, place = table[length].T
                row = np.searchsorted(first, ranks[at], side="right") - 1
                sequence[at], offset[at] = to[row] + ranks[at] - first[row], place[row]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return ranked.mapInArrow(releasing(settle), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                     "sequence_id bigint, offset bigint")
