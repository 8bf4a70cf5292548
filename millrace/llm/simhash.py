"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits; bit b is 1 if it is 1 in over half of the hashes of a text's word shingles. Two fingerprints
with at most 4 differing bits, cut into only three segments, agree in the last segment or differ by at most one bit in
one of the first two (else they would differ in 1 + 2 + 2 bits). So each fingerprint is indexed by its segments as they
are and, for every bit of the first two, by the segment with that bit wiped out. Fingerprints that have the bit unset
meet, by one equality join, those that have it set; each meeting is verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, releasing, text_bytes
from millrace.llm.components import components
from millrace.session import stored

MAX_BITS, SHINGLE_WORDS, SEED = 4, 4, 42

# Segments (first bit, width); the last one is indexed as it is only.
SEGMENTS = ((0, 22), (22, 22), (44, 20))


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text: words between ASCII white space, A-Z lower-cased, shingles of `size` words with
    repeats (a shorter text is one shingle), XXH64 with seed 42. A text without words, or null, has fingerprint 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(joined, SEED)]
    else:
        starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[:-size], starts[size:])]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_hash (of the whole text, null for null) and bits (the fingerprint as a signed number)."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("text_hash"),
                        F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t) for t in text_bytes(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(bits)],
                                             names=["doc_id", "text_hash", "bits"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(releasing(run), f"doc_id {kind}, text_hash bigint, bits bigint")


def _variants(bits: Column, with_bit: int) -> Column:
    """Keys of a fingerprint: which segment or wiped-out bit, and what is left of the segment."""
    plain = [_key(n, F.shiftrightunsigned(bits, first).bitwiseAND((1 << width) - 1)) for n, (first, width) in enumerate(SEGMENTS)]
    wiped = [F.when(F.shiftrightunsigned(bits, first + p).bitwiseAND(1) == with_bit,
                    _key(len(SEGMENTS) + first + p, F.shiftrightunsigned(bits, first).bitwiseAND((1 << width) - 1 - (1 << p))))
             for first, width in SEGMENTS[:-1] for p in range(width)]
    return F.array_compact(F.array(*plain, *wiped))


def _key(tag: int, rest: Column) -> Column:
    return rest + F.lit(tag << 22)


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a, b of the different fingerprints (column bits) that differ in 1 to `max_bits` (at most 4) bits. A pair
    can come out more than once. Pairs of equal fingerprints, and pairs beyond `max_bits`, never leave the join, whose
    hot keys adaptive execution splits; of different fingerprints that are all within reach of each other, every pair does."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the segments find differences of at most {MAX_BITS} bits")
    left = distinct.select(F.col("bits").alias("a"), F.explode(_variants(F.col("bits"), 0)).alias("key"))
    right = distinct.select(F.col("bits").alias("b"), F.explode(_variants(F.col("bits"), 1)).alias("key"))
    wiped = F.col("key") >= len(SEGMENTS) << 22
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right, "key").where(near & (wiped | (F.col("a") < F.col("b")))).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links) and kept for
    each row of `docs`. Batch; runs jobs.

    Equal fingerprints are one node, however many rows have them. kept is true for the document that stays for its
    group: the one with the smallest doc_id and, among repeated ids, the smallest text hash; rows that repeat both stay
    alike. Null and empty texts have fingerprint 0 and are linked like others. A null doc_id is the smallest of its
    group only if all are null. Other columns are left out; an empty table gives no rows."""
    prints = stored(fingerprints(docs, text, doc_id), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    classes = stored(prints.groupBy("bits").agg(first), "fingerprint-classes")
    roots = components(near_links(classes.select("bits"), max_bits))
    labelled = classes.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    labelled = stored(labelled.withColumn("root", F.coalesce("root", "bits")), "labelled-fingerprints")
    least = stored(labelled.groupBy("root").agg(F.min("first").alias("first")), "component-firsts")
    by_bits = stored(labelled.select("bits", "root").join(least, "root").select(
        "bits", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("component_hash")), "components")
    out = prints.join(by_bits, "bits")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("text_hash").eqNullSafe(F.col("component_hash"))
    return out.select("doc_id", "text_hash", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id",
                      kept.alias("kept"))
