"""Language identification by compression.

For each language a bounded sample of labelled text becomes a raw-content dictionary of zstandard. A text is cut into
blocks, each block is compressed with every dictionary, and the language whose dictionary gives the fewest bytes in
all wins. The margin to the runner-up is the score; a narrow margin rejects the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, forget_worker_state, quoted, releasing, with_fields, without

# Bounds of the training sample of one language: documents, code points of each, and bytes of the dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 1500, 64_000

# A text is compressed in blocks of so many bytes, so that the dictionary and not the text itself explains a block.
BLOCK_BYTES = 4096

# Settings of zstandard, the same for texts of any length: short ones have few matches, which a thorough search finds.
LEVEL = 5
SEARCH = {"min_match": 3, "hash_log": 17, "chain_log": 18, "search_log": 5, "strategy": 6, "target_length": 32}

# Least advantage over the runner-up, as a share of its bytes.
MIN_MARGIN = 0.002

UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether a text has a letter: digits, fractions and number signs are none."""
    return any(map(str.isalpha, text))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """A fixed quarter of the documents; a null doc_id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """A dictionary for each language, out of a bounded sample: the SAMPLE_DOCS labelled documents with the smallest
    hash of their id, SAMPLE_CHARS code points of each, DICTIONARY_BYTES in all. Batch; runs two jobs, and up to two
    more for languages whose ids are null or repeated, so that too few different hashes are found: there the hash
    takes in the text, and at last every row is looked at.

    Rows with a null text or label teach nothing; without any, there is no language. The driver holds the sample."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["n"] for r in known.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # About twice the wanted number pass by their key alone; the exact choice is made among those.
    bounds = {l: int((1 << 62) * min(1.0, (2 * SAMPLE_DOCS + 100) / n)) for l, n in counts.items()}
    bound = F.create_map(*[F.lit(x) for l, b in bounds.items() for x in (l, b)])
    texts: dict[str, list[str]] = {}
    wanted = sorted(counts)
    for hashed, bounded in (([doc_id], True), ([doc_id, text], True), ([doc_id, text], False)):
        key = F.xxhash64(*hashed, F.lit("sample")).bitwiseAND((1 << 62) - 1)
        near = known if len(wanted) == len(counts) else known.where(F.col(lang).isin(wanted))
        near = near.where(key <= F.try_element_at(bound, F.col(lang))) if bounded else near
        near = near.select(F.col(lang).alias("lang"), key.alias("key"), F.substring(F.col(text), 1, SAMPLE_CHARS).alias("text"))
        # Each task hands on no more than SAMPLE_DOCS rows of a language.
        order = Window.partitionBy("lang").orderBy("key", "text")
        sample = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
        found: dict[str, list[str]] = {}
        keys: dict[str, set[int]] = {}
        for row in sorted(sample.select("lang", "n", "key", "text").collect()):
            found.setdefault(row["lang"], []).append(row["text"])
            keys.setdefault(row["lang"], set()).add(row["key"])
        texts.update(found)
        # A language of no more than SAMPLE_DOCS rows is taken whole.
        wanted = [l for l in wanted if len(keys.get(l, ())) < SAMPLE_DOCS < counts[l]]
        if not wanted:
            break
    return {l: "\n".join(t).lower().encode()[:DICTIONARY_BYTES] for l, t in texts.items()}


class Classifier:
    """Compressors of the known languages."""

    def __init__(self, dictionaries: Mapping[str, bytes]):
        import zstandard

        def compressor(words: bytes):
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=DICTIONARY_BYTES, source_size=BLOCK_BYTES, write_content_size=False, write_checksum=False,
                write_dict_id=False, **SEARCH)
            known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(compression_params=settings, dict_data=known)

        langs = sorted(l for l, words in dictionaries.items() if words)
        self.compressors = {l: compressor(dictionaries[l]) for l in langs}

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and margin; the first language by name wins a tie, with margin 0."""
        if text is None or not self.compressors or not has_letter(text):
            return UNKNOWN, 0.0
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.compressors.items())
        (best, lang), second = sizes[0], sizes[min(1, len(sizes) - 1)][0]
        return lang, (second - best) / second if len(sizes) > 1 else 1.0


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Add lang_pred, score (margin to the runner-up, 0 to 1) and rejected (margin below `min_margin`) to `docs`.

    A text that is null or has no letter is `und` with score 0 and rejected, as is every text if no language is known.
    Texts are judged whole, by their content alone. Columns of these names, in upper or lower case, are replaced. The bytes of `dictionaries`
    are bounded by DICTIONARY_BYTES for each language and travel with the function."""
    kept = without(docs, "lang_pred", "score", "rejected")
    plain = docs.select(*map(quoted, kept))
    known, floor = dict(dictionaries), min_margin
    added = [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        classifier = Classifier(known)
        for batch in batches:
            found = [classifier.classify(t.as_py()) for t in batch.column(text)]
            langs, scores = [l for l, _ in found], [s for _, s in found]
            more = batch_of(added, [langs, scores, [s < floor or l == UNKNOWN for l, s in found]])
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.columns], names=[*kept, *(n for n, _ in added)])

    return plain.mapInArrow(releasing(run), with_fields(plain.schema, "lang_pred string, score double, rejected boolean"))
