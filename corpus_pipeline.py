"""From raw documents to packed training sequences: language, near-duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Rows
with nulls, empty texts, ties and repeated rows are treated as the operators' docstrings say; empty tables stay empty.
Stages with Python bound the session's Arrow batches (`bounded_batches`), which changes no results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, mixing, packing, similar, substrings
from millrace.llm.common import bounded_batches, quoted, unused, without, word_count
from millrace.llm.queries import MIX_SEED, table, tokenizer_path
from millrace.session import stored


def _apart(docs: DataFrame, *needed: str) -> tuple[DataFrame, str]:
    """The columns an operator needs, and all others of `docs` in one struct; also its name. Whatever columns the
    operator adds or replaces, the user's are inside the struct."""
    whole = unused(docs.columns, "whole_row")[0]
    return docs.select(*needed, F.struct(*map(quoted, without(docs, *needed))).alias(whole)), whole


def _back(rows: DataFrame, whole: str, docs: DataFrame, *needed: str, **changed: Column) -> DataFrame:
    """The columns of `docs` again, some of them changed."""
    return rows.select(*[changed[c] if c in changed else F.col(c) if c in needed else F.col(whole).getField(c) for c in docs.columns]).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is not clear: no text, no letter, or a narrow margin. The classifier is learned
    from the labelled documents outside the held-out quarter. Other columns stay as they are."""
    bounded_batches(spark)
    known = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    rows, whole = _apart(docs, "text")
    return _back(language.identify(rows, known).where("not rejected"), whole, docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest doc_id. Of rows that repeat id and
    text, the first by source and language stays, with its other columns.

    Near are texts whose sets of five-word shingles have a similarity of 0.8 or more: found by SimHash signatures with
    one bit wiped out, with a recall of 0.93 or more, and checked by their shingles."""
    bounded_batches(spark)
    whole, none, ident, same = names = unused(docs.columns, "whole_row", "no_id", "id_or_0", "same_text")
    id_of = F.coalesce(F.col("doc_id"), F.lit(0).cast(docs.schema["doc_id"].dataType))
    keys = [F.col("doc_id").isNull().alias(none), id_of.alias(ident)]
    kept = similar.similar_documents(docs).where("kept").select(*keys, F.coalesce("text_hash", F.lit(0)).alias(same)).distinct()
    content = F.coalesce(F.when(F.col("text").isNotNull(), F.xxhash64("text")), F.lit(0))
    rows = docs.select(*keys, content.alias(same), F.struct(*map(quoted, docs.columns)).alias(whole))
    # Rows that repeat id and text are reduced in the tasks before they meet.
    order = F.struct(*[x for c in ("source", "lang") for x in (F.col(whole)[c].isNull(), F.col(whole)[c])])
    one = rows.groupBy(*names[1:]).agg(F.min_by(whole, order).alias(whole))
    return one.join(kept, names[1:]).select(f"{whole}.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words of passages that already stand in an earlier document; every document stays, if with less text.
    Columns besides text and n_chars stay as they are."""
    bounded_batches(spark)
    rows, whole = _apart(docs, "doc_id", "text")
    kept = F.col("kept_text")
    return _back(substrings.remove_repeats(rows), whole, docs, "doc_id", text=kept, n_chars=F.length(kept).cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come near their target weights; a document that the mix takes
    twice is there twice. Other columns stay as they are."""
    rows, whole = _apart(docs, "doc_id", "source", "text")
    mixed = mixing.mix(rows, word_count(F.col("text")), seed=MIX_SEED).where("repeats > 0")
    return _back(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))), whole, docs, "doc_id", "source", "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and the sequences they are packed into."""
    bounded_batches(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("passages", drop_repeated_passages),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

# Compression and seeded fingerprints are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each result written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
