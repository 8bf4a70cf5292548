"""Mixing sources to target weights by capped water-filling.

Each source gets a share of a budget of words by weight, but at most `max_epochs` times its own size. Sources above
their cap are clamped and what they leave is shared again among the others by weight, until no source is above. A
source's target is then met by whole repetitions of all its documents and one fractional repetition: its documents in
a seeded random order, up to the words that are still due.

The fractional repetition needs no sort of documents: the place where a source's random order is cut is found digit by
digit of the order's key, each step one aggregate over (source, next digit). Documents are then taken or not by
comparing their key with the cut of their source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import quoted, running_total, unused, without
from millrace.session import stored

# The key of the random order has 60 bits, read in steps of 15.
DIGITS, DIGIT_BITS = 4, 15


def order_key(doc_id: Column, seed: int, text: Column | None = None) -> Column:
    """60 bits that order documents at random: the first 15 hex digits of md5("seed:doc_id:md5 of the text")."""
    content = [] if text is None else [F.coalesce(F.md5(text), F.lit(""))]
    whole = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), *content)
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("bigint")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add `target` to a table of sources (`source_size`, `weight`): the budget by weight, capped at `max_epochs` times
    the size. Batch; runs one small aggregate for each round of clamping.

    The targets sum up to the budget unless all sources are clamped. A size of 0 or a weight of 0 gets 0."""
    cap, level, held = F.col("source_size") * F.lit(max_epochs), None, None
    while True:
        clamped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(clamped, 1)).alias("clamped")).first()
        if not row["weights"]:
            return sources.withColumn("target", F.when(F.col("weight") > 0, cap).otherwise(0.0).cast("double"))
        # Clamped sources stay so; when none is added, the level is the last one.
        if row["clamped"] == held:
            return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))
        level, held = (budget - row["taken"]) / row["weights"], row["clamped"]


def source_targets(
    sized: DataFrame, weights: Sequence[int], budget_share: float, max_epochs: float
) -> DataFrame:
    """source, source_size and target of each source of `sized` (source, size); weights repeat along the sources by
    code point, null last. Batch; runs jobs."""
    sums = stored(sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
                  .withColumn("_last", F.col("source").isNull()), "sources")
    ranked = running_total(sums, ["_last", "source"], name="_rank")
    cycle = F.lit(list(weights))
    ranked = stored(ranked.select(
        "source", "source_size", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight")), "ranked")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    return stored(water_fill(ranked, budget_share * total, max_epochs).drop("weight"), "targets")


def mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[int] = (5, 2, 1),
    budget_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str | None = "text",
) -> DataFrame:
    """Add size, source_size, target and repeats (how often the mix takes the document) to `docs`. Batch; runs jobs.

    repeats is floor(target / source_size) or one more, never above `max_epochs` rounded up. The place of a document in
    the random order comes from its id and its text (its id alone without a text column), so documents that share an id
    are taken apart; rows that repeat both share their place and are taken alike. The words taken of a source are
    within half the size of one such place of its target. Null sources are a source of their own; null sizes count as
    0; an empty table stays empty. Columns of the added names, in upper or lower case, are replaced; others stay as they
    are. The result depends on the rows alone, not on their order or partitions."""
    size = F.coalesce(size, F.lit(0)).cast("bigint")
    key = order_key(quoted(doc_id), seed, None if text is None else quoted(text))
    rows = stored(docs.select(quoted(source).alias("source"), size.alias("size"), key.alias("key")), "sized")
    targets = source_targets(rows, weights, budget_share, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(rate).cast("bigint"))
    due = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint")
    # The cut of a source's order: all keys below `prefix`, and what is due at `prefix` itself.
    cuts = targets.select("source", due.alias("due"), F.lit(0).cast("bigint").alias("prefix")).where("due > 0")
    for step in range(1, DIGITS + 1):
        shift = (DIGITS - step) * DIGIT_BITS
        at = F.shiftright("key", shift + DIGIT_BITS) == F.col("prefix")
        named = cuts.withColumnRenamed("source", "_source")
        inside = rows.join(named, F.col("source").eqNullSafe(F.col("_source")) & at)
        digits = inside.groupBy("source", "due", F.shiftright("key", shift).alias("prefix")).agg(F.sum("size").alias("here"))
        # At most 2 ** DIGIT_BITS rows for a source.
        along = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        digits = digits.withColumn("before", F.coalesce(F.sum("here").over(along), F.lit(0)))
        digits = digits.where("before < due and before + here >= due")
        cuts = digits.select("source", (F.col("due") - F.col("before")).alias("due"), "prefix", "here")
    cuts = cuts.select(F.col("source").alias("_cut_source"), F.col("prefix").alias("cut"),
                       (F.col("due") * 2 >= F.col("here")).alias("with_cut"))
    kept = without(docs, "size", "source_size", "target", "repeats")
    named, total, goal, whole, cut, with_cut = unused(docs.columns, "mix_source", "mix_size", "mix_target", "mix_whole", "mix_cut", "mix_with_cut")
    plan = stored(targets.join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")), "left").select(
        F.col("source").alias(named), F.col("source_size").alias(total), F.col("target").alias(goal), F.col("whole").alias(whole),
        F.col("cut").alias(cut), F.col("with_cut").alias(with_cut)), "mix-plan")
    mixed = docs.join(plan, quoted(source).eqNullSafe(F.col(named)), "left")
    extra = (key < F.col(cut)) | ((key == F.col(cut)) & F.col(with_cut))
    repeats = F.col(whole) + F.coalesce(extra, F.lit(False)).cast("bigint")
    return mixed.select(*map(quoted, kept), size.alias("size"), F.col(total).alias("source_size"), F.col(goal).alias("target"), repeats.alias("repeats"))
