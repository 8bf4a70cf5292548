"""Row-wise operators: projection, filters, flat-map, tombstones and headers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.envelope import put_headers


def map_values(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Change the value, keep the key."""
    return df.withColumn("value", change(F.col("value")))


def rekey(df: DataFrame, key: Column, value: Column | None = None) -> DataFrame:
    """Change the key (and value). Spark shuffles later, and only if something needs it."""
    return df.withColumns({"key": key, "value": F.col("value") if value is None else value})


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition)


def flat_map_words(df: DataFrame, text: Column, pattern: str = "\\W+", name: str = "word") -> DataFrame:
    """One row for each word of a text, as `millrace.functions.text.words` splits it.

    The text is split once and empty words are judged row by row: only a leading one can stay, in an
    empty text or before some word."""
    first_stays = (text == "") | (F.regexp_replace(text, pattern, "") != "")
    split = df.select("*", F.posexplode(F.split(F.lower(text), pattern)).alias("_at", "_word"))
    kept = split.filter((F.col("_word") != "") | ((F.col("_at") == 0) & first_stays))
    return kept.withColumn(name, F.col("_word")).drop("_at", "_word")


def drop_tombstones(df: DataFrame) -> DataFrame:
    """What an input sees if the framework decodes: rows without payload are skipped."""
    return df.filter(F.col("value").isNotNull())


def pass_tombstones(df: DataFrame, convert: Callable[[Column], Column]) -> DataFrame:
    """Convert the values and let null ones through untouched, in one pass."""
    value = F.col("value")
    return df.withColumn("value", F.when(value.isNotNull(), convert(value)))


def enrich_headers(df: DataFrame, entries: Mapping[str, Column | str | int]) -> DataFrame:
    return df.withColumn("headers", put_headers(entries))


def observe(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Tap the rows that pass: metrics are gathered while the frame is computed."""
    seen = Observation(name)
    return df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), seen
