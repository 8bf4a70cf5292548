"""Splitting text into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column, pattern: str = "\\W+") -> Column:
    """Lower-case words of a text, split as on the JVM: a leading empty word stays, trailing empty
    ones go, and an empty text is one empty word."""

    def trimmed(parts: Column) -> Column:
        kept = F.filter(parts, lambda word: word != "")
        starts_empty = (F.get(parts, F.lit(0)) == "") & (F.size(kept) > 0)
        return F.when(starts_empty, F.concat(F.array(F.lit("")), kept)).otherwise(kept)

    # The lambda's variable holds the split text, which would be split again for each use otherwise.
    split = F.get(F.transform(F.array(F.split(F.lower(text), pattern)), trimmed), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(split)
