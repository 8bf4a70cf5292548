"""Consumer lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.log import LOG, positions


def lag(log: DataFrame | None, committed: DataFrame, groups: list[str], ends: DataFrame | None = None) -> DataFrame:
    """Unread records of each group and destination: over its partitions, the sum of end offset less
    committed offset, or less the first offset where the group has no commit.

    The log is reduced to one row per partition first; everything after that is as small. Of a stored log these rows
    are known: with `ends`, its `stored_positions`, no record is read."""
    ends = (positions(log) if ends is None else ends).withColumn("group", F.explode(F.array(*[F.lit(g) for g in groups])))
    joined = ends.join(committed.select("group", *LOG, "committed"), ["group", *LOG], "left")
    behind = F.col("end") - F.coalesce("committed", "begin")
    return joined.groupBy("group", "destination").agg(F.sum(behind).alias("lag"))
