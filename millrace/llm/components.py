"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for each node of `links` (a, b: numbers of one type). Batch; runs jobs.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends by doubling, and replaces
    both ends of each link by what they hang on; links inside one tree vanish. A round at least halves the trees that
    can still grow. Nodes with many links are reduced by partial aggregates and met by joins of stored tables, which
    adaptive execution can split. Null ends and links of a node with itself are ignored; no links give no rows."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    links = stored(links.where("a != b").select(a.alias("a"), b.alias("b")).distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).where("root < node")
        hooks = _ends(stored(hooks, "hooks"))
        if roots is None:
            roots = hooks
        else:
            moved = _follow(roots, hooks, "root")
            roots = stored(moved.unionByName(hooks), "roots")
        for end in ("a", "b"):
            links = _follow(links, hooks, end)
        links = stored(links.where("a != b").select(a.alias("a"), b.alias("b")).distinct(), "links")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    ends = roots.select("root").distinct()
    return roots.unionByName(ends.select(F.col("root").alias("node"), "root"))


def _follow(rows: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    """Replace `column` by what it is hooked to."""
    to = hooks.select(F.col("node").alias(column), F.col("root").alias("_to"))
    moved = rows.join(to, column, "left").withColumn(column, F.coalesce("_to", column))
    return moved.select(*rows.columns)


def _ends(hooks: DataFrame) -> DataFrame:
    """Follow hooks to their ends. Every hook leads to a smaller node, so there are no cycles."""
    while True:
        to = hooks.select(F.col("node").alias("root"), F.col("root").alias("_to"))
        longer = hooks.join(to, "root", "left")
        longer = stored(longer.select("node", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_moved")), "hooks")
        moved = not longer.where("_moved").isEmpty()
        hooks = longer.drop("_moved")
        if not moved:
            return hooks
