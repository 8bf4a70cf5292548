"""URL filter rules: a sort-merge range join of urls with nested prefix rules.

A rule is a host and the beginning of a path; it fits its host and all subdomains. The host written backwards
(`org.example`) and the path make a canonical key in which a rule is a prefix, hence an interval of the sort order.
A url is looked up once for each ending of its host (`org`, `org.example`, ...), so that rules of a parent domain meet
it by prefix too. Urls and rules are sorted together; a sweep over each range keeps the stack of rules whose interval
is open, and the top of the stack is the longest rule that fits. Rules whose interval began in an earlier range are
handed over between ranges: those are the prefixes of the range's first key, out of one row for each range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, batch_of, range_tasks
from millrace.session import stored

_URL, _RULE, _SUMMARY = 1, 0, 2


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased. No `://` or null: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end. No `://` or null: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    # A host holds no slash, so the first slash ends it.
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("/"), path)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule for each distinct (host, path) of `urls`: columns host, path, rule, verdict. Batch; runs jobs.

    rules: host, path, verdict. Of several rules with one host and path, the greatest verdict counts ("block" before
    "allow"). Length is that of host and path together, and the longer host decides between equal ones. A rule with
    a null host or path fits nothing. A url with an empty host meets no rule; pairs without a rule have null rule and
    verdict. An empty table of rules or urls is fine."""
    spark = urls.sparkSession
    pairs = urls.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path")).distinct()
    pairs = stored(pairs, "url-pairs")
    labels = F.split("host", r"\.")
    # Endings of the host: from its last label to all of them.
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    looked_up = pairs.where("host != ''").select("host", "path", F.explode(suffixes).alias("suffix"))
    looked_up = looked_up.select(
        _key(F.col("suffix"), F.col("path")).alias("key"), F.lit(_URL).alias("kind"), "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), F.lit(0).alias("host_length"))
    known = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    known = known.select(
        _key(F.col("host"), F.col("path")).alias("key"), F.lit(_RULE).alias("kind"), "host", "path",
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"))
    both = looked_up.unionByName(known)
    both = both.repartitionByRange(range_tasks(spark, both.count()), "key", "kind", "host", "path")
    both = both.sortWithinPartitions("key", "kind")

    entry = pa.struct([("key", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("host_length", pa.int32())])
    out = [("part", pa.int32()), ("kind", pa.int32()), ("key", pa.string()), ("host", pa.string()), ("path", pa.string()),
           ("found", entry), ("open", pa.list_(entry))]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack, first = TaskContext.get().partitionId(), [], None
        for batch in batches:
            rows = []
            columns = [batch.column(n).to_pylist() for n in ("key", "kind", "host", "path", "rule", "verdict", "host_length")]
            for key, kind, host, path, rule, verdict, host_length in zip(*columns):
                first = key if first is None else first
                while stack and not key.startswith(stack[-1]["key"]):
                    stack.pop()
                if kind == _RULE:
                    stack.append({"key": key, "rule": rule, "verdict": verdict, "host_length": host_length})
                else:
                    rows.append((part, _URL, key, host, path, stack[-1] if stack else None, None))
            if rows:
                yield batch_of(out, list(zip(*rows)))
        if first is not None:
            yield batch_of(out, [[part], [_SUMMARY], [first], [None], [None], [None], [stack]])

    struct = "struct<key:string,rule:string,verdict:string,host_length:int>"
    swept = stored(both.mapInArrow(
        sweep, f"part int, kind int, key string, host string, path string, found {struct}, open array<{struct}>"), "swept")

    # One row for each range, with as many rules as are nested in each other.
    inherited, stack = [], []
    for row in swept.where(F.col("kind") == _SUMMARY).orderBy("part").select("part", "key", "open").collect():
        stack = [r for r in stack if row["key"].startswith(r["key"])]
        inherited.append((row["part"], [tuple(r) for r in stack]))
        stack = stack + list(row["open"])
    handed = spark.createDataFrame(inherited, f"part int, handed array<{struct}>")

    found = swept.where(F.col("kind") == _URL).join(handed, "part")
    fitting = F.filter("handed", lambda r: F.startswith(F.col("key"), r["key"]))
    found = found.withColumn("best", F.coalesce("found", F.try_element_at(fitting, F.lit(-1)))).where("best is not null")
    best = found.groupBy("host", "path").agg(
        F.max(F.struct(F.length("best.rule").alias("length"), "best.host_length", "best.rule", "best.verdict")).alias("best"))
    return pairs.join(best, ["host", "path"], "left").select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to `pages` (columns of these names are replaced). Batch; runs jobs.

    verdict is the longest fitting rule's, else `default`: what no rule names is let through."""
    named = pages.drop("host", "path", "rule", "verdict")
    named = named.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    judged = stored(match_rules(named, rules), "judged")
    return named.join(judged, ["host", "path"]).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
