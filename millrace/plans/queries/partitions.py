"""Choice of partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, PARTITION, PARTITION_OVERRIDE, header
from millrace.functions.hashing import long_hash, string_hash
from millrace.operators.partitioning import Partitioning, assign_partition, lay_out, partition_of, route_name
from millrace.operators.routing import branch
from millrace.plans.base import LOG, event_log, query, shown, table

# The 32-bit string hash, unsigned; the driver's texts have no characters beyond U+FFFF.
HASH_SQL = """list_reduce(list_transform(string_split({c}, ''), lambda c: unicode(c)::BIGINT),
  lambda a, c: ((a * 31 + c) & 4294967295))"""

SIGNED_SQL = "(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END)"


def _signed(c):
    return SIGNED_SQL.format(h=HASH_SQL.format(c=c))


def _int(c):
    return F.col(c).cast("bigint").alias(c)


@query("part_assign", f"""WITH {LOG} SELECT "offset", abs({_signed("event_type || '-' || key")}) % 5 AS "partition" FROM log""")
def part_assign(spark, sf):
    key = F.concat_ws("-", header(EVENT_TYPE), F.col("key"))
    return assign_partition(event_log(spark, sf), Partitioning(key, 5)).select("offset", _int("partition"))


@query("part_hash", f"""SELECT doc_id, {_signed("lang || '.' || source")} AS string_hash,
  CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END AS long_hash
  FROM (SELECT *, xor(n_chars * 123456789012, (n_chars * 123456789012) >> 32) & 4294967295 AS x FROM documents)""")
def part_hash(spark, sf):
    docs = table(spark, sf, "documents")
    big = F.col("n_chars") * F.lit(123456789012).cast("bigint")
    return docs.select("doc_id", string_hash(F.concat_ws(".", "lang", "source")).alias("string_hash"), long_hash(big).alias("long_hash"))


@query("part_selector", f"""WITH {LOG} SELECT "offset", length(key) % 3 AS "partition" FROM log""")
def part_selector(spark, sf):
    how = Partitioning(F.col("key"), 3, selector=lambda key: -F.length(key))
    return assign_partition(event_log(spark, sf), how).select("offset", _int("partition"))


@query("part_override", f"""WITH {LOG} SELECT "offset",
    CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 3 ELSE CAST(key AS BIGINT) % 6 END AS "partition",
    'event_type=' || event_type || ';scst_partition=' ||
      CASE event_type WHEN 'click' THEN '7' WHEN 'view' THEN '3' ELSE CAST(CAST(key AS BIGINT) % 6 AS VARCHAR) END AS headers FROM log""")
def part_override(spark, sf):
    kind = F.col("event_type")
    log = event_log(spark, sf, **{PARTITION_OVERRIDE: F.when(kind == "click", 7), PARTITION: F.when(kind.isin("view", "click"), 3)})
    out = assign_partition(log, Partitioning(F.col("key"), 6, "bigint"))
    return out.select("offset", _int("partition"), shown().alias("headers"))


@query("part_resize", f"""WITH {LOG} SELECT "offset", CAST(key AS BIGINT) % 4 AS before, CAST(key AS BIGINT) % 6 AS after FROM log""")
def part_resize(spark, sf):
    before = partition_of(Partitioning(F.col("key"), 4, "bigint", actual=2))
    after = partition_of(Partitioning(F.col("key"), 4, "bigint", actual=6))
    return event_log(spark, sf).select("offset", before.cast("bigint").alias("before"), after.cast("bigint").alias("after"))


@query("part_stream", """SELECT event_id AS "offset", CAST(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS BIGINT) AS "partition" FROM events""")
def part_stream(spark, sf):
    chosen = event_log(spark, sf).withColumn("partition", F.when(header(EVENT_TYPE) == "click", 0).otherwise(1))
    return lay_out(chosen, 2).select("offset", _int("partition"))


@query("part_multi_out", f"""WITH {LOG} SELECT "offset", CAST(CASE WHEN k < 30 THEN 0 ELSE 1 END AS BIGINT) AS branch,
  CASE WHEN k < 30 THEN CAST(key AS BIGINT) % 3 ELSE abs({_signed("event_type")}) % 7 END AS "partition" FROM log""")
def part_multi_out(spark, sf):
    k = F.get_json_object(F.get_json_object("value", "$.props"), "$.k").cast("int")
    tagged = branch(event_log(spark, sf), [k < 30], default_branch=True)
    per_output = [Partitioning(F.col("key"), 3, "bigint"), Partitioning(header(EVENT_TYPE), 7)]
    chosen = F.when(F.col("branch") == 0, partition_of(per_output[0])).otherwise(partition_of(per_output[1]))
    return tagged.select("offset", _int("branch"), chosen.cast("bigint").alias("partition"))


@query("part_routing_key", f"""WITH {LOG} SELECT "offset", coalesce(CASE WHEN event_type = 'click' THEN 'clicks.' || key END, destination)
  || '-' || "partition" AS route FROM log""")
def part_routing_key(spark, sf):
    key = F.when(header(EVENT_TYPE) == "click", F.concat(F.lit("clicks."), "key"))
    return event_log(spark, sf).select("offset", route_name(F.col("destination"), key, F.col("partition")).alias("route"))
