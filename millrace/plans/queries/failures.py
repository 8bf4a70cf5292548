"""Errors, retry, dead letters and queue policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, PARTITION_OVERRIDE, epoch_ms, header
from millrace.functions import content, embedded
from millrace.operators import errors, queues, retry
from millrace.plans.base import LOG, NOISY, event_log, hour, noisy_log, query, shown, table
from millrace.plans.queries.conversion import EVENT
from millrace.session import stored
from millrace.sinks import outputs


def _props_k():
    return F.get_json_object(F.get_json_object("value", "$.props"), "$.k").cast("int")


def _split(spark, sf, policy):
    return errors.apply_policy(content.decode(noisy_log(spark, sf), EVENT).drop("text", "bytes"), policy)


@query("err_policy", f"""WITH {NOISY} SELECT policy, event_type, count(*) AS rows FROM (
    SELECT 'logAndContinue good' AS policy, event_type FROM log WHERE event_type <> 'error'
    UNION ALL SELECT 'skipAndContinue good', event_type FROM log WHERE event_type <> 'error'
    UNION ALL SELECT 'sendToDlq good', event_type FROM log WHERE event_type <> 'error'
    UNION ALL SELECT 'sendToDlq bad', event_type FROM log WHERE event_type = 'error') GROUP BY ALL""")
def err_policy(spark, sf):
    # Decoded once; each policy splits the same stored rows.
    decoded = stored(content.decode(noisy_log(spark, sf), EVENT).select("value", header(EVENT_TYPE).alias("event_type"), "error"), "decoded")
    parts = []
    for policy in (errors.LOG, errors.SKIP, errors.DLQ):
        split = errors.apply_policy(decoded, policy)
        parts.append(split.good.select(F.lit(f"{policy} good").alias("policy"), "event_type"))
    parts.append(split.bad.select(F.lit(f"{policy} bad").alias("policy"), "event_type"))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.groupBy("policy", "event_type").agg(F.count(F.lit(1)).alias("rows"))


def _dead_letters(spark, sf, mode="headers"):
    bad = _split(spark, sf, errors.DLQ).bad
    return errors.dead_letter(bad, errors.dlq_name("audit"), mode=mode, message=F.lit("cannot read"), stacktrace=F.lit("at decode"))


_DETAILS = """'event_type=error;x-exception-fqcn=MessageConversionException;x-exception-message=cannot read;'
    || 'x-exception-stacktrace=at decode;x-original-offset=' || "offset" || ';x-original-partition=' || "partition"
    || ';x-original-timestamp=' || ms || ';x-original-timestamp-type=CreateTime;x-original-topic=' || destination"""


@query("dlq_write", f"""WITH {NOISY} SELECT 'error.events.error.audit' AS destination, "partition", key, value, {_DETAILS} AS headers
  FROM log WHERE event_type = 'error'""")
def dlq_write(spark, sf):
    return _dead_letters(spark, sf).select("destination", "partition", "key", "value", shown().alias("headers"))


@query("dlq_mode", f"""WITH {NOISY}, bad AS (SELECT *, {_DETAILS} AS details FROM log WHERE event_type = 'error')
  SELECT 'headers' AS mode, "partition", key, value, details AS headers FROM bad
  UNION ALL SELECT 'embeddedHeaders', "partition", key, value, replace(details, 'event_type=error;', '') FROM bad
  UNION ALL SELECT 'none', "partition", key, value, 'event_type=error' FROM bad""")
def dlq_mode(spark, sf):
    def rows(df, mode, value, headers):
        return df.select(F.lit(mode).alias("mode"), "partition", "key", value.alias("value"), shown(headers).alias("headers"))

    bad = stored(_split(spark, sf, errors.DLQ).bad.drop("data"), "bad")

    def letters(mode):
        return errors.dead_letter(bad, errors.dlq_name("audit"), mode=mode, message=F.lit("cannot read"), stacktrace=F.lit("at decode"))

    native = rows(letters("headers"), "headers", F.col("value"), "headers")
    inside = letters("embeddedHeaders").withColumn("_x", embedded.extract_headers(F.col("value")))
    carried = rows(inside, "embeddedHeaders", F.decode("_x.body", "UTF-8"), "_x.headers")
    return native.unionByName(carried).unionByName(rows(letters("none"), "none", F.col("value"), "headers"))


@query("dlq_name", f"""WITH {LOG} SELECT "offset", CASE event_type WHEN 'click' THEN 'clicks.broken' ELSE 'error.' || destination || '.audit' END AS resolved,
  'all.broken' AS configured, destination || '.dlq' AS queue FROM log""")
def dlq_name(spark, sf):
    resolver = F.when(header(EVENT_TYPE) == "click", "clicks.broken")
    return event_log(spark, sf).select(
        "offset", errors.dlq_name("audit", resolver=resolver).alias("resolved"),
        errors.dlq_name("audit", configured="all.broken").alias("configured"),
        errors.queue_dlq_name(F.col("destination")).alias("queue"))


@query("dlq_partition", f"""WITH {LOG} SELECT "offset", "partition" AS unset, 0 AS one, "partition" AS many,
  CASE WHEN k > 50 THEN 1 ELSE "partition" END AS custom FROM log""")
def dlq_partition(spark, sf):
    log = event_log(spark, sf)
    return log.select("offset", errors.dlq_partition().alias("unset"), errors.dlq_partition(1).alias("one"),
                      errors.dlq_partition(4).alias("many"), errors.dlq_partition(custom=F.when(_props_k() > 50, 1)).alias("custom"))


@query("dlq_batch", """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
  WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0) GROUP BY ALL""")
def dlq_batch(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") == 0, "NoDiscount").alias("error"))
    sent = errors.dead_letter_batches(lines, "l_orderkey")
    return sent.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("rows"))


@query("recover_record", f"""WITH {LOG} SELECT "offset", 'expression' AS way, CASE WHEN k >= 50 THEN 100 // (k - 49) END AS result,
    CASE WHEN k < 50 THEN 'TooSmall' END AS error, 'billing.dlt' AS destination FROM log
  UNION ALL SELECT "offset", 'function', CASE WHEN k >= 50 THEN 100 // (k - 49) END,
    CASE WHEN k < 50 THEN 'ValueError' END, 'billing.dlt' FROM log""")
def recover_record(spark, sf):
    log = event_log(spark, sf, value=F.get_json_object("props", "$.k"))
    k = F.col("value").cast("int")
    by_expression = retry.recover_expr(log, F.when(k >= 50, F.floor(F.lit(100) / (k - 49)).cast("int")), "TooSmall")

    def divide(text: str) -> str:
        if int(text) < 50:
            raise ValueError("too small")
        return str(100 // (int(text) - 49))

    by_function = retry.recover(log, divide)
    return by_expression.select("offset", F.lit("expression").alias("way"), "result", "error", F.lit("billing.dlt").alias("destination")).unionByName(
        by_function.select("offset", F.lit("function").alias("way"), F.col("result").cast("int").alias("result"), "error",
                           F.lit("billing.dlt").alias("destination")))


@query("retry_attempts", f"""WITH {LOG} SELECT "offset",
    CASE WHEN event_type = 'error' THEN 1 ELSE least(k % 5 + 1, 3) END AS attempts,
    CASE WHEN event_type = 'error' THEN 'PermissionError' WHEN k % 5 >= 3 THEN 'TimeoutError' END AS error,
    CASE WHEN event_type <> 'error' AND k % 5 < 3 THEN CAST(k AS VARCHAR) END AS result,
    CASE WHEN event_type = 'error' THEN 0 ELSE [0, 1000, 3000][least(k % 5 + 1, 3)] END AS waited_ms FROM log""")
def retry_attempts(spark, sf):
    log = event_log(spark, sf, value=F.concat_ws(":", "event_type", F.get_json_object("props", "$.k")))

    def flaky(value: str, attempt: int) -> str:
        kind, k = value.split(":")
        if kind == "error":
            raise PermissionError(kind)
        if attempt <= int(k) % 5:
            raise TimeoutError(k)
        return k

    settings = retry.Retry(rules={PermissionError: False})
    tried = retry.apply_with_retry(log, flaky, settings)
    # The waits before the attempts that were made.
    earlier = F.filter(F.sequence(F.lit(0), F.col("attempts") - 1), lambda n: n > 0)
    waits = F.aggregate(F.transform(earlier, lambda n: retry.delay_column(settings, n)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return tried.select("offset", "attempts", "error", "result", waits.cast("int").alias("waited_ms"))


@query("retry_classify", f"""WITH {LOG} SELECT "offset", event_type NOT IN ('error', 'signup', 'view') AS excludes,
  event_type IN ('error', 'signup', 'click') AS includes, event_type IN ('signup', 'view') AS "both" FROM log""")
def retry_classify(spark, sf):
    # error and signup descend from a listed class, view and click are listed themselves.
    ancestors = {"error": "Corrupt", "Corrupt": "Fatal", "signup": "Fatal"}
    rules = {"excludes": {"Fatal": False, "view": False}, "includes": {"Fatal": True, "click": True},
             "both": {"Fatal": True, "Corrupt": False, "view": True}}
    decided = [retry.classify(header(EVENT_TYPE), r, ancestors).alias(name) for name, r in rules.items()]
    return event_log(spark, sf).select("offset", *decided)


def _letters(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return event_log(spark, sf, **{errors.X_RETRIES: F.when(k % 5 > 0, k % 5)})


@query("dlq_reprocess", f"""WITH {LOG} SELECT "offset", CASE WHEN k % 5 < 3 THEN destination ELSE 'parking' END AS destination,
  CASE WHEN k % 5 < 3 THEN k % 5 + 1 ELSE k % 5 END AS retries, "partition" AS override FROM log""")
def dlq_reprocess(spark, sf):
    back = errors.reprocess(_letters(spark, sf), F.col("destination"), "parking")
    return back.select("offset", "destination", header(errors.X_RETRIES).cast("int").alias("retries"),
                       header(PARTITION_OVERRIDE).cast("int").alias("override"))


@query("dlq_backoff", f"""WITH {LOG} SELECT "offset", CAST(k % 5 * 5000 AS BIGINT) AS delay, ms + k % 5 * 5000 AS deliver_ms FROM log""")
def dlq_backoff(spark, sf):
    retries = F.coalesce(header(errors.X_RETRIES).cast("int"), F.lit(0))
    delayed = outputs.delay(_letters(spark, sf), errors.reprocess_delay(retries))
    return delayed.select("offset", header(errors.X_DELAY).cast("bigint").alias("delay"), epoch_ms("deliver_at").alias("deliver_ms"))


@query("dlq_truncate", """SELECT doc_id, substring(text, 1, 1000) AS trace, text AS unlimited FROM documents""")
def dlq_truncate(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", errors.truncate_trace(F.col("text"), 21_000).alias("trace"),
                       errors.truncate_trace(F.col("text"), 0).alias("unlimited"))


@query("dlq_republish", f"""WITH {LOG} SELECT 'DLX' AS destination, destination AS key, "offset",
  'event_type=' || event_type || ';x-exception-message=failed;x-exception-stacktrace=at app;x-original-exchange=events;x-original-routingKey='
  || event_type || ';x-retries=' || (k % 5) || ';x-retry-count=1' AS headers FROM log WHERE event_type <> 'view' AND k % 5 > 0
  UNION ALL SELECT 'DLX', destination, "offset",
  'event_type=' || event_type || ';x-exception-message=failed;x-exception-stacktrace=at app;x-original-exchange=events;x-original-routingKey='
  || event_type || ';x-retry-count=1' FROM log WHERE event_type <> 'view' AND k % 5 = 0""")
def dlq_republish(spark, sf):
    kind = header(EVENT_TYPE)
    sent = errors.republish(_letters(spark, sf), "DLX", F.col("destination"), kind == "view", F.lit("failed"), F.lit("at app"), F.lit("events"), kind)
    return sent.select("destination", "key", "offset", shown().alias("headers"))


@query("err_handler", f"""WITH {NOISY} SELECT destination, 'MessageConversionException' AS error, count(*) AS rows FROM log WHERE event_type = 'error' GROUP BY ALL""")
def err_handler(spark, sf):
    def report(bad):
        return bad.groupBy("destination", "error").agg(F.count(F.lit(1)).alias("rows"))

    def never(bad):
        raise AssertionError("the binding's own handler comes first")

    return errors.handle_errors(_split(spark, sf, errors.DLQ), default=never, binding=report)


@query("queue_ttl", f"""WITH {LOG} SELECT "offset", CASE WHEN epoch_us(TIMESTAMP '2024-01-25') // 1000 - ms > 864000000 THEN 'DLX' ELSE destination END AS destination FROM log""")
def queue_ttl(spark, sf):
    at = F.lit("2024-01-25").cast("timestamp")
    outcome = queues.expire(event_log(spark, sf), 10 * 24 * 3_600_000, at)
    return outcome.kept.select("offset", "destination").unionByName(outcome.left.select("offset", F.lit("DLX").alias("destination")))


@query("queue_max_length", f"""WITH {LOG}, ranked AS (SELECT *,
    row_number() OVER (PARTITION BY destination ORDER BY "offset" DESC) AS newest, row_number() OVER (PARTITION BY destination ORDER BY "offset") AS oldest,
    sum(strlen(value)) OVER (PARTITION BY destination ORDER BY "offset" DESC ROWS UNBOUNDED PRECEDING) AS bytes FROM log)
  SELECT 'drop-head' AS rule, destination, "offset" FROM ranked WHERE newest <= 300
  UNION ALL SELECT 'reject-publish', destination, "offset" FROM ranked WHERE oldest <= 300
  UNION ALL SELECT 'bytes', destination, "offset" FROM ranked WHERE bytes <= 20000""")
def queue_max_length(spark, sf):
    log, order = event_log(spark, sf), [F.col("offset")]
    # What the rules look at, read from the log once.
    log = stored(log.select("destination", "offset", F.octet_length("value").cast("bigint").alias("size")), "sizes")
    slices = F.floor(F.col("offset") / 1000)
    by_rule = {
        "drop-head": queues.limit_length(log, "destination", order, 300, slice_by=slices),
        "reject-publish": queues.limit_length(log, "destination", order, 300, overflow=queues.REJECT_PUBLISH, slice_by=slices),
        "bytes": queues.limit_length(log, "destination", order, max_bytes=20_000, size=F.col("size"), slice_by=slices),
    }
    kept = [o.kept.select(F.lit(rule).alias("rule"), "destination", "offset") for rule, o in by_rule.items()]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query("queue_priority", f"""WITH {LOG} SELECT destination, "offset", row_number() OVER (PARTITION BY destination ORDER BY least(k // 10, 5) DESC, "offset") - 1 AS turn FROM log""")
def queue_priority(spark, sf):
    priority = F.floor(_props_k() / 10)
    ordered = queues.by_priority(event_log(spark, sf), "destination", priority, [F.col("offset")], 5, F.floor(F.col("offset") / 1000))
    return ordered.select("destination", "offset", "turn")


@query("delivery_limit", f"""WITH {LOG} SELECT "offset", CASE WHEN k % 5 > 3 THEN 'DLX' ELSE destination END AS destination FROM log""")
def delivery_limit(spark, sf):
    deliveries = F.coalesce(header(errors.X_RETRIES).cast("int"), F.lit(0))
    outcome = queues.limit_deliveries(_letters(spark, sf), deliveries, 3)
    return outcome.kept.select("offset", "destination").unionByName(outcome.left.select("offset", F.lit("DLX").alias("destination")))
