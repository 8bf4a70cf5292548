"""Routing, branching and merging. Each router is one pass over the rows and needs no shuffle."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.envelope import EVENT_TYPE, header
from millrace.session import stored
from millrace.sources.log import names

# Headers that name the handler of a message.
DEFINITION = "spring.cloud.function.definition"
EXPRESSION = "spring.cloud.function.routing-expression"


def by_event_type(df: DataFrame, event_types: str, header_name: str = EVENT_TYPE) -> DataFrame:
    """Keep rows whose header is in a comma list; rows without it are dropped. A plain predicate,
    so it runs before any decoding."""
    return df.filter(header(header_name).isin(names(event_types)))


def handler_name(
    callback: Column | None = None,
    expressions: Mapping[str, Column] | None = None,
    default: Column | str | None = None,
) -> Column:
    """Name of the handler of each row: callback, then definition header, then expression header
    (a text looked up among the known `expressions`), then the configured default."""
    options = [callback] if callback is not None else []
    options.append(header(DEFINITION))
    if expressions:
        chosen = reduce(lambda w, e: w.when(header(EXPRESSION) == e[0], e[1]), expressions.items(), F.when(F.lit(False), ""))
        options.append(chosen)
    if default is not None:
        options.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*options)


def route(
    df: DataFrame,
    handlers: Mapping[str, Callable[[Column], Column] | None],
    name: Column,
    router: str = "functionRouter",
) -> DataFrame:
    """Apply to each row's value the handler its name picks; results go to `<router>-out-0`.

    A handler of None consumes its rows and emits nothing. A name with no handler is an error."""
    unknown = F.raise_error(F.concat(F.lit("no handler named "), F.coalesce(name, F.lit("(none)"))))
    known = F.when(name.isin(list(handlers)), True).otherwise(unknown.cast("boolean"))
    out = df.filter(known)
    producing = {n: h for n, h in handlers.items() if h is not None}
    out = out.filter(name.isin(list(producing)))
    value = F.lit(None).cast("string")
    for n, h in producing.items():
        value = F.when(name == n, h(F.col("value"))).otherwise(value)
    return out.withColumns({"value": value, "destination": F.lit(f"{router}-out-0")})


def branch_number(predicates: Sequence[Column], default_branch: bool = False) -> Column:
    """Number of the first predicate that holds; with a default branch, what matches none gets the
    next number, otherwise null."""
    number = F.lit(len(predicates) if default_branch else None).cast("int")
    for i in reversed(range(len(predicates))):
        number = F.when(predicates[i], i).otherwise(number)
    return number


def branch(df: DataFrame, predicates: Sequence[Column], default_branch: bool = False) -> DataFrame:
    """Tag each row with its branch; rows of no branch are dropped."""
    return df.withColumn("branch", branch_number(predicates, default_branch)).filter(F.col("branch").isNotNull())


def branches(df: DataFrame, predicates: Sequence[Column], default_branch: bool = False) -> list[DataFrame]:
    """The branches as frames of their own. Several actions over them read the input again; to write
    all of them, write the tagged frame of `branch` partitioned by its number."""
    tagged = branch(df, predicates, default_branch)
    count = len(predicates) + int(default_branch)
    return [tagged.filter(F.col("branch") == i).drop("branch") for i in range(count)]


def to_outputs(df: DataFrame, function: str, number: Column, destinations: Sequence[str] | None = None) -> DataFrame:
    """Bind each row to output `<function>-out-<number>`, or to the destination bound to it."""
    if destinations is None:
        target = F.concat(F.lit(f"{function}-out-"), number.cast("string"))
    else:
        target = F.get(F.array(*[F.lit(d) for d in destinations]), number)
    return df.withColumn("destination", target)


def merge(*frames: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates included, in no particular order."""
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class QueueBinding:
    """A queue bound to an exchange. key: routing key or pattern. arguments, match_all: what a
    headers exchange compares."""

    queue: str
    key: str = "#"
    arguments: Mapping[str, str] = field(default_factory=dict)
    match_all: bool = True


def topic_regex(pattern: str) -> str:
    """Regex over a routing key in which each word is followed by a dot: `*` stands for one word,
    `#` for any number of them."""
    stands_for = {"*": "[^.]*\\.", "#": "(?:[^.]*\\.)*"}
    return "".join(stands_for.get(word, re.escape(word) + "\\.") for word in pattern.split("."))


def queues(exchange: str, bindings: Sequence[QueueBinding], routing_key: Column | None = None) -> Column:
    """Array of the queues a message goes to, each at most once."""
    by_queue: dict[str, list[QueueBinding]] = {}
    for b in bindings:
        by_queue.setdefault(b.queue, []).append(b)

    if exchange == "fanout":
        return F.array(*[F.lit(q) for q in by_queue])
    if exchange == "direct":
        # A literal map, searched entry by entry; `route_by_table` is for many bindings.
        bound: dict[str, list[str]] = {}
        for b in bindings:
            if b.queue not in bound.setdefault(b.key, []):
                bound[b.key].append(b.queue)
        table = F.create_map(*[c for k, qs in bound.items() for c in (F.lit(k), F.array(*[F.lit(q) for q in qs]))])
        return F.coalesce(F.try_element_at(table, routing_key), F.array().cast("array<string>"))
    if exchange == "topic":
        dotted = F.when(routing_key == "", "").otherwise(F.concat(routing_key, F.lit(".")))
        tests = {q: dotted.rlike("^(?:" + "|".join(topic_regex(b.key) for b in bs) + ")$") for q, bs in by_queue.items()}
    elif exchange == "headers":
        def matches(b: QueueBinding) -> Column:
            pairs = [F.coalesce(header(k) == v, F.lit(False)) for k, v in b.arguments.items()]
            if b.match_all:
                return reduce(Column.__and__, pairs, F.lit(True))
            return reduce(Column.__or__, pairs, F.lit(False))

        tests = {q: reduce(Column.__or__, [matches(b) for b in bs]) for q, bs in by_queue.items()}
    else:
        raise ValueError(f"cannot bind to an exchange of type {exchange}")
    return F.array_compact(F.array(*[F.when(t, q) for q, t in tests.items()]))


def route_exchange(df: DataFrame, exchange: str, bindings: Sequence[QueueBinding],
                   routing_key: Column | None = None) -> DataFrame:
    """One row for each queue a message goes to. The bindings are settings, so they become one
    expression: no join, and rows that match nothing are dropped. The plan grows with the bindings; from some hundreds
    on use `route_by_table`."""
    return df.withColumn("queue", F.explode(queues(exchange, bindings, routing_key)))


def _plain_pattern(pattern: Column) -> Column:
    """A topic pattern with a dot before each word, and repeated `#` as one."""
    words = F.split(F.concat(F.lit("."), pattern), "\\.")
    words = F.filter(words, lambda w, i: (i > 0) & ~((w == "#") & (F.get(words, i - 1) == "#")))
    return F.concat(F.lit("."), F.array_join(words, "."))


def _topic_matches(keys: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (key, pattern) of routing keys and topic patterns that match.

    The patterns' prefixes are the nodes of a trie, named by their own text. All keys walk it at once, a word at a time:
    from a node to its child of that word or of `*`, staying at a node that ends with `#`, and, without a word, to the
    child `#`. Each step is a join by equality with the nodes; where a key's words end it is met by whole patterns."""
    named = patterns.select(F.col("key").alias("pattern"), _plain_pattern(F.col("key")).alias("path")).distinct()
    words = F.split(F.col("path"), "\\.")
    prefix = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), "."))
    nodes = stored(named.select(F.explode(prefix).alias("node")).distinct(), "trie")

    def with_hash(at: DataFrame) -> DataFrame:
        below = at.withColumn("node", F.concat("node", F.lit(".#"))).join(nodes, "node", "left_semi")
        return at.unionByName(below.select(*at.columns)).distinct()

    walk = keys.select("key", F.when(F.col("key") == "", F.array().cast("array<string>")).otherwise(F.split("key", "\\.")).alias("words"), F.lit("").alias("node"))
    walk = stored(with_hash(walk), "walk")
    longest = walk.agg(F.max(F.size("words"))).first()[0] or 0
    ended = walk.where(F.size("words") == 0).select("key", "node")
    for n in range(longest):
        at = walk.where(F.size("words") > n)
        steps = F.concat("node", F.lit("."), F.get("words", F.lit(n))), F.concat("node", F.lit(".*"))
        moved = at.select("key", "words", F.explode(F.array(*steps)).alias("node")).join(nodes, "node", "left_semi").select(*at.columns)
        walk = stored(with_hash(moved.unionByName(at.where(F.col("node").endswith(".#")))), "walk")
        ended = ended.unionByName(walk.where(F.size("words") == n + 1).select("key", "node"))
    return ended.join(named.withColumnRenamed("path", "node"), "node").select("key", "pattern").distinct()


def route_by_table(df: DataFrame, exchange: str, bindings: DataFrame, routing_key: Column | None = None, spread: int = 16) -> DataFrame:
    """As `route_exchange`, with the bindings in a table (queue, key; for a headers exchange arguments, a map, and
    match_all), however many there are: the plan does not depend on them. Batch; runs jobs, for a topic exchange one for
    each word of the longest routing key.

    Distinct routing keys (for a headers exchange, header maps) are matched, and messages joined with what they match,
    so a hot key is matched once. A fanout exchange repeats the queues `spread` times and spreads the messages over
    them. A null routing key matches nothing."""
    if exchange == "fanout":
        queues = stored(bindings.select("queue").distinct(), "queues").withColumn("_spread", F.explode(F.lit(list(range(spread)))))
        return df.withColumn("_spread", (F.monotonically_increasing_id() % spread).cast("int")).join(queues, "_spread").drop("_spread")
    if exchange in ("direct", "topic"):
        keyed = df.withColumn("_key", routing_key)
        keys = stored(keyed.where(F.col("_key").isNotNull()).select(F.col("_key").alias("key")).distinct(), "routing-keys")
        matches = bindings.select("key", F.col("key").alias("pattern")).distinct() if exchange == "direct" else _topic_matches(keys, bindings)
        routes = matches.join(bindings.select(F.col("key").alias("pattern"), "queue"), "pattern").select(F.col("key").alias("_key"), "queue").distinct()
        return keyed.join(stored(routes, "routes"), "_key").drop("_key")
    if exchange != "headers":
        raise ValueError(f"cannot bind to an exchange of type {exchange}")
    keyed = df.withColumn("_key", F.to_json(F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))))))
    sets = stored(keyed.groupBy("_key").agg(F.first("headers").alias("headers")), "header-sets")
    numbered = stored(bindings.select("queue", "arguments", "match_all").withColumn("_n", F.monotonically_increasing_id())
                      .withColumn("_wanted", F.size("arguments")), "bindings")
    asked = numbered.select("_n", "_wanted", "match_all", "queue", F.explode("arguments").alias("name", "value"))
    met = sets.select("_key", F.explode("headers").alias("name", "value")).join(asked, ["name", "value"])
    met = met.groupBy("_key", "_n", "queue", "match_all", "_wanted").agg(F.count(F.lit(1)).alias("_met"))
    routes = met.where(~F.col("match_all") | (F.col("_met") == F.col("_wanted"))).select("_key", "queue").distinct()
    # Bindings without arguments that match all of them take every message.
    every = numbered.where((F.col("_wanted") == 0) & F.col("match_all")).select("queue").distinct()
    always = route_by_table(sets.select("_key"), "fanout", every, spread=spread)
    return keyed.join(stored(routes.unionByName(always).distinct(), "routes"), "_key").drop("_key")


def route_alternate(df: DataFrame, main: Column, alternate: Column) -> DataFrame:
    """As `route_exchange`, for two arrays of queues: messages the main exchange has no queue for
    go to those of its alternate exchange."""
    target = F.when(F.size(main) > 0, main).otherwise(alternate)
    return df.withColumn("queue", F.explode(target))
