"""User functions that may fail, and trying them again."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOME = "result string, error string, message string, attempts int"


@dataclass(frozen=True)
class Retry:
    """Retry settings of an input binding. rules: exception classes to retry (True) and not to (False), subclasses
    included. An exclude wins over an include. If any class is included, nothing else is retried; else a class no rule
    covers is retried unless `unlisted` says otherwise."""

    max_attempts: int = 3
    initial_ms: int = 1000
    multiplier: float = 2.0
    max_ms: int = 10_000
    rules: Mapping[type[Exception], bool] = field(default_factory=dict)
    unlisted: bool = True

    def retryable(self, error: Exception) -> bool:
        covering = {self.rules[cls] for cls in type(error).__mro__ if cls in self.rules}
        if covering:
            return False not in covering
        return self.unlisted and True not in self.rules.values()

    def delay_ms(self, attempt: int) -> int:
        """Wait after the given failed attempt, counted from 1."""
        return int(min(self.initial_ms * self.multiplier ** (attempt - 1), self.max_ms))


def delay_column(retry: Retry, attempt: Column) -> Column:
    """`Retry.delay_ms` over a column."""
    return F.least(F.lit(retry.initial_ms) * F.pow(F.lit(float(retry.multiplier)), attempt - 1),
                   F.lit(float(retry.max_ms))).cast("bigint")


def apply_with_retry(
    df: DataFrame,
    function: Callable[[str, int], str],
    retry: Retry = Retry(),
    wait: bool = False,
) -> DataFrame:
    """Apply `function(value, attempt)` to each row's value, trying again inside the task.

    Adds `result`, `error` (class name, null if it worked), `message` and `attempts`. The function
    must be pure, since Spark may run a task twice. Null values are passed over. With `wait` the task
    sleeps between attempts, as the settings say."""

    def one(value: str | None) -> tuple:
        if value is None:
            return None, None, None, 0
        attempt = 1
        while True:
            try:
                return function(value, attempt), None, None, attempt
            except Exception as e:
                if attempt >= retry.max_attempts or not retry.retryable(e):
                    return None, type(e).__name__, str(e), attempt
                if wait:
                    time.sleep(retry.delay_ms(attempt) / 1000)
                attempt += 1

    @F.pandas_udf(OUTCOME)
    def outcome(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(v) for v in values], columns=["result", "error", "message", "attempts"])

    # Not to be evaluated once for a filter on the outcome and again for its value.
    once = outcome.asNondeterministic()
    return df.withColumn("_o", once(F.col("value").cast("string"))).select("*", "_o.*").drop("_o")


def recover(df: DataFrame, function: Callable[[str], str]) -> DataFrame:
    """Apply a function once; a row it fails on gets its error instead of ending the job. Split the
    outcome with `millrace.operators.errors.apply_policy`."""
    return apply_with_retry(df, lambda value, _: function(value), Retry(max_attempts=1))


def recover_expr(df: DataFrame, attempt: Column, error: str) -> DataFrame:
    """The same for functions Spark can express: `attempt` gives null where it fails (`try_*`)."""
    failed = F.col("value").isNotNull() & attempt.isNull()
    return df.withColumns({"result": attempt, "error": F.when(failed, F.lit(error))})


def classify(error: Column, rules: Mapping[str, bool], ancestors: Mapping[str, str], unlisted: bool = True) -> Column:
    """Whether an error class, given by name, is tried again, as `Retry` decides. `ancestors` names the parent of each
    class. Settings become a `when` chain, not a join."""
    decision, others = None, unlisted and True not in rules.values()
    for name in dict.fromkeys([*rules, *ancestors]):
        covering, at = set(), name
        while at is not None:
            covering |= {rules[at]} if at in rules else set()
            at = ancestors.get(at)
        if covering:
            decision = (F if decision is None else decision).when(error == name, False not in covering)
    return F.lit(others) if decision is None else decision.otherwise(others)
