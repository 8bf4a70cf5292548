"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import base
from millrace.plans.queries import (  # noqa: F401  importing registers them
    consumption,
    emission,
    rowwise,
    conversion,
    partitions,
    routes,
    joining,
    aggregation,
    keyed,
    failures,
    registries,
    batching,
    composing,
    streamed,
)


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.QUERIES["join_stream_table_left"](spark, sf_dir)
