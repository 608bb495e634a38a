"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import batch, stream
from tickloom.plans.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(query: Query) -> Query:
    """Dates and clock labels are UTC, so the session must be."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(q) for name, q in {**batch.QUERIES, **stream.QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
