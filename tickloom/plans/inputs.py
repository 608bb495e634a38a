"""Inputs of the registered queries: trades derived from the ``events`` table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators import parse_trades
from tickloom.sources import frames_from_events
from tickloom.sources.events import EPOCH_MS, TIME_SQUEEZE

AS_OF = "2024-01-01 02:00:00"  # end of the derived trades

# Cuts between the parts a stream is fed in, in seconds of trade time. They fall inside a bar,
# so the bars at the cuts are stored in two versions.
CUTS = (2417, 4843)

# Of the stream of rolling days: a tenth of the time between events, so that trades fill three days.
DAYS_SQUEEZE = 10


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_from_events(events(spark, sf_dir))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_trades(frames(spark, sf_dir))


def _event_time(trade_second: int) -> Column:
    """The ``events.ts`` at which trade time reaches a second after its start."""
    moment = datetime.fromtimestamp(EPOCH_MS / 1000, timezone.utc) + timedelta(
        seconds=trade_second * TIME_SQUEEZE)
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def parts(spark: SparkSession, sf_dir: str, cuts: tuple[int, ...] = CUTS) -> list[DataFrame]:
    """Events in consecutive spans of time. The filters are on ``ts`` and reach the scan."""
    whole = events(spark, sf_dir)
    edges = [None, *cuts, None]
    spans = []
    for low, high in zip(edges, edges[1:]):
        span = whole
        if low is not None:
            span = span.filter(F.col("ts") >= _event_time(low))
        if high is not None:
            span = span.filter(F.col("ts") < _event_time(high))
        spans.append(span)
    return spans
