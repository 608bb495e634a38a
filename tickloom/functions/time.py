"""Instants, always UTC unless the text says otherwise."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def epoch_seconds(as_of: str | int | float | datetime) -> int:
    """Whole epoch seconds of an instant given as ISO text, datetime or number."""
    if isinstance(as_of, (int, float)):
        return int(as_of)
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def instant(seconds: int) -> Column:
    """Timestamp literal. It folds to a constant, so comparisons reach the scan."""
    return F.timestamp_seconds(F.lit(seconds).cast("bigint"))


def parse_mixed_ts(text: Column) -> Column:
    """Epoch-millisecond text if it is a whole number, else ISO text, else null."""
    return F.coalesce(
        F.timestamp_millis(text.try_cast("bigint")),
        F.try_to_timestamp(text),
    )
