"""Tolerant decoding of stored text cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode_text(cell: Column, default: str = "") -> Column:
    return F.coalesce(cell.cast("string"), F.lit(default))


def decode_double(cell: Column, default: float = 0.0) -> Column:
    return F.coalesce(cell.try_cast("double"), F.lit(default))


def decode_long(cell: Column, default: int = 0) -> Column:
    return F.coalesce(cell.try_cast("bigint"), F.lit(default).cast("bigint"))
