"""Row keys and display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zfill(number: Column, width: int) -> Column:
    """Left-pad with zeros. ``lpad`` alone would cut values longer than ``width``."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def row_key(symbol: Column, number: Column, width: int) -> Column:
    """``SYMBOL#000…n``: sorts as text in the order of (symbol, n). Null if either part is."""
    return F.concat(symbol, F.lit("#"), zfill(number, width))


def known(text: Column) -> Column:
    """Null for a value that should not be displayed: empty or ``Unknown``."""
    return F.nullif(F.nullif(text, F.lit("")), F.lit("Unknown"))


def _scaled(value: Column, divisor: float, digits: int, suffix: str) -> Column:
    return F.format_string(f"%.{digits}f{suffix}", value / F.lit(divisor))


def compact_notional(value: Column) -> Column:
    """Volume-axis label: B, M and K with one decimal, whole units below 1,000."""
    return (
        F.when(value >= 1e9, _scaled(value, 1e9, 1, "B"))
        .when(value >= 1e6, _scaled(value, 1e6, 1, "M"))
        .when(value >= 1e3, _scaled(value, 1e3, 1, "K"))
        .otherwise(_scaled(value, 1.0, 0, ""))
    )


def compact_volume(value: Column) -> Column:
    """Volume-card label: M and K with two decimals, four decimals below 1,000."""
    return (
        F.when(value >= 1e6, _scaled(value, 1e6, 2, "M"))
        .when(value >= 1e3, _scaled(value, 1e3, 2, "K"))
        .otherwise(_scaled(value, 1.0, 4, ""))
    )


def _number(value: Column, pattern: str) -> Column:
    # format_number takes a pattern in SQL; the Python wrapper only takes a digit count.
    return F.call_function("format_number", value, F.lit(pattern))


def price_label(value: Column) -> Column:
    return F.concat(F.lit("$"), _number(F.round(value, 2), "#,##0.##"))


def price_label_fine(value: Column) -> Column:
    return F.concat(F.lit("$"), _number(F.round(value, 4), "#,##0.####"))


def money(value: Column) -> Column:
    return F.concat(F.lit("$"), _number(F.round(value, 2), "#,##0.00"))
