"""Joins of trades and bars with the static symbol tables.

All are left joins on the symbol: a symbol without reference data keeps its rows. The static
side is broadcast by Catalyst when its measured size allows (see ``sources.reference``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import row_key
from tickloom.operators.windows import vwap


def _or(column: str, default: str) -> Column:
    return F.coalesce(F.col(f"m.{column}"), F.lit(default)).alias(column)


def vwap_with_class(trades: DataFrame, reference: DataFrame, width: int = 60) -> DataFrame:
    """Bars labelled with asset class and market-cap rank; null for an unlisted symbol.

    Both labels depend on the symbol alone, so they are joined to the bars and not to every
    trade that goes into them.
    """
    bars = vwap(trades, width)
    return bars.join(reference, bars.symbol == reference.ref_symbol, "left").select(
        "window_start", "window_end", "symbol", "asset_class", "mcap_rank", "vwap_usd",
        "total_volume", "total_notional_usd", "trade_count", "low_usd", "high_usd",
    )


def enrich_trades(trades: DataFrame, metadata: DataFrame) -> DataFrame:
    """Trades with pair, category, tier and description, defaulted where unknown."""
    return (
        trades.alias("x")
        .join(metadata.alias("m"), F.col("x.symbol") == F.col("m.symbol"), "left")
        .select(
            "x.symbol", "x.trade_id", "x.trade_ms", "x.price_d", "x.qty_d", "x.notional",
            "x.side",
            _or("base_asset", "UNKNOWN"),
            _or("quote_asset", "UNKNOWN"),
            _or("asset_category", "Unknown"),
            _or("market_cap_tier", "Unknown"),
            _or("description", ""),
        )
    )


def enrich_bars(bars: DataFrame, metadata: DataFrame) -> DataFrame:
    """Bars with category and tier, defaulted where unknown."""
    return (
        bars.alias("x")
        .join(metadata.alias("m"), F.col("x.symbol") == F.col("m.symbol"), "left")
        .select(
            "x.window_start", "x.window_end", "x.symbol", "x.vwap_usd", "x.total_volume",
            "x.total_notional_usd", "x.trade_count", "x.low_usd", "x.high_usd",
            _or("asset_category", "Unknown"),
            _or("market_cap_tier", "Unknown"),
        )
    )


def trade_cells(enriched: DataFrame) -> DataFrame:
    """Enriched trades in keyed-store form: row key, then rounded cells (kept typed)."""
    return enriched.select(
        row_key(F.col("symbol"), F.col("trade_id"), 20).alias("row_key"),
        "symbol",
        "trade_id",
        F.round("price_d", 8).alias("price"),
        F.round("qty_d", 8).alias("qty"),
        F.round("notional", 4).alias("notional"),
        "side",
        F.col("trade_ms").alias("trade_ts"),
        "base_asset", "quote_asset", "asset_category", "market_cap_tier", "description",
    )


def bar_cells(enriched: DataFrame) -> DataFrame:
    """Enriched bars in keyed-store form: row key, then cells."""
    return enriched.select(
        row_key(F.col("symbol"), F.unix_seconds("window_start"), 15).alias("row_key"),
        "symbol", "window_start", "window_end", "vwap_usd", "total_volume",
        "total_notional_usd", "trade_count", "low_usd", "high_usd",
        "asset_category", "market_cap_tier",
    )
