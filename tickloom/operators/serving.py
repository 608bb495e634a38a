"""Reads behind the dashboard. Every clock is an ``as_of`` argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import epoch_seconds, instant, known

AsOf = str | int | float | datetime

BAR_MEASURES = [
    "vwap_usd", "total_volume", "total_notional_usd", "trade_count", "low_usd", "high_usd",
]


def _between(column: str, start: int, stop: int) -> Column:
    return (F.col(column) >= instant(start)) & (F.col(column) < instant(stop))


def recent_bars(bars: DataFrame, as_of: AsOf, seconds: int) -> DataFrame:
    """Bars that start in ``[as_of - seconds, as_of + 60)``."""
    now = epoch_seconds(as_of)
    return bars.filter(_between("window_start", now - seconds, now + 60))


def vwap_range(bars: DataFrame, symbol: str, as_of: AsOf, minutes: int = 60) -> DataFrame:
    """A symbol's bars of the last ``minutes``, oldest first."""
    return (
        recent_bars(bars.filter(F.col("symbol") == symbol.upper()), as_of, minutes * 60)
        .select(
            "symbol", "window_start", "window_end", "vwap_usd", "total_volume",
            F.col("total_notional_usd").alias("total_notional"),
            "trade_count", "low_usd", "high_usd",
        )
        .orderBy("window_start")
    )


def recent_trades(cells: DataFrame, symbol: str, limit: int = 30) -> DataFrame:
    """A symbol's newest trades by trade id, newest first. Takes ``trade_cells`` columns."""
    return (
        cells.filter(F.col("symbol") == symbol.upper())
        .orderBy(F.desc("trade_id")).limit(limit)
    )


def trade_lookup(cells: DataFrame, *keys: str) -> DataFrame:
    """The trades stored under the given row keys; the keys reach the scan of a stored table."""
    return cells.filter(F.col("row_key").isin(*keys))


def latest_bar(bars: DataFrame, as_of: AsOf, lookback_s: int = 180) -> DataFrame:
    """Newest bar per symbol within the look-back; it may still be open.

    Measures are picked one by one with ``max_by``: each buffer is two fixed-width values, so
    this stays a hash aggregate with a partial step.
    """
    picks = [F.max_by(c, "window_start").alias(c) for c in ["window_end", *BAR_MEASURES]]
    return (
        recent_bars(bars, as_of, lookback_s)
        .groupBy("symbol")
        .agg(F.max("window_start").alias("window_start"), *picks)
    )


def summary(
    bars: DataFrame, tracked: DataFrame, metadata: DataFrame, as_of: AsOf, lookback_s: int = 180
) -> DataFrame:
    """Latest bar of every tracked symbol; a symbol without a recent bar is left out."""
    meta = metadata.select("symbol", "asset_category", "market_cap_tier")
    return (
        tracked.join(latest_bar(bars, as_of, lookback_s), "symbol")
        .join(meta, "symbol", "left")
        .select(
            "symbol", "vwap_usd", "high_usd", "low_usd", "trade_count", "total_volume",
            "window_start",
            F.coalesce("asset_category", F.lit("Unknown")).alias("asset_category"),
            F.coalesce("market_cap_tier", F.lit("Unknown")).alias("market_cap_tier"),
        )
    )


def newest_trade(trades: DataFrame) -> DataFrame:
    """Newest trade per symbol by trade id, as a hash aggregate over fixed-width values."""
    return (
        trades.groupBy("symbol")
        .agg(
            F.max("trade_id").alias("trade_id"),
            F.max_by("price_d", "trade_id").alias("price_d"),
            F.max_by("qty_d", "trade_id").alias("qty_d"),
            F.max_by("notional", "trade_id").alias("notional"),
            F.max_by(F.col("side") == "BUY", "trade_id").alias("is_buy"),
            F.max_by("trade_ms", "trade_id").alias("trade_ms"),
        )
    )


def pair_info(symbols: DataFrame, metadata: DataFrame) -> DataFrame:
    """Display name of each pair: from metadata, else the symbol without its quote asset."""
    plain = F.replace(F.col("symbol"), F.lit("USDT"), F.lit(""))
    return symbols.join(metadata, "symbol", "left").select(
        *symbols.columns,
        F.coalesce(F.nullif("base_asset", F.lit("")), plain).alias("base"),
        F.coalesce(F.nullif("quote_asset", F.lit("")), F.lit("USDT")).alias("quote"),
        known(F.col("asset_category")).alias("category"),
        known(F.col("market_cap_tier")).alias("tier"),
        F.coalesce("description", F.lit("")).alias("description"),
    )


def symbol_card(
    bars: DataFrame,
    trades: DataFrame,
    tracked: DataFrame,
    metadata: DataFrame,
    as_of: AsOf,
    lookback_s: int = 180,
) -> DataFrame:
    """Asset banner: latest bar joined to the newest trade and the pair's names."""
    newest = newest_trade(trades).select(
        "symbol", F.col("trade_id").alias("last_trade_id"), F.col("price_d").alias("last_price")
    )
    card = (
        tracked.join(latest_bar(bars, as_of, lookback_s), "symbol")
        .select("symbol", "window_start", "vwap_usd")
        .join(newest, "symbol", "left")
    )
    return pair_info(card, metadata)


def newest_version(versions: DataFrame, *keys: str) -> DataFrame:
    """Newest stored version of each key, by ingest time and then batch."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("ingested_at"), F.desc("batch_id"))
    return (
        versions.withColumn("rn", F.row_number().over(newest_first))
        .filter("rn = 1").drop("rn")
    )


def last_write(versions: DataFrame, *keys: str) -> DataFrame:
    """The last write of each key, by batch and not by clock.

    Batches of one query follow their ids. Of two queries the one that first wrote the key later
    is the later one, and compacted rows come before any batch.
    """
    first = F.min("ingested_at").over(Window.partitionBy(*keys, "query_id"))
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col("batch_id") < 0, F.desc("first"), F.desc("batch_id"))
    return (
        versions.withColumn("first", first)
        .withColumn("rn", F.row_number().over(newest_first)).filter("rn = 1").drop("rn", "first")
    )


def latest_bars(versions: DataFrame) -> DataFrame:
    """Newest version of each bar. A bar has one version per batch that changed it."""
    return newest_version(versions, "symbol", "window_start")
