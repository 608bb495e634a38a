"""Reductions behind the dashboard's charts, for all symbols at once.

They take any set of bars: one screen of them or a whole history. None of them needs all
bars of a symbol in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions import (
    compact_notional, compact_volume, known, money, price_label, price_label_fine,
)

DAY_S = 86400


def price_series(bars: DataFrame) -> DataFrame:
    """Zero-based position of each bar in its symbol's time order, with thinned labels.

    Positions are counted inside (symbol, day), a group of at most 1,440 one-minute bars, and
    shifted by the number of bars on earlier days, so a long history is not sorted in one task.
    """
    day = F.floor(F.unix_seconds("window_start") / DAY_S).alias("day")
    dated = bars.select("symbol", "window_start", "vwap_usd", day)
    earlier_days = Window.partitionBy("symbol").orderBy("day").rowsBetween(
        Window.unboundedPreceding, -1)
    days = (
        dated.groupBy("symbol", "day").agg(F.count("*").alias("n"))
        .select(
            "symbol", "day",
            F.coalesce(F.sum("n").over(earlier_days), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy("symbol")).alias("bars"),
        )
    )
    within = F.row_number().over(Window.partitionBy("symbol", "day").orderBy("window_start"))
    step = (
        F.when(F.col("bars") <= 10, 1).when(F.col("bars") <= 20, 2)
        .when(F.col("bars") <= 40, 5).otherwise(10)
    )
    return (
        dated.withColumn("within", within)
        .join(days, ["symbol", "day"])
        .select(
            "symbol",
            (F.col("before") + F.col("within") - 1).alias("idx"),
            "window_start",
            "vwap_usd",
            step.alias("label_step"),
        )
        .withColumn(
            "label",
            F.when(F.col("idx") % F.col("label_step") == 0,
                   F.date_format("window_start", "HH:mm")),
        )
    )


def price_axis(bars: DataFrame) -> DataFrame:
    """Price range per symbol, padded by 5 % of the range, or by 1 when it is flat."""
    low, high = F.col("low"), F.col("high")
    padding = F.when(high - low == 0, 1.0).otherwise((high - low) * 0.05)
    return (
        bars.groupBy("symbol")
        .agg(F.min("vwap_usd").alias("low"), F.max("vwap_usd").alias("high"))
        .select(
            "symbol",
            F.round(low - padding, 6).alias("axis_min"),
            F.round(high + padding, 6).alias("axis_max"),
        )
    )


def volume_share(bars: DataFrame) -> DataFrame:
    """Each bar's notional as a share of the symbol's largest, and the top of the axis.

    Symbols whose largest bar is zero have nothing to plot and are left out.
    """
    peak = (
        bars.groupBy("symbol").agg(F.max("total_notional_usd").alias("peak"))
        .filter(F.col("peak") != 0)
    )
    return bars.join(peak, "symbol").select(
        "symbol",
        "window_start",
        "total_notional_usd",
        F.round(F.col("total_notional_usd") / F.col("peak"), 6).alias("share"),
        F.round(F.col("peak") * 1.1, 4).alias("axis_max"),
    )


def volume_labels(bars: DataFrame) -> DataFrame:
    """Axis and card labels of each bar."""
    return bars.select(
        "symbol",
        "window_start",
        compact_notional(F.col("total_notional_usd")).alias("notional_label"),
        compact_volume(F.col("total_volume")).alias("volume_label"),
        price_label(F.col("vwap_usd")).alias("vwap_label"),
        F.date_format("window_start", "HH:mm").alias("time_label"),
    )


def trade_display(cells: DataFrame, rows: int = 20) -> DataFrame:
    """First rows of a newest-first trade list, as shown. Takes ``trade_cells`` columns."""
    return (
        cells.orderBy(F.desc("trade_id")).limit(rows)
        .select(
            "symbol",
            "trade_id",
            (F.col("side") == "BUY").alias("is_buy"),
            price_label_fine(F.col("price")).alias("price_label"),
            F.format_string("%.6f", F.col("qty")).alias("qty_label"),
            money(F.col("notional")).alias("notional_label"),
            F.date_format(F.timestamp_millis("trade_ts"), "HH:mm:ss").alias("time_label"),
            known(F.col("asset_category")).alias("category"),
        )
    )
