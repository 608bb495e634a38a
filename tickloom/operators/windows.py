"""Event-time aggregates over trades.

All of these work on a stream and on a batch. Group keys always include a time window, and
every aggregate has a partial step, so a symbol that holds most of the trades is reduced
inside each task before anything is shuffled. Widths and slides are whole seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _window(column: str, width: int, slide: int | None = None) -> Column:
    slide = slide or width
    return F.window(column, f"{width} seconds", f"{slide} seconds")


def _round(value: str | Column, digits: int) -> Column:
    """Round a sum or mean of doubles so that ties do not depend on the order of merging.

    The last bits of such a value vary with how rows were split over tasks. Where the exact
    value is a tie, they would decide the result, so they are rounded away first.
    """
    return F.round(F.round(value, digits + 4), digits)


def vwap(trades: DataFrame, width: int = 60) -> DataFrame:
    """Tumbling bar per symbol: vwap, volume, notional, count, low and high."""
    return (
        trades.groupBy(_window("event_ts", width), "symbol")
        .agg(
            F.sum("notional").alias("n"),
            F.sum("qty_d").alias("q"),
            F.count("*").alias("trade_count"),
            F.min("price_d").alias("low"),
            F.max("price_d").alias("high"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            _round(F.try_divide("n", "q"), 4).alias("vwap_usd"),
            _round("q", 6).alias("total_volume"),
            _round("n", 2).alias("total_notional_usd"),
            "trade_count",
            F.round("low", 4).alias("low_usd"),
            F.round("high", 4).alias("high_usd"),
        )
    )


def whales(trades: DataFrame, threshold: float = 50000.0) -> DataFrame:
    """Single trades worth at least ``threshold``."""
    return trades.filter(F.col("notional") >= threshold).select(
        "event_ts",
        "symbol",
        "trade_id",
        F.round("price_d", 4).alias("price_usd"),
        F.round("qty_d", 8).alias("quantity"),
        F.round("notional", 2).alias("notional_usd"),
        "side",
    )


def _in_panes(trades: DataFrame, width: int, slide: int, final: bool) -> bool:
    """Whether sliding windows are made of panes one slide wide, which are copied in place of trades.

    A stream in update mode cannot aggregate its own updates, so it copies trades. In append mode
    (``final``) the panes are a first aggregate with state, whose closed rows a second one takes.
    """
    return width % slide == 0 and (final or not trades.isStreaming)


def _of_panes(panes: DataFrame, width: int, slide: int) -> DataFrame:
    """Panes, each once for every window it lies in. The time of a pane carries the watermark on."""
    return panes.withColumn("window", _window("pane", width, slide))


def _sliding_sums(
    trades: DataFrame, width: int, slide: int, keys: list[str], sums: dict[str, Column], final: bool
) -> DataFrame:
    """Counts and sums per sliding window."""
    named = [value.alias(name) for name, value in sums.items()]
    if not _in_panes(trades, width, slide, final):
        return trades.groupBy(_window("event_ts", width, slide), *keys).agg(*named)
    panes = trades.groupBy(_window("event_ts", slide).alias("pane"), *keys).agg(*named)
    return (
        _of_panes(panes, width, slide)
        .groupBy("window", *keys).agg(*(F.sum(name).alias(name) for name in sums))
    )


def velocity(
    trades: DataFrame, width: int = 60, slide: int = 30, final: bool = False
) -> DataFrame:
    """Sliding count, volume and notional per symbol and aggressor side.

    ``final`` is for a stream in append mode: closed windows only, made of panes. A trade is then late
    when its pane is closed, not its last window.
    """
    sums = {"trade_count": F.count("*"), "q": F.sum("qty_d"), "n": F.sum("notional")}
    return (
        _sliding_sums(trades, width, slide, ["symbol", "side"], sums, final)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            "side",
            "trade_count",
            _round("q", 6).alias("volume"),
            _round("n", 2).alias("notional_usd"),
        )
    )


def moving_avg(
    trades: DataFrame, width: int = 120, slide: int = 10, flag: float = 0.001, final: bool = False
) -> DataFrame:
    """Sliding mean and sample deviation of the price, with a volatility flag.

    ``final`` is for a stream in append mode, as in ``velocity``.
    """
    if not _in_panes(trades, width, slide, final):
        stats = trades.groupBy(_window("event_ts", width, slide), "symbol").agg(
            F.avg("price_d").alias("sma"),
            F.stddev_samp("price_d").alias("sd"),
            F.count("*").alias("sample_count"),
        )
    else:
        stats = _moving_stats(trades, width, slide)
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        _round("sma", 4).alias("sma_usd"),
        _round("sd", 6).alias("price_stddev_usd"),
        "sample_count",
        F.when(F.try_divide("sd", "sma") > flag, "HIGH-VOLATILITY")
        .otherwise("NORMAL").alias("volatility_flag"),
    )


def _moving_stats(trades: DataFrame, width: int, slide: int) -> DataFrame:
    """Mean and deviation per sliding window, from panes one slide wide.

    A sliding window copies each input row ``width / slide`` times, 12 times by default. Here
    panes are copied instead of trades.
    """
    panes = _of_panes(
        trades.groupBy(_window("event_ts", slide).alias("pane"), "symbol").agg(
            F.count("*").alias("rows"),
            F.count("price_d").alias("n"),
            F.avg("price_d").alias("mean"),
            F.var_pop("price_d").alias("variance"),
        ), width, slide)
    # The centre of a window's panes is found first and deviations are summed around it; sums of raw
    # squares would cancel at high prices. A batch does that by a window function. A stream has none,
    # and gathers the panes instead: at most width / slide share a window.
    n, mean, centre = F.col("n"), F.col("mean"), F.col("centre")
    if panes.isStreaming:
        return _gathered_stats(panes)
    per_window = Window.partitionBy("window", "symbol")
    return (
        panes.withColumn(
            "centre",
            F.try_divide(F.sum(n * mean).over(per_window), F.sum(n).over(per_window)),
        )
        .groupBy("window", "symbol")
        .agg(
            F.max("centre").alias("sma"),
            F.sum("n").alias("n"),
            F.sum(n * (F.col("variance") + F.pow(mean - centre, 2))).alias("spread"),
            F.sum("rows").alias("sample_count"),
        )
        .withColumn("sd", F.when(n > 1, F.sqrt(F.col("spread") / (n - 1))))
    )


def _gathered_stats(panes: DataFrame) -> DataFrame:
    n = F.col("n")

    def total(value) -> Column:
        return F.aggregate("panes", F.lit(0.0), lambda so_far, pane: so_far + value(pane))

    filled = F.filter(F.collect_list(F.struct("n", "mean", "variance")), lambda pane: pane["n"] > 0)
    return (
        panes.groupBy("window", "symbol")
        .agg(F.sum("rows").alias("sample_count"), F.sum("n").alias("n"), filled.alias("panes"))
        .withColumn("sma", F.try_divide(total(lambda pane: pane["n"] * pane["mean"]), n))
        .withColumn("spread", total(
            lambda pane: pane["n"] * (pane["variance"] + F.pow(pane["mean"] - F.col("sma"), 2))))
        .withColumn("sd", F.when(n > 1, F.sqrt(F.col("spread") / (n - 1))))
    )


def ohlcv(trades: DataFrame, width: int = 60) -> DataFrame:
    """Extension: bar with open and close, ordered by event time and then trade id.

    The order is one number of fixed width, so that the aggregate is by hash and sorts nothing. A
    trade without an id comes first in its microsecond.
    """
    order = (
        F.unix_micros("event_ts").cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)")
        + F.coalesce("trade_id", F.lit(-1)).cast("decimal(19,0)")
    )
    return (
        trades.groupBy(_window("event_ts", width), "symbol")
        .agg(
            F.min_by("price_d", order).alias("open"),
            F.max("price_d").alias("high"),
            F.min("price_d").alias("low"),
            F.max_by("price_d", order).alias("close"),
            F.sum("qty_d").alias("volume"),
            F.count("*").alias("trade_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            F.round("open", 4).alias("open_usd"),
            F.round("high", 4).alias("high_usd"),
            F.round("low", 4).alias("low_usd"),
            F.round("close", 4).alias("close_usd"),
            _round("volume", 6).alias("total_volume"),
            "trade_count",
        )
    )


def order_flow_imbalance(
    trades: DataFrame, width: int = 60, slide: int = 30, final: bool = False
) -> DataFrame:
    """Extension: buy against sell volume per sliding window, from -1 to 1; ``final`` as in ``velocity``."""
    def volume(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("qty_d")).otherwise(0.0))

    buy, sell = F.col("buy_volume"), F.col("sell_volume")
    sums = {"buy": volume("BUY"), "sell": volume("SELL")}
    return (
        _sliding_sums(trades, width, slide, ["symbol"], sums, final)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            _round("buy", 6).alias("buy_volume"),
            _round("sell", 6).alias("sell_volume"),
        )
        .withColumn("imbalance", F.round(F.try_divide(buy - sell, buy + sell), 4))
    )


DAY_S = 86400


def high_low_24h(bars: DataFrame, span: int = DAY_S, width: int = 60) -> DataFrame:
    """Extension: high and low over the ``span`` seconds that end with each bar.

    A range frame over a symbol's whole history would put that history into one task and
    revisit every bar of the span for every row. Here time is cut into chunks one span long.
    A bar's look-back covers the start of its own chunk and the tail of the one before, so
    each bar is also handed to the next chunk, and both parts are running extremes over
    groups of at most two spans.
    """
    start = F.unix_seconds("window_start")
    reach = span - width
    chunked = bars.withColumn("at", start).withColumn(
        "role",
        F.explode(F.array(
            F.struct(F.lit(True).alias("own"), F.floor(start / span).alias("chunk")),
            F.struct(F.lit(False).alias("own"), (F.floor(start / span) + 1).alias("chunk")),
        )),
    ).select("*", "role.own", "role.chunk").drop("role")
    # A carried bar stays in view up to and including ``at + reach``.
    due = chunked.withColumn(
        "due", F.when(F.col("own"), F.col("at")).otherwise(F.col("at") + reach)
    )
    group = ["symbol", "chunk"]
    own, carried = F.col("own"), ~F.col("own")
    before = Window.partitionBy(*group).orderBy("at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*group).orderBy(F.desc("due")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        due.select(
            "*",
            F.max(F.when(own, F.col("high_usd"))).over(before).alias("own_high"),
            F.min(F.when(own, F.col("low_usd"))).over(before).alias("own_low"),
        )
        .select(
            "*",
            F.max(F.when(carried, F.col("high_usd"))).over(after).alias("carried_high"),
            F.min(F.when(carried, F.col("low_usd"))).over(after).alias("carried_low"),
        )
        .filter("own")
        .select(
            "symbol",
            "window_start",
            F.greatest("own_high", "carried_high").alias("high_24h_usd"),
            F.least("own_low", "carried_low").alias("low_24h_usd"),
        )
    )
