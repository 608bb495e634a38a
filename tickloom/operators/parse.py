"""Raw frames to typed trades. The same function serves streams and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.schema import FRAME_FIELDS


def parse_frames(raw: DataFrame, *columns: str) -> DataFrame:
    """Every frame, one column per field; a frame that is not JSON becomes a row of nulls.

    ``columns`` limits the fields that are read; the parser skips the others.

    ``inline`` keeps the parse below any filter on its result. Selecting the struct and then
    filtering on one of its fields makes Catalyst push the filter down together with a second
    copy of ``from_json``, and every frame is parsed twice. The cast renames by position, so
    fields that differ only by case work under the default session settings.
    """
    fields = [f for f in FRAME_FIELDS if not columns or f[1] in columns]
    arrives = T.StructType([T.StructField(json, kind) for json, _, kind in fields])
    renamed = T.StructType([T.StructField(name, kind) for _, name, kind in fields])
    frame = F.from_json(F.col("value").cast("string"), arrives).cast(renamed)
    return raw.select(F.inline(F.array(frame)))


TRADE_FIELDS = [
    "event_type", "symbol", "trade_id", "price", "qty", "trade_ms", "buyer_is_maker",
]


def parse_trades(
    raw: DataFrame,
    lateness: str = "30 seconds",
    event_types: bool = False,
    deduplicate: bool = False,
) -> DataFrame:
    """Trades with event time, numeric price and quantity, notional and aggressor side.

    ``event_types`` keeps the event type column. ``deduplicate`` drops repeats of a
    (symbol, trade id) that arrive within ``lateness``; off by default, so that a trade
    delivered twice counts twice in the aggregates.
    """
    columns = ["event_type"] if event_types else []
    trades = (
        parse_frames(raw, *TRADE_FIELDS)
        .filter(F.col("event_type") == "trade")
        .select(
            *columns,
            "symbol",
            "trade_id",
            "trade_ms",
            F.timestamp_millis("trade_ms").alias("event_ts"),
            F.col("price").try_cast("double").alias("price_d"),
            F.col("qty").try_cast("double").alias("qty_d"),
            F.when(F.col("buyer_is_maker"), "SELL").otherwise("BUY").alias("side"),
        )
        .withColumn("notional", F.col("price_d") * F.col("qty_d"))
        .withWatermark("event_ts", lateness)
    )
    if not deduplicate:
        return trades
    if trades.isStreaming:
        return trades.dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    return trades.dropDuplicates(["symbol", "trade_id"])


def frame_type_counts(raw: DataFrame) -> DataFrame:
    """How many frames of each event type arrived; null is a frame without a type."""
    frames = parse_frames(raw, "event_type")
    return frames.groupBy("event_type").agg(F.count("*").alias("frames"))
