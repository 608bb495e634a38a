"""Raw trade frames derived from a generic click-stream ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values of the derivation: event type -> symbol and base price.
EVENT_SYMBOLS = [
    ("click", "BTCUSDT", 78000),
    ("view", "ETHUSDT", 3000),
    ("purchase", "BNBUSDT", 650),
    ("signup", "SOLUSDT", 150),
]
OTHER_SYMBOL, OTHER_BASE = "FOOUSDT", 2
EPOCH_MS = 1704067200000  # 2024-01-01 00:00:00 UTC
TIME_SQUEEZE = 360        # 30 days of events become 2 hours of trades
TICKER_EVERY = 50         # every 50th frame is a ticker frame, which the parser must drop


def frames_from_events(events: DataFrame, squeeze: int = TIME_SQUEEZE) -> DataFrame:
    """One JSON frame per event, as the ``value`` bytes a Kafka record would hold.

    ``squeeze`` seconds between events become one between trades.
    """
    kind = F.col("event_type")
    symbol, base = F.lit(OTHER_SYMBOL), F.lit(OTHER_BASE)
    for event_type, name, price in reversed(EVENT_SYMBOLS):
        symbol = F.when(kind == event_type, name).otherwise(symbol)
        base = F.when(kind == event_type, price).otherwise(base)
    lots = F.get_json_object("props", "$.k").try_cast("int") + 1
    # Both ends are wall-clock times of a session in UTC.
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    elapsed_us = F.timestamp_diff("MICROSECOND", start, F.col("ts").cast("timestamp_ntz"))
    trade_ms = EPOCH_MS + F.floor(elapsed_us / (1000 * squeeze))
    return events.select(
        F.to_json(
            F.struct(
                F.when(F.col("event_id") % TICKER_EVERY == 0, "24hrTicker")
                .otherwise("trade").alias("e"),
                symbol.alias("s"),
                F.col("event_id").alias("t"),
                (base + F.col("value")).cast("decimal(18,8)").cast("string").alias("p"),
                (lots / 100.0).cast("decimal(18,8)").cast("string").alias("q"),
                trade_ms.alias("T"),
                (F.col("user_id") % 2 == 0).alias("m"),
            )
        ).cast("binary").alias("value")
    )
