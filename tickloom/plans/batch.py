"""Registered batch queries."""

from __future__ import annotations

from datetime import datetime, timedelta
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import operators as op
from tickloom.functions import (
    decode_double, decode_long, decode_text, parse_mixed_ts, row_key,
)
from tickloom.plans.inputs import AS_OF, frames, trades
from tickloom.schema import TRACKED_SYMBOLS
from tickloom.sources import (
    load_symbol_metadata, publish_symbol_metadata, symbol_metadata, symbol_reference,
    tracked_symbols,
)
from tickloom.sources.events import EVENT_SYMBOLS, OTHER_SYMBOL
from tickloom.streaming.scratch import scratch
from tickloom.streaming.sinks import (
    create_bars_table, create_trades_table, keyed_bar_writer, keyed_trade_writer, read_keyed_bars,
    read_keyed_trades, read_newest_trades, read_recent_trades, table_bar_writer, table_trade_writer,
)


# Trade 777 belongs to one of these, depending on the data.
LOOKUP_ID = 777
LOOKUP_SYMBOLS = [row[1] for row in EVENT_SYMBOLS] + [OTHER_SYMBOL]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.vwap(trades(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trade_cells(op.enrich_trades(trades(spark, sf_dir), symbol_metadata(spark)))


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written out and read back, for a query that passes over them more than once.

    Computing them anew for each pass would parse every frame again.
    """
    path = scratch(spark, name)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _with_trade_counts(spark: SparkSession, sf_dir: str, symbols: DataFrame, key: str):
    counts = trades(spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("trades"))
    return (
        symbols.withColumnRenamed(key, "symbol").join(counts, "symbol", "left")
        .withColumn("trades", F.coalesce("trades", F.lit(0).cast("bigint")))
    )


def parse_trades(spark, sf_dir):
    return trades(spark, sf_dir)


def frame_type_counts(spark, sf_dir):
    return op.frame_type_counts(frames(spark, sf_dir))


def reference_coverage(spark, sf_dir):
    return _with_trade_counts(spark, sf_dir, symbol_reference(spark), "ref_symbol")


def metadata_coverage(spark, sf_dir):
    path = scratch(spark, "symbol-metadata")
    publish_symbol_metadata(spark, path)
    return _with_trade_counts(spark, sf_dir, load_symbol_metadata(spark, path), "symbol")


def tracked_coverage(spark, sf_dir):
    return _with_trade_counts(spark, sf_dir, tracked_symbols(spark), "symbol")


def whale_alerts(spark, sf_dir):
    return op.whales(trades(spark, sf_dir))


def row_keys(spark, sf_dir):
    t = trades(spark, sf_dir)
    minute = F.date_trunc("minute", "event_ts")
    return t.select(
        "symbol",
        "trade_id",
        row_key(F.col("symbol"), F.col("trade_id"), 20).alias("trade_key"),
        row_key(F.col("symbol"), F.unix_seconds(minute), 15).alias("bar_key"),
    )


def decode_cells(spark, sf_dir):
    f = op.parse_frames(frames(spark, sf_dir))
    missing = F.when(F.col("buyer_is_maker"), F.col("qty"))
    return f.select(
        "trade_id",
        decode_double(F.col("price")).alias("price"),
        decode_double(missing).alias("qty_or_zero"),
        decode_double(F.col("event_type")).alias("bad_number"),
        decode_long(F.col("trade_id").cast("string")).alias("id"),
        decode_long(F.col("price")).alias("fraction_as_long"),
        decode_text(missing).alias("text"),
    )


def mixed_timestamps(spark, sf_dir):
    t = trades(spark, sf_dir)
    text = (
        F.when(F.col("trade_id") % 3 == 0, F.col("trade_ms").cast("string"))
        .when(F.col("trade_id") % 3 == 1,
              F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(F.col("symbol"))
    )
    return t.select("trade_id", text.alias("text")).withColumn(
        "parsed", parse_mixed_ts(F.col("text")))


def vwap_1min(spark, sf_dir):
    return op.vwap_with_class(trades(spark, sf_dir), symbol_reference(spark))


def trades_enriched(spark, sf_dir):
    return op.enrich_trades(trades(spark, sf_dir), symbol_metadata(spark))


def vwap_enriched(spark, sf_dir):
    return op.enrich_bars(bars(spark, sf_dir), symbol_metadata(spark))


def trade_velocity(spark, sf_dir):
    return op.velocity(trades(spark, sf_dir))


def moving_avg(spark, sf_dir):
    return op.moving_avg(trades(spark, sf_dir))


def _put_trades(spark, sf_dir) -> str:
    path = scratch(spark, "keyed-trades")
    keyed_trade_writer(symbol_metadata(spark), path)(trades(spark, sf_dir), 0)
    return path


def _put_bars(spark, rows) -> str:
    path = scratch(spark, "keyed-bars")
    keyed_bar_writer(symbol_metadata(spark), path)(rows, 0)
    return path


def _stored_bars(spark, path, lookback: timedelta) -> DataFrame:
    """Stored bars from the day on that the look-back reaches."""
    return read_keyed_bars(spark, path, (datetime.fromisoformat(AS_OF) - lookback).date())


def _range(spark, path):
    return op.vwap_range(_stored_bars(spark, path, timedelta(minutes=60)), "btcusdt", AS_OF, 60)


def _recent(spark, path):
    return read_recent_trades(spark, path, "btcusdt", 30)


def _lookup(spark, path):
    keys = [f"{symbol}#{LOOKUP_ID:020d}" for symbol in LOOKUP_SYMBOLS]
    return op.trade_lookup(read_keyed_trades(spark, path), *keys)


def _latest(spark, path):
    return op.latest_bar(_stored_bars(spark, path, timedelta(seconds=180)), AS_OF)


def _summary(spark, path):
    kept = _stored_bars(spark, path, timedelta(seconds=180))
    return op.summary(kept, tracked_symbols(spark), symbol_metadata(spark), AS_OF)


def _put_market(spark, sf_dir) -> tuple[str, str]:
    table = _in_table(
        spark, "trades", create_trades_table, table_trade_writer, trades(spark, sf_dir))
    return table, _put_bars(spark, op.vwap(spark.table(table)))


def _card(spark, stored):
    """The newest trade comes from the newest stored days of the tracked symbols, of which three columns are read."""
    table, path = stored
    newest = read_newest_trades(spark, table, TRACKED_SYMBOLS.split(",")).withColumn(
        "trade_ms", F.unix_millis("event_ts"))
    kept = _stored_bars(spark, path, timedelta(seconds=180))
    return op.symbol_card(kept, newest, tracked_symbols(spark), symbol_metadata(spark), AS_OF)


def _display(spark, path):
    return op.trade_display(_recent(spark, path))


def _all_bars(spark, sf_dir) -> str:
    return _put_bars(spark, bars(spark, sf_dir))


# Serving reads: what stores their rows, and what reads the store.
READS = {
    "vwap_range": (_all_bars, _range),
    "recent_trades": (_put_trades, _recent),
    "trade_lookup": (_put_trades, _lookup),
    "latest_bar": (_all_bars, _latest),
    "summary": (_all_bars, _summary),
    "symbol_card": (_put_market, _card),
    "trade_display": (_put_trades, _display),
}


def _stored_first(store, read):
    return lambda spark, sf_dir: read(spark, store(spark, sf_dir))


def pair_info(spark, sf_dir):
    symbols = trades(spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("trades"))
    return op.pair_info(symbols, symbol_metadata(spark))


def price_series(spark, sf_dir):
    return op.price_series(stored(spark, bars(spark, sf_dir), "bars"))


def price_axis(spark, sf_dir):
    return op.price_axis(bars(spark, sf_dir))


def volume_share(spark, sf_dir):
    return op.volume_share(stored(spark, bars(spark, sf_dir), "bars"))


def volume_labels(spark, sf_dir):
    return op.volume_labels(bars(spark, sf_dir))


def _in_table(spark, name, create, writer, rows) -> str:
    table = f"tickloom_{name}_{uuid.uuid4().hex[:12]}"
    create(spark, table, scratch(spark, name))
    writer(table)(rows, 0)
    return table


def latest_trades_sql(spark, sf_dir):
    table = _in_table(
        spark, "trades", create_trades_table, table_trade_writer, trades(spark, sf_dir))
    return spark.sql(f"""
        SELECT trade_id, event_ts, price_d, qty_d, notional, side, symbol, trade_date
        FROM {table}
        WHERE symbol = 'BTCUSDT' AND trade_date = DATE '2024-01-01'
        ORDER BY event_ts DESC, trade_id DESC LIMIT 100
    """)


def latest_bars_sql(spark, sf_dir):
    table = _in_table(spark, "bars", create_bars_table, table_bar_writer, bars(spark, sf_dir))
    return spark.sql(f"""
        SELECT window_start, vwap_usd, trade_count
        FROM {table} WHERE symbol = 'ETHUSDT'
        ORDER BY window_start DESC LIMIT 60
    """)


def ohlcv_1min(spark, sf_dir):
    return op.ohlcv(trades(spark, sf_dir))


def high_low_24h(spark, sf_dir):
    return op.high_low_24h(bars(spark, sf_dir))


def order_flow_imbalance(spark, sf_dir):
    return op.order_flow_imbalance(trades(spark, sf_dir))


QUERIES = {
    "vwap_bars": bars,
    "parse_trades": parse_trades,
    "frame_type_counts": frame_type_counts,
    "symbol_reference": reference_coverage,
    "symbol_metadata_scan": metadata_coverage,
    "tracked_symbols": tracked_coverage,
    "whale_alerts": whale_alerts,
    "row_keys": row_keys,
    "trade_cells": cells,
    "decode_cells": decode_cells,
    "parse_mixed_ts": mixed_timestamps,
    "vwap_1min": vwap_1min,
    "trades_enriched": trades_enriched,
    "vwap_enriched": vwap_enriched,
    "trade_velocity": trade_velocity,
    "moving_avg": moving_avg,
    "vwap_range": _stored_first(*READS["vwap_range"]),
    "recent_trades": _stored_first(*READS["recent_trades"]),
    "trade_lookup": _stored_first(*READS["trade_lookup"]),
    "latest_bar": _stored_first(*READS["latest_bar"]),
    "summary": _stored_first(*READS["summary"]),
    "symbol_card": _stored_first(*READS["symbol_card"]),
    "pair_info": pair_info,
    "price_series": price_series,
    "price_axis": price_axis,
    "volume_share": volume_share,
    "volume_labels": volume_labels,
    "trade_display": _stored_first(*READS["trade_display"]),
    "latest_trades_sql": latest_trades_sql,
    "latest_bars_sql": latest_bars_sql,
    "ohlcv_1min": ohlcv_1min,
    "high_low_24h": high_low_24h,
    "order_flow_imbalance": order_flow_imbalance,
}
