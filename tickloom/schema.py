"""Schemas and fixed reference values.

Everything is explicit: nothing in this package infers a schema from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Exchange trade frame, as it arrives: JSON field, our name, type. Our names differ by more than
# their case. Price and quantity are text. All fields may be missing.
FRAME_FIELDS = [
    ("e", "event_type", T.StringType()),
    ("E", "event_ms", T.LongType()),
    ("s", "symbol", T.StringType()),
    ("t", "trade_id", T.LongType()),
    ("p", "price", T.StringType()),
    ("q", "qty", T.StringType()),
    ("b", "buyer_order_id", T.LongType()),
    ("a", "seller_order_id", T.LongType()),
    ("T", "trade_ms", T.LongType()),
    ("m", "buyer_is_maker", T.BooleanType()),
    ("M", "ignore_flag", T.BooleanType()),
]

RAW_SCHEMA = T.StructType([T.StructField("value", T.BinaryType())])

# Symbol, base, quote, market-cap rank, asset class.
REFERENCE_ROWS = [
    ("BTCUSDT", "BTC", "USDT", 1, "Layer-1"),
    ("ETHUSDT", "ETH", "USDT", 2, "Layer-1"),
    ("BNBUSDT", "BNB", "USDT", 4, "Exchange-token"),
    ("SOLUSDT", "SOL", "USDT", 5, "Layer-1"),
    ("XRPUSDT", "XRP", "USDT", 6, "Payment"),
]

METADATA_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("base_asset", T.StringType()),
    T.StructField("quote_asset", T.StringType()),
    T.StructField("asset_category", T.StringType()),
    T.StructField("market_cap_tier", T.StringType()),
    T.StructField("description", T.StringType()),
])

# Base asset, category, tier, description. The quote asset is USDT throughout.
METADATA_ROWS = [
    ("BTC", "Layer1", "Large Cap", "Bitcoin, the first proof-of-work coin"),
    ("ETH", "Layer1", "Large Cap", "Ethereum, a general smart-contract chain"),
    ("BNB", "Exchange Token", "Large Cap", "Utility token of an exchange and its chain"),
    ("SOL", "Layer1", "Large Cap", "Solana, a chain built for throughput"),
    ("XRP", "Payments", "Large Cap", "XRP, a cross-border settlement coin"),
    ("ADA", "Layer1", "Mid Cap", "Cardano, a proof-of-stake chain"),
    ("AVAX", "Layer1", "Large Cap", "Avalanche, a chain of custom subnets"),
    ("DOGE", "Meme", "Mid Cap", "Dogecoin, the first meme coin"),
    ("DOT", "Layer0", "Mid Cap", "Polkadot, a relay for parallel chains"),
    ("MATIC", "Layer2", "Mid Cap", "Polygon, a scaling layer over Ethereum"),
    ("LINK", "Oracle", "Mid Cap", "Chainlink, outside data for contracts"),
    ("UNI", "DeFi", "Mid Cap", "Uniswap, an automated market maker"),
    ("LTC", "Layer1", "Mid Cap", "Litecoin, a faster Bitcoin fork"),
    ("ATOM", "Layer0", "Mid Cap", "Cosmos, a hub between chains"),
    ("XLM", "Payments", "Mid Cap", "Stellar, low-cost transfers"),
    ("SHIB", "Meme", "Mid Cap", "Shiba Inu, a meme token on Ethereum"),
    ("NEAR", "Layer1", "Mid Cap", "NEAR, a sharded proof-of-stake chain"),
    ("ALGO", "Layer1", "Small Cap", "Algorand, a proof-of-stake chain"),
    ("FTM", "Layer1", "Small Cap", "Fantom, a chain on a directed graph"),
    ("AAVE", "DeFi", "Mid Cap", "Aave, a lending protocol"),
]

TRACKED_SYMBOLS = "BTCUSDT,ETHUSDT,BNBUSDT,SOLUSDT,XRPUSDT"

# Column lists are in insert order: partition columns come last.
TRADES_TABLE_COLUMNS = [
    ("trade_id", "bigint"), ("event_ts", "timestamp"), ("price_d", "double"),
    ("qty_d", "double"), ("notional", "double"), ("side", "string"),
    ("ingested_at", "timestamp"), ("query_id", "string"), ("batch_id", "bigint"),
    ("symbol", "string"), ("trade_date", "date"),
]
TRADES_TABLE_PARTITIONS = ["symbol", "trade_date"]

BARS_TABLE_COLUMNS = [
    ("window_start", "timestamp"), ("window_end", "timestamp"), ("vwap_usd", "double"),
    ("total_volume", "double"), ("total_notional_usd", "double"), ("trade_count", "bigint"),
    ("low_usd", "double"), ("high_usd", "double"),
    ("ingested_at", "timestamp"), ("query_id", "string"), ("batch_id", "bigint"),
    ("symbol", "string"),
]
BARS_TABLE_PARTITIONS = ["symbol"]

_NAMED = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def _columns(text: str) -> T.StructType:
    pairs = [column.split() for column in text.split(", ")]
    return T.StructType([T.StructField(name, _NAMED[kind]) for name, kind in pairs])


_ENRICHED = ", asset_category string, market_cap_tier string"
KEYED_TRADES = _columns(
    "row_key string, symbol string, trade_id bigint, price double, qty double, notional double, "
    "side string, trade_ts bigint, base_asset string, quote_asset string" + _ENRICHED
    + ", description string")
KEYED_BARS = _columns(
    "row_key string, symbol string, window_start timestamp, window_end timestamp, vwap_usd double, "
    "total_volume double, total_notional_usd double, trade_count bigint, low_usd double, "
    "high_usd double" + _ENRICHED)
