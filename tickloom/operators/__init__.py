from tickloom.operators.charts import (
    price_axis, price_series, trade_display, volume_labels, volume_share,
)
from tickloom.operators.enrich import (
    bar_cells, enrich_bars, enrich_trades, trade_cells, vwap_with_class,
)
from tickloom.operators.parse import frame_type_counts, parse_frames, parse_trades
from tickloom.operators.rolling import high_low_24h_stream
from tickloom.operators.serving import (
    last_write, latest_bar, latest_bars, newest_trade, newest_version, pair_info, recent_bars, recent_trades,
    summary, symbol_card, trade_lookup, vwap_range,
)
from tickloom.operators.windows import (
    high_low_24h, moving_avg, ohlcv, order_flow_imbalance, velocity, vwap, whales,
)

__all__ = [
    "bar_cells", "enrich_bars", "enrich_trades", "frame_type_counts", "high_low_24h", "high_low_24h_stream",
    "last_write", "latest_bar", "latest_bars", "moving_avg", "newest_trade", "newest_version", "ohlcv",
    "order_flow_imbalance", "pair_info", "parse_frames", "parse_trades", "price_axis",
    "price_series", "recent_bars", "recent_trades", "summary", "symbol_card",
    "trade_cells", "trade_display", "trade_lookup", "velocity", "volume_labels",
    "volume_share", "vwap", "vwap_range", "vwap_with_class", "whales",
]
