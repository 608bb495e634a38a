"""The registered queries in DuckDB SQL, over the same ``events`` table."""

from __future__ import annotations

from tickloom.plans.inputs import AS_OF, CUTS, DAYS_SQUEEZE
from tickloom.schema import METADATA_ROWS, REFERENCE_ROWS, TRACKED_SYMBOLS
from tickloom.sources.events import (
    EPOCH_MS, EVENT_SYMBOLS, OTHER_BASE, OTHER_SYMBOL, TICKER_EVERY, TIME_SQUEEZE,
)


def _text(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)


def _by_event(index: int, default) -> str:
    cases = " ".join(f"WHEN '{row[0]}' THEN {_text(row[index])}" for row in EVENT_SYMBOLS)
    return f"CASE event_type {cases} ELSE {_text(default)} END"


FRAMES = f"""
frames AS (
  SELECT CASE WHEN event_id % {TICKER_EVERY} = 0 THEN '24hrTicker' ELSE 'trade' END AS kind,
         {_by_event(1, OTHER_SYMBOL)} AS symbol,
         event_id AS trade_id,
         CAST(CAST({_by_event(2, OTHER_BASE)} + value AS DECIMAL(18,8)) AS VARCHAR) AS price,
         CAST(CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) + 1) / 100.0
              AS DECIMAL(18,8)) AS VARCHAR) AS qty,
         {EPOCH_MS} + (epoch_us(ts) // 1000 - {EPOCH_MS}) // {TIME_SQUEEZE} AS trade_ms,
         user_id % 2 = 0 AS maker,
         event_type
  FROM events
)"""

TRADES = f"""{FRAMES},
trades AS (
  SELECT symbol, trade_id, trade_ms, epoch_ms(trade_ms) AS event_ts,
         CAST(price AS DOUBLE) AS price_d, CAST(qty AS DOUBLE) AS qty_d,
         CAST(price AS DOUBLE) * CAST(qty AS DOUBLE) AS notional,
         CASE WHEN maker THEN 'SELL' ELSE 'BUY' END AS side, event_type
  FROM frames WHERE kind = 'trade'
)"""


# Rounds half up on the shortest decimal text of a double, as Spark does.
def _round(value: str, digits: int) -> str:
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


# The last bits of a sum depend on the order of addition; they go before the final rounding.
def _settled(value: str, digits: int) -> str:
    return _round(_round(value, digits + 4), digits)


# Prices and quantities have eight decimals, so these sums are whole numbers, and exact.
_QTY = "CAST(CAST(qty_d AS DECIMAL(19,8)) * 100000000 AS HUGEINT)"
_Q = f"CAST(sum({_QTY}) AS HUGEINT)"
_N = f"CAST(sum(CAST(CAST(price_d AS DECIMAL(19,8)) * 100000000 AS HUGEINT) * {_QTY}) AS HUGEINT)"


def _exact(value: str, unit: str, digits: int) -> str:
    """``value / unit``, of whole numbers from 0 on, rounded half up once."""
    scale = 10 ** digits
    whole = f"(2 * {scale}::HUGEINT * {value} + {unit}) // (2 * {unit})"
    return f"CAST(CASE WHEN {unit} > 0 THEN {whole} END AS DOUBLE) / {scale}"


BAR_COLUMNS = f"""
         {_exact(_N, f'(100000000::HUGEINT * {_Q})', 4)} AS vwap_usd,
         {_exact(_Q, '100000000::HUGEINT', 6)} AS total_volume,
         {_exact(_N, '10000000000000000::HUGEINT', 2)} AS total_notional_usd,
         count(*) AS trade_count,
         {_round('min(price_d)', 4)} AS low_usd,
         {_round('max(price_d)', 4)} AS high_usd"""

MINUTE = "time_bucket(INTERVAL 1 MINUTE, event_ts)"


def _bars(source: str = "trades", where: str = "true") -> str:
    return f"""
  SELECT {MINUTE} AS window_start, {MINUTE} + INTERVAL 1 MINUTE AS window_end, symbol,
         {BAR_COLUMNS}
  FROM {source} WHERE {where} GROUP BY ALL"""


BARS = f"{TRADES}, bars AS ({_bars()})"

REFERENCE = f"""
reference AS (
  SELECT * REPLACE (CAST(mcap_rank AS BIGINT) AS mcap_rank)
  FROM ({_values(REFERENCE_ROWS)})
    AS t(symbol, base_asset, quote_asset, mcap_rank, asset_class)
)"""

METADATA = f"""
metadata AS (
  SELECT base || 'USDT' AS symbol, base AS base_asset, 'USDT' AS quote_asset,
         asset_category, market_cap_tier, description
  FROM ({_values(METADATA_ROWS)})
    AS t(base, asset_category, market_cap_tier, description)
)"""

TRACKED = f"""
tracked AS (SELECT unnest(string_split('{TRACKED_SYMBOLS}', ',')) AS symbol)"""

ENRICHMENT = """
         coalesce(m.base_asset, 'UNKNOWN') AS base_asset,
         coalesce(m.quote_asset, 'UNKNOWN') AS quote_asset,
         coalesce(m.asset_category, 'Unknown') AS asset_category,
         coalesce(m.market_cap_tier, 'Unknown') AS market_cap_tier,
         coalesce(m.description, '') AS description"""

TRADE_KEY = "symbol || '#' || lpad(CAST(trade_id AS VARCHAR), 20, '0')"
CELLS = f"""{TRADES}, {METADATA},
cells AS (
  SELECT x.symbol || '#' || lpad(CAST(trade_id AS VARCHAR), 20, '0') AS row_key,
         x.symbol, trade_id, {_round('price_d', 8)} AS price, {_round('qty_d', 8)} AS qty,
         {_round('notional', 4)} AS notional, side, trade_ms AS trade_ts, {ENRICHMENT}
  FROM trades x LEFT JOIN metadata m ON x.symbol = m.symbol
)"""

NOW = f"TIMESTAMP '{AS_OF}'"


def _recent(seconds: int) -> str:
    return (
        f"window_start >= {NOW} - INTERVAL {seconds} SECOND "
        f"AND window_start < {NOW} + INTERVAL 60 SECOND"
    )


LATEST = f"""
latest AS (
  SELECT * FROM bars WHERE {_recent(180)}
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1
)"""


def _sliding(width: int, slide: int) -> str:
    bucket = f"time_bucket(INTERVAL {slide} SECOND, event_ts)"
    return f"""
sliding AS (
  SELECT *, unnest(generate_series({bucket} - INTERVAL {width - slide} SECOND, {bucket},
                                   INTERVAL {slide} SECOND)) AS window_start
  FROM trades
)"""


VELOCITY = f"""
  SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, symbol, side,
         count(*) AS trade_count, {_settled('sum(qty_d)', 6)} AS volume,
         {_settled('sum(notional)', 2)} AS notional_usd
  FROM sliding GROUP BY ALL"""

# The mean is exact: prices are summed in whole units of 1e-8.
UNITS = "sum(CAST(round(price_d * 100000000) AS BIGINT))::HUGEINT"
MOVING_AVG = f"""WITH {TRADES}, {_sliding(120, 10)}
  SELECT window_start, window_start + INTERVAL 120 SECOND AS window_end, symbol,
         ((2 * {UNITS} + count(*) * 10000) // (2 * count(*) * 10000)) / 10000.0 AS sma_usd,
         {_settled('stddev_samp(price_d)', 6)} AS price_stddev_usd,
         count(*) AS sample_count,
         CASE WHEN stddev_samp(price_d) / avg(price_d) > 0.001
              THEN 'HIGH-VOLATILITY' ELSE 'NORMAL' END AS volatility_flag
  FROM sliding GROUP BY window_start, symbol"""


def _label(value: str, digits: int, suffix: str = "") -> str:
    scaled = f"round(CAST({value} AS DECIMAL(38,12)), {digits})"
    return f"CAST(CAST({scaled} AS DECIMAL(38,{digits})) AS VARCHAR) || '{suffix}'"


def _trimmed(value: str, digits: int) -> str:
    full = f"format('{{:,.{digits}f}}', {_round(value, digits)})"
    return f"'$' || regexp_replace({full}, '\\.?0+$', '')"


def _coverage(table: str, source: str) -> str:
    return f"""WITH {TRADES}, {source},
counts AS (SELECT symbol, count(*) AS trades FROM trades GROUP BY symbol)
  SELECT r.*, coalesce(c.trades, 0) AS trades
  FROM {table} r LEFT JOIN counts c ON r.symbol = c.symbol"""


def _part(trade_ms: str) -> str:
    edges = [EPOCH_MS + 1000 * cut for cut in CUTS]
    return f"CASE WHEN {trade_ms} < {edges[0]} THEN 0 WHEN {trade_ms} < {edges[1]} THEN 1 ELSE 2 END"


LATE = f"(event_type = 'signup' AND trade_ms < {EPOCH_MS + 1000 * CUTS[0]})"

# A version of a bar for each part that touched it, over the trades up to that part.
VERSIONS = f"""WITH {TRADES},
parted AS (SELECT *, {_part('trade_ms')} AS part FROM trades),
touched AS (SELECT DISTINCT symbol, {MINUTE} AS bar, part FROM parted),
fed AS (
  SELECT p.*, t.part AS upto FROM parted p JOIN touched t
  ON p.symbol = t.symbol AND time_bucket(INTERVAL 1 MINUTE, p.event_ts) = t.bar
     AND p.part <= t.part
),
versions AS (
  SELECT {MINUTE} AS window_start, {MINUTE} + INTERVAL 1 MINUTE AS window_end, symbol, upto,
         {BAR_COLUMNS}
  FROM fed GROUP BY ALL
)
  SELECT * EXCLUDE (upto) FROM versions"""

LATEST_BARS = f"WITH {BARS} SELECT * FROM bars"
SLIDING_60 = _sliding(60, 30)
CLOSED = "window_end <= (SELECT max(event_ts) FROM trades) - INTERVAL 30 SECOND"
TRADE_TABLE = f"""WITH {TRADES}
  SELECT trade_id, event_ts, price_d, qty_d, notional, side, symbol,
         CAST(event_ts AS DATE) AS trade_date
  FROM trades"""

ORACLE = {
    "vwap_bars": LATEST_BARS,
    "parse_trades": f"WITH {TRADES} SELECT * EXCLUDE (event_type) FROM trades",
    "frame_type_counts": f"""WITH {FRAMES}
  SELECT kind AS event_type, count(*) AS frames FROM frames GROUP BY kind""",
    "symbol_reference": _coverage("reference", REFERENCE),
    "symbol_metadata_scan": _coverage("metadata", METADATA),
    "tracked_symbols": _coverage("tracked", TRACKED),
    "whale_alerts": f"""WITH {TRADES}
  SELECT event_ts, symbol, trade_id, {_round('price_d', 4)} AS price_usd,
         {_round('qty_d', 8)} AS quantity, {_round('notional', 2)} AS notional_usd, side
  FROM trades WHERE notional >= 50000""",
    "row_keys": f"""WITH {TRADES}
  SELECT symbol, trade_id, {TRADE_KEY} AS trade_key,
         symbol || '#' || lpad(CAST(trade_ms // 60000 * 60 AS VARCHAR), 15, '0') AS bar_key
  FROM trades""",
    "trade_cells": f"WITH {CELLS} SELECT * FROM cells",
    "decode_cells": f"""WITH {FRAMES}
  SELECT trade_id,
         coalesce(TRY_CAST(price AS DOUBLE), 0.0) AS price,
         coalesce(CASE WHEN maker THEN TRY_CAST(qty AS DOUBLE) END, 0.0) AS qty_or_zero,
         CAST(0 AS DOUBLE) AS bad_number, trade_id AS id,
         CAST(0 AS BIGINT) AS fraction_as_long,
         CASE WHEN maker THEN qty ELSE '' END AS text
  FROM frames""",
    "parse_mixed_ts": f"""WITH {TRADES}
  SELECT trade_id,
         CASE trade_id % 3 WHEN 0 THEN CAST(trade_ms AS VARCHAR)
              WHEN 1 THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%g') ELSE symbol END AS text,
         CASE WHEN trade_id % 3 < 2 THEN event_ts END AS parsed
  FROM trades""",
    "vwap_1min": f"""WITH {BARS}, {REFERENCE}
  SELECT bars.*, asset_class, mcap_rank
  FROM bars LEFT JOIN reference USING (symbol)""",
    "trades_enriched": f"""WITH {TRADES}, {METADATA}
  SELECT x.symbol, trade_id, trade_ms, price_d, qty_d, notional, side, {ENRICHMENT}
  FROM trades x LEFT JOIN metadata m ON x.symbol = m.symbol""",
    "vwap_enriched": f"""WITH {BARS}, {METADATA}
  SELECT bars.*, coalesce(m.asset_category, 'Unknown') AS asset_category,
         coalesce(m.market_cap_tier, 'Unknown') AS market_cap_tier
  FROM bars LEFT JOIN metadata m USING (symbol)""",
    "trade_velocity": f"WITH {TRADES}, {SLIDING_60} {VELOCITY}",
    "moving_avg": MOVING_AVG,
    "vwap_range": f"""WITH {BARS}
  SELECT symbol, window_start, window_end, vwap_usd, total_volume,
         total_notional_usd AS total_notional, trade_count, low_usd, high_usd
  FROM bars WHERE symbol = 'BTCUSDT' AND {_recent(3600)}""",
    "recent_trades": f"""WITH {CELLS}
  SELECT * FROM cells WHERE symbol = 'BTCUSDT' ORDER BY trade_id DESC LIMIT 30""",
    "trade_lookup": f"WITH {CELLS} SELECT * FROM cells WHERE trade_id = 777",
    "latest_bar": f"WITH {BARS}, {LATEST} SELECT * FROM latest",
    "summary": f"""WITH {BARS}, {LATEST}, {METADATA}, {TRACKED}
  SELECT symbol, vwap_usd, high_usd, low_usd, trade_count, total_volume, window_start,
         coalesce(m.asset_category, 'Unknown') AS asset_category,
         coalesce(m.market_cap_tier, 'Unknown') AS market_cap_tier
  FROM tracked JOIN latest USING (symbol) LEFT JOIN metadata m USING (symbol)""",
    "symbol_card": f"""WITH {BARS}, {LATEST}, {METADATA}, {TRACKED},
newest AS (
  SELECT symbol, max(trade_id) AS last_trade_id, max_by(price_d, trade_id) AS last_price
  FROM trades GROUP BY symbol
)
  SELECT symbol, window_start, vwap_usd, last_trade_id, last_price,
         coalesce(base_asset, replace(symbol, 'USDT', '')) AS base,
         coalesce(quote_asset, 'USDT') AS quote,
         asset_category AS category, market_cap_tier AS tier,
         coalesce(description, '') AS description
  FROM tracked JOIN latest USING (symbol) LEFT JOIN newest USING (symbol)
       LEFT JOIN metadata USING (symbol)""",
    "pair_info": f"""WITH {TRADES}, {METADATA}
  SELECT symbol, count(*) AS trades,
         coalesce(any_value(base_asset), replace(symbol, 'USDT', '')) AS base,
         coalesce(any_value(quote_asset), 'USDT') AS quote,
         any_value(asset_category) AS category, any_value(market_cap_tier) AS tier,
         coalesce(any_value(description), '') AS description
  FROM trades LEFT JOIN metadata USING (symbol) GROUP BY symbol""",
    "price_series": f"""WITH {BARS},
series AS (
  SELECT symbol, window_start, vwap_usd,
         row_number() OVER (PARTITION BY symbol ORDER BY window_start) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n
  FROM bars
),
stepped AS (
  SELECT * EXCLUDE (n), CAST(CASE WHEN n <= 10 THEN 1 WHEN n <= 20 THEN 2
                                  WHEN n <= 40 THEN 5 ELSE 10 END AS INTEGER) AS label_step
  FROM series
)
  SELECT *, CASE WHEN idx % label_step = 0 THEN strftime(window_start, '%H:%M') END AS label
  FROM stepped""",
    "price_axis": f"""WITH {BARS},
span AS (SELECT symbol, min(vwap_usd) AS low, max(vwap_usd) AS high FROM bars GROUP BY symbol),
padded AS (
  SELECT *, CASE WHEN high - low = 0 THEN CAST(1 AS DOUBLE)
                 ELSE (high - low) * CAST(0.05 AS DOUBLE) END AS padding
  FROM span
)
  SELECT symbol, {_round('low - padding', 6)} AS axis_min,
         {_round('high + padding', 6)} AS axis_max
  FROM padded""",
    "volume_share": f"""WITH {BARS},
peaked AS (
  SELECT *, max(total_notional_usd) OVER (PARTITION BY symbol) AS peak FROM bars
)
  SELECT symbol, window_start, total_notional_usd,
         {_round('total_notional_usd / peak', 6)} AS share,
         {_round('peak * CAST(1.1 AS DOUBLE)', 4)} AS axis_max
  FROM peaked WHERE peak <> 0""",
    "volume_labels": f"""WITH {BARS}
  SELECT symbol, window_start,
         CASE WHEN total_notional_usd >= 1e9 THEN {_label('total_notional_usd / 1e9', 1, 'B')}
              WHEN total_notional_usd >= 1e6 THEN {_label('total_notional_usd / 1e6', 1, 'M')}
              WHEN total_notional_usd >= 1e3 THEN {_label('total_notional_usd / 1e3', 1, 'K')}
              ELSE {_label('total_notional_usd', 0)} END AS notional_label,
         CASE WHEN total_volume >= 1e6 THEN {_label('total_volume / 1e6', 2, 'M')}
              WHEN total_volume >= 1e3 THEN {_label('total_volume / 1e3', 2, 'K')}
              ELSE {_label('total_volume', 4)} END AS volume_label,
         {_trimmed('vwap_usd', 2)} AS vwap_label,
         strftime(window_start, '%H:%M') AS time_label
  FROM bars""",
    "trade_display": f"""WITH {CELLS}
  SELECT symbol, trade_id, side = 'BUY' AS is_buy,
         {_trimmed('price', 4)} AS price_label,
         {_label('qty', 6)} AS qty_label,
         '$' || format('{{:,.2f}}', {_round('notional', 2)}) AS notional_label,
         strftime(epoch_ms(trade_ts), '%H:%M:%S') AS time_label,
         nullif(asset_category, 'Unknown') AS category
  FROM cells WHERE symbol = 'BTCUSDT' ORDER BY trade_id DESC LIMIT 20""",
    "latest_trades_sql": f"""{TRADE_TABLE}
  WHERE symbol = 'BTCUSDT' AND CAST(event_ts AS DATE) = DATE '2024-01-01'
  ORDER BY event_ts DESC, trade_id DESC LIMIT 100""",
    "latest_bars_sql": f"""WITH {BARS}
  SELECT window_start, vwap_usd, trade_count FROM bars
  WHERE symbol = 'ETHUSDT' ORDER BY window_start DESC LIMIT 60""",
    "ohlcv_1min": f"""WITH {TRADES}
  SELECT {MINUTE} AS window_start, {MINUTE} + INTERVAL 1 MINUTE AS window_end, symbol,
         {_round('arg_min(price_d, (event_ts, trade_id))', 4)} AS open_usd,
         {_round('max(price_d)', 4)} AS high_usd,
         {_round('min(price_d)', 4)} AS low_usd,
         {_round('arg_max(price_d, (event_ts, trade_id))', 4)} AS close_usd,
         {_settled('sum(qty_d)', 6)} AS total_volume,
         count(*) AS trade_count
  FROM trades GROUP BY ALL""",
    "high_low_24h": f"""WITH {BARS}
  SELECT symbol, window_start, max(high_usd) OVER day AS high_24h_usd,
         min(low_usd) OVER day AS low_24h_usd
  FROM bars
  WINDOW day AS (PARTITION BY symbol ORDER BY window_start
                 RANGE BETWEEN INTERVAL 86340 SECOND PRECEDING AND CURRENT ROW)""",
    "order_flow_imbalance": f"""WITH {TRADES}, {SLIDING_60}, velocity AS ({VELOCITY}),
sides AS (
  SELECT window_start, window_end, symbol,
         coalesce(sum(volume) FILTER (side = 'BUY'), 0) AS buy_volume,
         coalesce(sum(volume) FILTER (side = 'SELL'), 0) AS sell_volume
  FROM velocity GROUP BY ALL
)
  SELECT *, {_round('(buy_volume - sell_volume) / nullif(buy_volume + sell_volume, 0)', 4)}
            AS imbalance
  FROM sides""",
    "stream_vwap_final": f"WITH {BARS} SELECT * FROM bars WHERE {CLOSED}",
    "stream_vwap_latest": LATEST_BARS,
    "stream_velocity": f"WITH {TRADES}, {SLIDING_60} {VELOCITY}",
    "stream_moving_avg": MOVING_AVG,
    "stream_velocity_final": f"""WITH {TRADES}, {SLIDING_60}, velocity AS ({VELOCITY})
  SELECT * FROM velocity WHERE {CLOSED}""",
    "stream_moving_avg_final": f"""WITH {TRADES} SELECT * FROM ({MOVING_AVG}) WHERE {CLOSED}""",
    "stream_restart": LATEST_BARS,
    "stream_late_drop": f"WITH {TRADES} {_bars(where=f'NOT {LATE}')}",
    "stream_late_counts": f"""WITH {TRADES}
  SELECT count(*) AS seen, count(*) FILTER (NOT {LATE}) AS kept, count(*) FILTER ({LATE}) AS late FROM trades""",
    "stream_open_bars": f"""WITH {TRADES},
fed AS (SELECT * FROM trades WHERE trade_ms < {EPOCH_MS + 1000 * CUTS[1]})
  SELECT DISTINCT {MINUTE} AS window_start, {MINUTE} + INTERVAL 1 MINUTE AS window_end, symbol FROM fed
  WHERE {MINUTE} + INTERVAL 1 MINUTE > (SELECT max(event_ts) FROM fed) - INTERVAL 30 SECOND""",
    "stream_late_kept_rows": f"WITH {TRADES} SELECT symbol, trade_id, event_ts, side FROM trades",
    "stream_four_queries": f"""WITH {BARS}, {SLIDING_60},
long_sliding AS (
  SELECT *, unnest(generate_series(
      time_bucket(INTERVAL 10 SECOND, event_ts) - INTERVAL 110 SECOND,
      time_bucket(INTERVAL 10 SECOND, event_ts), INTERVAL 10 SECOND)) AS window_start
  FROM trades
)
  SELECT 'vwap_1min' AS query_name, count(*) AS rows FROM bars
  UNION ALL SELECT 'trade_velocity_30s', count(DISTINCT (symbol, side, window_start))
  FROM sliding
  UNION ALL SELECT 'whale_alerts', count(*) FROM trades WHERE notional >= 50000
  UNION ALL SELECT 'moving_avg_price', count(DISTINCT (symbol, window_start))
  FROM long_sliding""",
    "raw_frames": f"""WITH {FRAMES}
  SELECT '{{"e":"' || kind || '","s":"' || symbol || '","t":' || trade_id
         || ',"p":"' || price || '","q":"' || qty || '","T":' || trade_ms
         || ',"m":' || CAST(maker AS VARCHAR) || '}}' AS frame
  FROM frames""",
    "raw_replay": f"""WITH {TRADES}
  SELECT symbol, trade_id, event_ts, notional, side FROM trades""",
    "trades_table": TRADE_TABLE,
    "vwap_versions": VERSIONS,
    "vwap_latest_version": LATEST_BARS,
    "trades_keyed": f"WITH {CELLS} SELECT * FROM cells",
    "vwap_keyed": f"""WITH {BARS}, {METADATA}
  SELECT symbol || '#' || lpad(CAST(epoch_ms(window_start) // 1000 AS VARCHAR), 15, '0')
           AS row_key, bars.*,
         coalesce(m.asset_category, 'Unknown') AS asset_category,
         coalesce(m.market_cap_tier, 'Unknown') AS market_cap_tier
  FROM bars LEFT JOIN metadata m USING (symbol)""",
}
# The same trades over three days.
SLOW = BARS.replace(f"// {TIME_SQUEEZE} AS trade_ms", f"// {DAYS_SQUEEZE} AS trade_ms")
ORACLE["stream_high_low_24h"] = ORACLE["high_low_24h"].replace(BARS, SLOW).replace(
    "FROM bars", f"FROM bars WHERE {CLOSED}")
ORACLE["stream_whales"] = ORACLE["whale_alerts"]
