import pytest

from conftest import START_MS, frame
from tickloom import operators as op
from tickloom.sources import (
    load_symbol_metadata, publish_symbol_metadata, symbol_metadata, symbol_reference,
    tracked_symbols,
)

T0 = START_MS // 1000


@pytest.fixture(scope="module")
def market(trades):
    """One bar a minute for three hours, for three symbols."""
    return trades(*[
        frame(60 * minute + 1, symbol, str(100 + minute), "2", 10 * minute + i, minute % 2 == 0)
        for minute in range(180) for i, symbol in enumerate(["BTCUSDT", "ETHUSDT", "FOOUSDT"])
    ]).cache()


@pytest.fixture(scope="module")
def bars(market):
    return op.vwap(market).cache()


def minutes(rows):
    return [(int(r.window_start.timestamp()) - T0) // 60 for r in rows]


def test_reference_tables(spark):
    assert symbol_reference(spark).count() == 5
    assert dict(symbol_reference(spark).dtypes)["mcap_rank"] == "bigint"
    meta = symbol_metadata(spark)
    assert meta.count() == meta.select("symbol").distinct().count() == 20
    row = meta.filter("symbol = 'BNBUSDT'").first()
    assert (row.asset_category, row.market_cap_tier) == ("Exchange Token", "Large Cap")


def test_published_metadata_reads_back(spark, tmp_path):
    path = str(tmp_path / "meta")
    for _ in range(2):  # a second publication replaces the first
        publish_symbol_metadata(spark, path)
    loaded = load_symbol_metadata(spark, path, cache=True)
    assert loaded.is_cached
    assert sorted(loaded.collect()) == sorted(symbol_metadata(spark).collect())
    loaded.unpersist()


def test_tracked_symbols(spark):
    assert [r.symbol for r in tracked_symbols(spark, " btcusdt,\tEthUsdt ,SOLUSDT").collect()] \
        == ["BTCUSDT", "ETHUSDT", "SOLUSDT"]


def test_unlisted_symbol_keeps_its_bars(spark, market):
    rows = op.vwap_with_class(market, symbol_reference(spark)).collect()
    assert len(rows) == 540
    assert {(r.symbol, r.asset_class, r.mcap_rank) for r in rows} == {
        ("BTCUSDT", "Layer-1", 1), ("ETHUSDT", "Layer-1", 2), ("FOOUSDT", None, None)}


def test_enrichment_defaults(spark, market, bars):
    meta = symbol_metadata(spark)
    trade = op.enrich_trades(market, meta).filter("symbol = 'FOOUSDT'").first()
    assert (trade.base_asset, trade.quote_asset, trade.asset_category, trade.market_cap_tier,
            trade.description) == ("UNKNOWN", "UNKNOWN", "Unknown", "Unknown", "")
    bar = op.enrich_bars(bars, meta).filter("symbol = 'FOOUSDT'").first()
    assert (bar.asset_category, bar.market_cap_tier) == ("Unknown", "Unknown")


def test_static_side_is_broadcast_by_its_size(spark, market):
    joined = op.enrich_trades(market, symbol_metadata(spark))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().sparkPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        plan = op.enrich_trades(market, symbol_metadata(spark))._jdf.queryExecution().sparkPlan()
        assert "SortMergeJoin" in plan.toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_is_half_open_and_ordered(bars):
    rows = op.vwap_range(bars, "btcusdt", T0 + 3600, 60).collect()
    assert minutes(rows) == list(range(0, 61))
    assert {r.symbol for r in rows} == {"BTCUSDT"}
    assert minutes(op.vwap_range(bars, "BTCUSDT", T0 + 3630, 1).collect()) == [60, 61]


def test_recent_trades_are_newest_first(spark, market):
    cells = op.trade_cells(op.enrich_trades(market, symbol_metadata(spark)))
    rows = op.recent_trades(cells, "ethusdt", 4).collect()
    assert [r.trade_id for r in rows] == [1791, 1781, 1771, 1761]


def test_lookup_by_row_key(spark, market):
    cells = op.trade_cells(op.enrich_trades(market, symbol_metadata(spark)))
    row = op.trade_lookup(cells, "BTCUSDT#" + "50".zfill(20)).collect()
    assert [(r.symbol, r.trade_id, r.price) for r in row] == [("BTCUSDT", 50, 105.0)]
    assert op.trade_lookup(cells, "ETHUSDT#" + "50".zfill(20)).count() == 0


def test_latest_bar_may_be_open(bars):
    rows = op.latest_bar(bars, T0 + 3600).collect()
    assert set(minutes(rows)) == {60} and len(rows) == 3
    assert {r.vwap_usd for r in rows} == {160.0}


def test_latest_bar_takes_every_measure_from_one_bar(bars):
    expected = {tuple(r) for r in bars.filter(f"window_start = timestamp_seconds({T0 + 7200})")
                .select("symbol", "window_start", "window_end", *op.serving.BAR_MEASURES).collect()}
    assert {tuple(r) for r in op.latest_bar(bars, T0 + 7200).collect()} == expected


def test_summary_leaves_out_symbols_without_a_recent_bar(spark, bars):
    rows = op.summary(bars, tracked_symbols(spark), symbol_metadata(spark), T0 + 7200).collect()
    assert {r.symbol: r.asset_category for r in rows} == {
        "BTCUSDT": "Layer1", "ETHUSDT": "Layer1"}
    late = op.summary(bars, tracked_symbols(spark), symbol_metadata(spark), T0 + 180 * 60 + 180)
    assert late.count() == 0


def test_symbol_card_falls_back_for_unlisted_pairs(spark, market, bars):
    rows = op.symbol_card(bars, market, tracked_symbols(spark, "BTCUSDT,FOOUSDT,XRPUSDT"),
                          symbol_metadata(spark), T0 + 180 * 60).collect()
    found = {r.symbol: r for r in rows}
    assert found.keys() == {"BTCUSDT", "FOOUSDT"}
    foo = found["FOOUSDT"]
    assert (foo.base, foo.quote, foo.category, foo.last_trade_id) == ("FOO", "USDT", None, 1792)


def test_newest_trade_is_one_row_in_full(market):
    rows = {r.symbol: r for r in op.newest_trade(market).collect()}
    btc = rows["BTCUSDT"]
    assert (btc.trade_id, btc.price_d, btc.is_buy) == (1790, 279.0, True)
    plan = op.newest_trade(market)._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan


def test_newest_version_wins(spark):
    versions = spark.createDataFrame(
        [("A", 0, 1, 0, 1.0), ("A", 0, 1, 1, 2.0), ("A", 0, 0, 9, 3.0), ("A", 60, 0, 0, 4.0)],
        "symbol string, window_start long, ingested_at long, batch_id long, vwap_usd double")
    assert sorted(r.vwap_usd for r in op.latest_bars(versions).collect()) == [2.0, 4.0]


def test_series_positions_run_over_days(spark):
    rows = [("A", T0 + 3600 * h, float(h)) for h in range(60)] + [("B", T0, 1.0)]
    bars = spark.createDataFrame(rows, "symbol string, at long, vwap_usd double").selectExpr(
        "symbol", "timestamp_seconds(at) AS window_start", "vwap_usd")
    found = {(r.symbol, r.idx): r for r in op.price_series(bars).collect()}
    assert found.keys() == {("A", i) for i in range(60)} | {("B", 0)}
    assert all(found[("A", i)].vwap_usd == i for i in range(60))
    assert [i for i in range(60) if found[("A", i)].label] == [0, 10, 20, 30, 40, 50]
    assert (found[("A", 10)].label, found[("B", 0)].label_step) == ("10:00", 1)


@pytest.mark.parametrize("bars_shown, step", [(10, 1), (11, 2), (20, 2), (21, 5), (40, 5), (41, 10)])
def test_label_steps(spark, bars_shown, step):
    bars = spark.range(bars_shown).selectExpr(
        "'A' AS symbol", "timestamp_seconds(id * 60) AS window_start", "1.0D AS vwap_usd")
    assert {r.label_step for r in op.price_series(bars).collect()} == {step}


def test_price_axis(spark):
    bars = spark.createDataFrame(
        [("A", 10.0), ("A", 30.0), ("B", 5.0)], "symbol string, vwap_usd double")
    assert {tuple(r) for r in op.price_axis(bars).collect()} == {
        ("A", 9.0, 31.0), ("B", 4.0, 6.0)}


def test_volume_share_leaves_out_symbols_without_volume(spark):
    bars = spark.createDataFrame(
        [("A", 1, 10.0), ("A", 2, 40.0), ("B", 1, 0.0)],
        "symbol string, window_start long, total_notional_usd double")
    assert {(r.symbol, r.share, r.axis_max) for r in op.volume_share(bars).collect()} == {
        ("A", 0.25, 44.0), ("A", 1.0, 44.0)}


def test_trade_display(spark, market):
    cells = op.trade_cells(op.enrich_trades(market, symbol_metadata(spark)))
    rows = op.trade_display(op.recent_trades(cells, "FOOUSDT")).collect()
    assert len(rows) == 20
    assert (rows[0].price_label, rows[0].qty_label, rows[0].notional_label,
            rows[0].time_label, rows[0].category) == (
        "$279", "2.000000", "$558.00", "02:59:01", None)


def test_stored_bars_take_the_filters_to_the_scan(spark, bars, tmp_path):
    bars.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    plan = op.vwap_range(stored, "BTCUSDT", T0 + 3600)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "EqualTo(symbol,BTCUSDT)" in plan and "GreaterThanOrEqual(window_start" in plan
