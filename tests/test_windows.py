from collections import defaultdict
import random
import statistics

import pytest

from conftest import START_MS, frame
from tickloom.operators import (
    high_low_24h, moving_avg, ohlcv, order_flow_imbalance, velocity, vwap, whales,
)


def second(ts):
    return int(ts.timestamp()) - START_MS // 1000


@pytest.fixture(scope="module")
def sample():
    """Random trades, one symbol with most of them, as (second, symbol, price, qty, maker)."""
    rng = random.Random(7)
    rows = []
    for _ in range(900):
        symbol = rng.choice(["BTCUSDT"] * 6 + ["ETHUSDT", "FOOUSDT"])
        base = {"BTCUSDT": 78000, "ETHUSDT": 3000, "FOOUSDT": 2}[symbol]
        rows.append((rng.randrange(0, 600_000) / 1000, symbol,
                     round(base + rng.random() * 40, 2), rng.randrange(1, 100) / 100,
                     rng.random() < 0.4))
    return rows


@pytest.fixture(scope="module")
def sample_trades(trades, sample):
    return trades(*[
        frame(s, symbol, f"{p:.8f}", f"{q:.8f}", i, m)
        for i, (s, symbol, p, q, m) in enumerate(sample)
    ]).repartition(5).cache()


def groups(sample, width, slide, key):
    """Brute force: window start and key to the trades inside."""
    out = defaultdict(list)
    for row in sample:
        start = int(row[0] // slide) * slide
        while start > row[0] - width:
            out[(start, *key(row))].append(row)
            start -= slide
    return out


def test_bars_against_brute_force(sample, sample_trades):
    expected = groups(sample, 60, 60, lambda r: (r[1],))
    bars = {(second(r.window_start), r.symbol): r for r in vwap(sample_trades).collect()}
    assert bars.keys() == expected.keys()
    for key, rows in expected.items():
        bar, notional = bars[key], sum(p * q for _, _, p, q, _ in rows)
        volume = sum(q for _, _, _, q, _ in rows)
        assert bar.trade_count == len(rows)
        assert bar.vwap_usd == pytest.approx(notional / volume, abs=6e-5)
        assert bar.total_volume == pytest.approx(volume, abs=1e-6)
        assert bar.total_notional_usd == pytest.approx(notional, abs=6e-3)
        assert (bar.low_usd, bar.high_usd) == (min(r[2] for r in rows), max(r[2] for r in rows))
        assert bar.low_usd - 1e-4 <= bar.vwap_usd <= bar.high_usd + 1e-4
    assert sum(b.trade_count for b in bars.values()) == len(sample)


def test_velocity_against_brute_force(sample, sample_trades):
    side = {True: "SELL", False: "BUY"}
    expected = groups(sample, 60, 30, lambda r: (r[1], side[r[4]]))
    found = {(second(r.window_start), r.symbol, r.side): r
             for r in velocity(sample_trades).collect()}
    assert found.keys() == expected.keys()
    for key, rows in expected.items():
        assert found[key].trade_count == len(rows)
        assert found[key].volume == pytest.approx(sum(r[3] for r in rows), abs=1e-6)
    assert sum(r.trade_count for r in found.values()) == 2 * len(sample)


def test_moving_average_against_brute_force(sample, sample_trades):
    expected = groups(sample, 120, 10, lambda r: (r[1],))
    found = {(second(r.window_start), r.symbol): r for r in moving_avg(sample_trades).collect()}
    assert found.keys() == expected.keys()
    for key, rows in expected.items():
        prices, row = [r[2] for r in rows], found[key]
        assert row.sample_count == len(rows)
        assert row.sma_usd == pytest.approx(statistics.fmean(prices), abs=6e-5)
        if len(prices) == 1:
            assert row.price_stddev_usd is None and row.volatility_flag == "NORMAL"
            continue
        deviation = statistics.stdev(prices)
        assert row.price_stddev_usd == pytest.approx(deviation, abs=1.5e-6)
        high = deviation / statistics.fmean(prices) > 0.001
        assert row.volatility_flag == ("HIGH-VOLATILITY" if high else "NORMAL")
    assert {r.volatility_flag for r in found.values()} == {"NORMAL", "HIGH-VOLATILITY"}
    assert sum(r.sample_count for r in found.values()) == 12 * len(sample)


def test_slide_that_does_not_divide_the_width(sample, sample_trades):
    expected = groups(sample, 25, 10, lambda r: (r[1],))
    found = {(second(r.window_start), r.symbol): r.sample_count
             for r in moving_avg(sample_trades, 25, 10).collect()}
    assert found == {key: len(rows) for key, rows in expected.items()}


def test_moving_average_counts_trades_without_a_price(trades):
    rows = moving_avg(trades(frame(1, price="x"), frame(2, price="10"), frame(3, price="12")))
    assert {(r.sample_count, r.sma_usd, r.price_stddev_usd) for r in rows.collect()} == {
        (3, 11.0, 1.414214)}


def test_moving_average_of_no_prices_is_null(trades):
    row = moving_avg(trades(frame(1, price="x"))).first()
    assert (row.sma_usd, row.price_stddev_usd, row.volatility_flag) == (None, None, "NORMAL")


def test_deviation_is_stable_at_high_prices(trades):
    prices = ["90000000.01", "90000000.02", "90000000.03"]
    rows = moving_avg(trades(*[frame(15 * i, price=p) for i, p in enumerate(prices)]))
    full = rows.filter("sample_count = 3").first()
    assert full.price_stddev_usd == pytest.approx(0.01, abs=1e-6)


def test_fan_out_of_one_trade(trades):
    one = trades(frame(61.5))
    assert velocity(one).count() == 2
    assert moving_avg(one).count() == 12


def test_zero_volume_has_no_vwap(trades):
    bar = vwap(trades(frame(qty="0"), frame(qty="0.0"))).first()
    assert (bar.vwap_usd, bar.total_volume, bar.trade_count) == (None, 0.0, 2)


def test_windows_are_half_open(trades):
    bars = vwap(trades(frame(59.999), frame(60))).orderBy("window_start").collect()
    assert [(second(b.window_start), second(b.window_end)) for b in bars] == [(0, 60), (60, 120)]


def test_trade_without_time_is_in_no_window(trades):
    t = trades(frame(T="soon"))
    assert t.count() == 1 and vwap(t).count() == velocity(t).count() == moving_avg(t).count() == 0


def test_vwap_is_not_the_mean_price(trades):
    assert vwap(trades(frame(price="10", qty="3"), frame(price="20", qty="1"))).first() \
        .vwap_usd == 12.5


def test_a_sum_on_a_rounding_tie_rounds_up_in_any_order(trades):
    # 0.7 * 0.05 + 0.1 * 0.1 = 0.045, and the sum in doubles is 0.045 or just below.
    texts = [frame(price="0.7", qty="0.05"), frame(price="0.1", qty="0.1")]
    for order in (texts, texts[::-1]):
        assert vwap(trades(*order)).first().total_notional_usd == 0.05


def test_whale_threshold_is_inclusive_and_unrounded(trades):
    t = trades(frame(price="50000", qty="1", trade_id=1),
               frame(price="49999.99", qty="1", trade_id=2),
               frame(price="49999.999", qty="1", trade_id=3))
    assert [(r.trade_id, r.notional_usd) for r in whales(t).collect()] == [(1, 50000.0)]
    assert whales(t, 40000).count() == 3


def test_open_and_close_follow_time_then_id(trades):
    bar = ohlcv(trades(
        frame(5, price="3", trade_id=9), frame(1, price="2", trade_id=8),
        frame(1, price="1", trade_id=7), frame(5, price="4", trade_id=10),
        frame(3, price="99", trade_id=11))).first()
    assert (bar.open_usd, bar.high_usd, bar.low_usd, bar.close_usd) == (1.0, 99.0, 1.0, 4.0)


def test_order_flow_imbalance(trades):
    t = trades(frame(31, qty="3"), frame(32, qty="1", maker=True),
               frame(31, symbol="ETHUSDT", qty="2", maker=True))
    found = {(second(r.window_start), r.symbol): r.imbalance
             for r in order_flow_imbalance(t).collect()}
    assert found == {(0, "BTCUSDT"): 0.5, (30, "BTCUSDT"): 0.5,
                     (0, "ETHUSDT"): -1.0, (30, "ETHUSDT"): -1.0}


def test_rolling_day_against_brute_force(spark):
    rng = random.Random(3)
    minutes = sorted(rng.sample(range(-1500, 4500), 700))
    rows = [(symbol, START_MS // 1000 + 60 * m, rng.randrange(1000) / 10)
            for symbol in ("A", "B") for m in minutes]
    bars = spark.createDataFrame(rows, "symbol string, at long, price double").selectExpr(
        "symbol", "timestamp_seconds(at) AS window_start", "price AS high_usd",
        "price - 1 AS low_usd")
    found = {(r.symbol, int(r.window_start.timestamp())): (r.high_24h_usd, r.low_24h_usd)
             for r in high_low_24h(bars).collect()}
    assert len(found) == len(rows)
    for symbol, at, _ in rows:
        seen = [p for s, t, p in rows if s == symbol and at - 86340 <= t <= at]
        assert found[(symbol, at)] == (max(seen), min(seen) - 1)


def test_aggregates_have_a_partial_step_and_shuffle_trades_once(sample_trades):
    """A second shuffle of velocity has panes, not trades."""
    for frame_, shuffles in ((vwap(sample_trades), 1), (velocity(sample_trades), 2)):
        plan = frame_._jdf.queryExecution().sparkPlan().toString()
        assert "partial_sum" in plan and "SortAggregate" not in plan
        executed = frame_._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == shuffles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_open_and_close_need_no_sort(trades):
    plan = plan_of(ohlcv(trades(frame(1), frame(2))))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("aggregate", [velocity, order_flow_imbalance])
def test_panes_are_copied_and_not_trades(trades, aggregate):
    plan = plan_of(aggregate(trades(frame(1), frame(2))))
    assert plan.index("Expand") < plan.rindex("HashAggregate")
    assert "Expand" not in plan[plan.rindex("HashAggregate"):]
