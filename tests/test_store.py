"""Keyed tables: newest-first reads, and compaction beside a live query."""

from datetime import date, timedelta
import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import frame
from tickloom.operators import parse_trades, recent_trades, vwap
from tickloom.schema import KEYED_TRADES
from tickloom.sources import file_frames, symbol_metadata
from tickloom.streaming import store
from tickloom.streaming.jobs import start
from tickloom.streaming.sinks import (
    compact_keyed_bars, compact_keyed_trades, keyed_bar_writer, keyed_trade_writer, read_keyed_bars,
    read_keyed_trades, read_recent_trades, read_rejects, read_versions,
)

DAY = 86400


def content(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def day(k):
    return (date(2024, 1, 1) + timedelta(days=k))


@pytest.fixture
def month(spark, trades, tmp_path):
    """Ten trades a day of one symbol and two of another for 30 days, but one and none on the newest."""
    path = str(tmp_path / "k")
    write = keyed_trade_writer(symbol_metadata(spark), path)
    rows = [frame(DAY * d + 60 * k, "BTCUSDT", trade_id=100 * d + k)
            for d in range(30) for k in range(10 if d < 29 else 1)]
    rows += [frame(DAY * d + 60 * k, "ETHUSDT", trade_id=5000 + 100 * d + k) for d in range(29) for k in range(2)]
    write(trades(*rows), 0)
    write(trades(frame(DAY * 28 + 1, "BTCUSDT", price="7", trade_id=2801)), 1)
    return path


def read_days(df):
    """The days of the files a plan reads."""
    return sorted({re.search(r"day=([\d-]+)", f).group(1) for f in df.inputFiles()})


def test_newest_trades_come_from_the_newest_day(spark, month):
    found = read_recent_trades(spark, month, "btcusdt", 1)
    assert read_days(found) == ["2024-01-30"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "EqualTo(symbol,BTCUSDT)" in plan.split("PushedFilters: ")[1]
    assert [r.trade_id for r in found.collect()] == [2900]


def test_a_read_widens_until_it_holds_enough(spark, month):
    found = read_recent_trades(spark, month, "btcusdt", 5)
    assert read_days(found) == ["2024-01-29", "2024-01-30"]
    assert [(r.trade_id, r.price) for r in found.collect()] == \
        [(2900, 100.0), (2809, 100.0), (2808, 100.0), (2807, 100.0), (2806, 100.0)]
    # two versions of one key are one row
    assert [r.price for r in read_recent_trades(spark, month, "btcusdt", 11).collect()].count(7.0) == 1
    # twice as many days each time, so the one trade more than three days hold comes from the fourth
    assert len(read_days(read_recent_trades(spark, month, "ETHUSDT", 7))) == 8


@pytest.mark.parametrize("symbol, limit", [("BTCUSDT", 30), ("ETHUSDT", 30), ("BTCUSDT", 1000), ("NONE", 5)])
def test_newest_trades_equal_a_read_of_everything(spark, month, symbol, limit):
    found = read_recent_trades(spark, month, symbol, limit).collect()
    assert found == recent_trades(read_keyed_trades(spark, month), symbol, limit).collect()


def test_trades_without_a_time_are_read_with_any_day(spark, trades, tmp_path):
    path = str(tmp_path / "k")
    write = keyed_trade_writer(symbol_metadata(spark), path)
    write(trades(frame(0, trade_id=1), frame(DAY, trade_id=2), frame(0, trade_id=3, T=None)), 0)
    assert [r.trade_id for r in read_recent_trades(spark, path, "BTCUSDT", 2).collect()] == [3, 2]
    assert [r.trade_id for r in read_recent_trades(spark, path, "BTCUSDT", 9).collect()] == [3, 2, 1]
    assert read_recent_trades(spark, str(tmp_path / "none"), "BTCUSDT").collect() == []


def test_compaction_between_two_batches_of_a_running_query(spark, raw, tmp_path):
    """Days are compacted, read, changed by a late batch, and compacted again, while one query runs."""
    frames, path = str(tmp_path / "frames"), str(tmp_path / "k")

    def land(*texts):
        raw(*texts).coalesce(1).write.mode("append").parquet(frames)
        if running:
            running[0].processAllAvailable()

    running = []
    land(frame(0, trade_id=1), frame(DAY, trade_id=2), frame(1, trade_id=1, s=None))
    writer = keyed_trade_writer(symbol_metadata(spark), path)
    running.append(start(parse_trades(file_frames(spark, frames)), "compacted", "append",
                         str(tmp_path / "checkpoints"), lambda w, _: w.foreachBatch(writer)))
    try:
        running[0].processAllAvailable()
        land(frame(0, price="5", trade_id=1), frame(2 * DAY, trade_id=3))
        # the newest batch may be repeated, so only the first is put away
        made = compact_keyed_trades(spark, path, day(2))
        assert [(p.day, p.upto) for p in made] == [(day(0), 0), (day(1), 0)]
        land(frame(1, price="9", trade_id=1), frame(2 * DAY, trade_id=4))
        want = {1: 9.0, 2: 100.0, 3: 100.0, 4: 100.0}
        assert {r.trade_id: r.price for r in read_keyed_trades(spark, path).collect()} == want
        assert read_rejects(spark, path).count() == 1
        # what was compacted is not read from its batches
        batches = [f for f in read_keyed_trades(spark, path).inputFiles() if "batch_id=0" in f]
        assert batches == []
        assert [(p.day, p.upto) for p in compact_keyed_trades(spark, path, day(2))] == [(day(0), 1)]
        land(frame(3 * DAY, trade_id=5))
        want[5] = 100.0
        before = content(read_keyed_trades(spark, path))
        assert store.drop_replaced(spark, path) == 4  # two days of batch 0, one of batch 1, one compacted day
        assert content(read_keyed_trades(spark, path)) == before
        assert {r.trade_id: r.price for r in read_keyed_trades(spark, path).collect()} == want
        assert compact_keyed_trades(spark, path, day(1))[0].upto == 2
        assert compact_keyed_trades(spark, path, day(1)) == []
    finally:
        running[0].stop()


def test_compaction_keeps_every_querys_last_word(spark, tmp_path, trades, monkeypatch):
    """Of two queries the one that first wrote a key later wins, before and after, whoever writes again."""
    from tickloom.streaming import sinks

    path = str(tmp_path / "k")
    write = keyed_trade_writer(symbol_metadata(spark), path)

    def put(query, batch, price):
        monkeypatch.setattr(sinks, "_query_id", lambda _: query)
        write(trades(frame(0, trade_id=1, price=price)), batch)

    for k, (query, price) in enumerate([("b", "1"), ("b", "2"), ("a", "3"), ("a", "4"), ("b", "5")]):
        put(query, k, price)
    put("a", 9, "6")
    put("b", 9, "7")
    assert [r.price for r in read_keyed_trades(spark, path).collect()] == [6.0]
    assert {(p.query_id, p.upto) for p in compact_keyed_trades(spark, path, day(1))} == {("a", 3), ("b", 4)}
    store.drop_replaced(spark, path)
    assert [r.price for r in read_keyed_trades(spark, path).collect()] == [6.0]
    put("b", 10, "8")
    assert [r.price for r in read_keyed_trades(spark, path).collect()] == [6.0]


def test_a_compaction_that_ends_early_changes_nothing(spark, month, monkeypatch):
    before = content(read_keyed_trades(spark, month))
    calls = []

    def renamed(spark, old, new):
        calls.append(new)
        if len(calls) == 3:
            raise OSError("lost")
        return whole(spark, old, new)

    whole = store.rename
    monkeypatch.setattr(store, "rename", renamed)
    with pytest.raises(OSError):
        compact_keyed_trades(spark, month, day(10))
    assert content(read_keyed_trades(spark, month)) == before
    monkeypatch.undo()
    assert len(compact_keyed_trades(spark, month, day(10))) == 8
    assert content(read_keyed_trades(spark, month)) == before
    assert store.drop_replaced(spark, month) == 10
    assert content(read_keyed_trades(spark, month)) == before
    assert [r.trade_id for r in read_recent_trades(spark, month, "BTCUSDT", 2).collect()] == [2900, 2809]


def test_compacted_days_are_sorted_files_of_a_key_once(spark, month):
    compact_keyed_trades(spark, month, day(30))
    part = next(p for p in store.parts(spark, month) if p.compacted and p.day == day(28))
    rows = store.read_parts(spark, month, KEYED_TRADES, [part]).collect()
    assert [r.row_key for r in rows] == sorted({r.row_key for r in rows}) and {r.batch_id for r in rows} == {0}


def test_bars_are_compacted_too(spark, trades, tmp_path):
    path = str(tmp_path / "b")
    write = keyed_bar_writer(symbol_metadata(spark), path)
    for batch in range(3):
        write(vwap(trades(*[frame(DAY * d, trade_id=batch, price=str(100 + batch)) for d in range(3)])), batch)
    before = content(read_keyed_bars(spark, path))
    assert len(compact_keyed_bars(spark, path, day(2))) == 2
    store.drop_replaced(spark, path)
    assert content(read_keyed_bars(spark, path)) == before
    assert read_keyed_bars(spark, path, since="2024-01-02").count() == 2
    assert read_versions(spark, path).count() == 5  # what is not compacted


def test_the_newest_trade_comes_from_each_symbols_newest_day(spark, trades):
    from tickloom.operators import newest_trade
    from tickloom.streaming.sinks import create_trades_table, read_newest_trades, table_trade_writer

    table = "newest_" + uuid.uuid4().hex[:8]
    create_trades_table(spark, table)
    odd = "A/B=C +%"
    rows = [frame(DAY * d, "BTCUSDT", trade_id=d) for d in range(30)]
    rows += [frame(DAY * d, "ETHUSDT", trade_id=100 + d) for d in range(3)]  # not traded since
    rows += [frame(DAY * d, odd, trade_id=d if d < 10 else None) for d in range(20)]  # without ids of late
    rows += [frame(DAY * 40, "OTHER", trade_id=1), frame(0, "SOLUSDT", trade_id=9, T=None), frame(0, "SOLUSDT", trade_id=8)]
    table_trade_writer(table)(trades(*rows), 0)
    try:
        symbols = ["BTCUSDT", "ETHUSDT", "SOLUSDT", odd, "NEVER"]
        found = read_newest_trades(spark, table, symbols)
        assert {(r.symbol, str(r.trade_date)) for r in found.select("symbol", "trade_date").distinct().collect()} == {
            ("BTCUSDT", "2024-01-30"), ("ETHUSDT", "2024-01-03"), ("SOLUSDT", "2024-01-01"), ("SOLUSDT", "None"),
            *((odd, str(day(d))) for d in range(4, 20))}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "trade_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        with_ms = found.withColumn("trade_ms", F.unix_millis("event_ts"))
        assert {r.symbol: r.trade_id for r in newest_trade(with_ms).collect()} == {
            "BTCUSDT": 29, "ETHUSDT": 102, "SOLUSDT": 9, odd: 9}
        assert read_newest_trades(spark, table, ["NEVER"]).isEmpty()
    finally:
        spark.sql(f"DROP TABLE {table}")
