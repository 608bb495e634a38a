"""What running queries do beside each other: chained state, one parse, new metadata, late rows, restarts."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import START_MS, frame
from test_stream import dropped, feed, plain, sample  # noqa: F401
from tickloom.operators import (
    high_low_24h, high_low_24h_stream, moving_avg, order_flow_imbalance, parse_trades, velocity, vwap,
)
from tickloom.sources import (
    file_frames, following_metadata, load_symbol_metadata, publish_symbol_metadata, symbol_metadata,
    symbol_reference,
)
from tickloom.sources.reference import current_version
from tickloom.streaming import jobs
from tickloom.streaming.audit import open_windows, state_operators
from tickloom.streaming.progress import Progress
from tickloom.streaming.sinks import keyed_trade_writer, read_keyed_trades, version_writer


def in_order(texts):
    return sorted(texts, key=lambda t: int(t.split('"T": ')[1].split(",")[0]))


@pytest.mark.parametrize("build", [velocity, moving_avg, order_flow_imbalance])
def test_chained_aggregates_emit_each_closed_window_once(feed, trades, build):  # noqa: F811
    texts = in_order(sample())
    feed.run(lambda t: build(t, final=True), "append", texts[:90], texts[90:170], texts[170:])
    whole = build(trades(*sample()))
    latest = trades(*sample()).agg(F.max("event_ts")).first()[0]
    closed = whole.filter(F.col("window_end") <= F.lit(latest) - F.expr("INTERVAL 30 SECONDS"))
    assert 0 < closed.count() < whole.count()
    assert plain(feed.versions(), whole.columns) == plain(closed)


@pytest.mark.parametrize("build", [velocity, moving_avg])
def test_panes_are_copied_above_the_first_aggregate(spark, raw, tmp_path, build):
    raw(frame()).write.parquet(str(tmp_path / "frames"))
    plan = build(parse_trades(file_frames(spark, str(tmp_path / "frames"))), final=True)
    text = plan._jdf.queryExecution().analyzed().toString()
    first = max(m.start() for m in re.finditer("Aggregate", text))
    assert text.count("Aggregate") == 2 and text.rindex("Expand") < first


def test_moving_average_of_panes_without_prices(feed, trades):  # noqa: F811
    texts = [frame(1, price="x"), frame(2, price="10"), frame(15, price=None), frame(200, symbol="ETHUSDT", price="y")]
    feed.run(lambda t: moving_avg(t, final=True), "append", texts, [frame(1000)], [frame(1001)])
    whole = moving_avg(trades(*texts))
    assert plain(feed.versions(), whole.columns) == plain(whole)


def test_console_job_parses_once(spark, raw, tmp_path):
    """The four read landed trades; a restart neither lands nor reads a trade again."""
    frames, landed = str(tmp_path / "frames"), str(tmp_path / "landed")
    half = len(sample()) // 2
    texts = in_order(sample())
    for part in (texts[:half], texts[half:]):
        raw(*part).write.mode("append").parquet(frames)
        running = jobs.start_console_job(
            parse_trades(file_frames(spark, frames)), symbol_reference(spark), str(tmp_path / "c"), 400.0,
            sink=lambda w, name: w.foreachBatch(version_writer(str(tmp_path / name))), once=True, landed=landed)
        assert [q.name for q in running] == ["parsed_trades", *jobs.CONSOLE_ROWS]
        for query in running:
            query.awaitTermination()
            assert query.exception() is None
    assert spark.read.parquet(landed).count() == len(sample())
    whale = spark.read.parquet(str(tmp_path / "whale_alerts"))
    assert whale.count() == sum(1 for _ in filter(lambda r: r.notional >= 400, spark.read.parquet(landed).collect()))
    trades = jobs.landed_trades(spark, landed, parse_trades(file_frames(spark, frames)).schema)
    for _, _, branch in jobs.console_branches(trades, symbol_reference(spark)):
        assert "from_json" not in branch._jdf.queryExecution().analyzed().toString()


def test_live_console_job_with_one_parse(spark, raw, tmp_path):
    frames = str(tmp_path / "frames")
    raw(*sample()).write.parquet(frames)
    running = jobs.start_console_job(
        parse_trades(file_frames(spark, frames)), symbol_reference(spark), str(tmp_path / "c"), 400.0,
        sink=lambda w, name: w.foreachBatch(version_writer(str(tmp_path / name))), landed=str(tmp_path / "landed"))
    try:
        for query in running:
            query.processAllAvailable()
        newest = spark.read.parquet(str(tmp_path / "vwap_1min")).agg(F.sum("trade_count")).first()[0]
        assert newest == len(sample())
    finally:
        for query in running:
            query.stop()


def changed(spark, text):
    return symbol_metadata(spark).withColumn("description", F.lit(text))


def test_metadata_published_between_batches_is_seen(spark, raw, tmp_path):
    frames, path, meta = str(tmp_path / "frames"), str(tmp_path / "k"), str(tmp_path / "meta")
    publish_symbol_metadata(spark, meta, changed(spark, "first"))
    raw(frame(trade_id=1)).write.parquet(frames)
    writer = keyed_trade_writer(following_metadata(spark, meta), path)
    query = jobs.start(parse_trades(file_frames(spark, frames)), "followed", "append", str(tmp_path / "c"),
                       lambda w, _: w.foreachBatch(writer))
    try:
        query.processAllAvailable()
        for k, text in enumerate(["second", "third", "fourth"], 2):
            publish_symbol_metadata(spark, meta, changed(spark, text))
            raw(frame(trade_id=k)).write.mode("append").parquet(frames)
            query.processAllAvailable()
    finally:
        query.stop()
    assert {r.trade_id: r.description for r in read_keyed_trades(spark, path).collect()} == {
        1: "first", 2: "second", 3: "third", 4: "fourth"}


def test_a_reader_keeps_the_version_it_has(spark, tmp_path):
    meta = str(tmp_path / "meta")
    publish_symbol_metadata(spark, meta, changed(spark, "one"))
    held = load_symbol_metadata(spark, meta)
    publish_symbol_metadata(spark, meta, changed(spark, "two"))
    assert {r.description for r in held.collect()} == {"one"}
    assert {r.description for r in load_symbol_metadata(spark, meta).collect()} == {"two"}
    publish_symbol_metadata(spark, meta, changed(spark, "three"))
    assert len([p for p in (tmp_path / "meta").iterdir() if p.name.startswith("version-")]) == 2


def test_plain_csv_is_metadata_too(spark, tmp_path):
    symbol_metadata(spark).write.option("header", "true").csv(str(tmp_path / "plain"))
    assert current_version(spark, str(tmp_path / "plain")) == str(tmp_path / "plain")
    assert load_symbol_metadata(spark, str(tmp_path / "plain")).count() == 20


def test_listener_counts_batches_and_late_rows(spark, feed):  # noqa: F811
    with Progress(spark) as seen:
        progress = feed.run(lambda t: vwap(t.observe("trades", F.count(F.lit(1)).alias("rows"))), "update",
                            [frame(5), frame(6)], [frame(100)], [frame(120)], [frame(10), frame(11)])
        run_id = str(progress[0]["runId"])
        assert seen._end(run_id).wait(60)
    assert seen.total("fed", "trades.rows") == 6
    # two late trades of one bar reach the aggregate as one row
    assert sum(b.dropped for b in seen.batches.values()) == dropped(progress) == 1
    rows = seen.frame(spark).filter("rows > 0").orderBy("batch_id").collect()
    assert [r.rows for r in rows] == [2, 1, 1, 2] and {r.query for r in rows} == {"fed"}


def test_open_windows_are_those_a_restart_goes_on_with(spark, feed, tmp_path):  # noqa: F811
    feed.run(vwap, "update", [frame(5)], [frame(50), frame(61, symbol="ETHUSDT")], [frame(125)])
    found = open_windows(spark, str(tmp_path / "checkpoint/fed"))
    at = sorted((int(r.window_start.timestamp()) - START_MS // 1000, r.symbol) for r in found.collect())
    # the watermark is 95 seconds: the first bar is closed, the second is not
    assert at == [(60, "ETHUSDT"), (120, "BTCUSDT")]
    first = open_windows(spark, str(tmp_path / "checkpoint/fed"), batch_id=0)
    assert [(int(r.window_start.timestamp()) - START_MS // 1000) for r in first.collect()] == [0]
    operator, = state_operators(spark, str(tmp_path / "checkpoint/fed")).collect()
    assert operator.operatorName == "stateStoreSave" and operator.numPartitions == 8


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_rolling_extremes_of_a_stream_equal_those_of_a_batch(feed, trades, rocksdb):  # noqa: F811
    """Over 40 hours, with a symbol that pauses for more than a span, ties, and a bar without a price."""
    hour = 3600
    texts = [frame(hour * k // 2, "BTCUSDT", str(100 + (k * 37) % 23), trade_id=k) for k in range(80)]
    texts += [frame(hour * k, "ETHUSDT", "5", trade_id=k) for k in (0, 1, 2, 30, 31, 39)]
    texts += [frame(hour * 3, "ETHUSDT", "x", trade_id=9)]
    texts = in_order(texts)
    last = [frame(hour * 100, "OTHER")]
    feed.run(lambda t: high_low_24h_stream(vwap(t)), "append", texts[:30], texts[30:60], texts[60:], last)
    want = high_low_24h(vwap(trades(*texts)))
    assert plain(feed.versions(), want.columns) == plain(want)
