"""Streams fed one file per batch, and their agreement with the batch results."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException

from conftest import START_MS, frame
from tickloom.operators import (
    latest_bars, moving_avg, newest_version, parse_trades, velocity, vwap, whales,
)
from tickloom.sources import file_frames, file_history, symbol_metadata, symbol_reference
from tickloom.streaming import jobs
from tickloom.streaming.main import options, run
from tickloom.streaming.sinks import (
    create_bars_table, create_trades_table, keyed_trade_writer, read_keyed_bars,
    read_keyed_trades, read_versions, table_bar_writer, table_trade_writer, version_writer,
)


@pytest.fixture
def feed(spark, raw, tmp_path):
    """Feeds groups of frames to a query, one batch each, and returns the query's progress."""
    class Feed:
        frames = str(tmp_path / "frames")
        out = str(tmp_path / "out")

        def land(self, *texts):
            raw(*texts).coalesce(1).write.mode("append").parquet(self.frames)

        def stream(self):
            return parse_trades(file_frames(spark, self.frames))

        def run(self, build, mode, *batches):
            self.land(*batches[0])
            query = jobs.start(
                build(self.stream()), "fed", mode, str(tmp_path / "checkpoint"),
                lambda w, _: w.foreachBatch(version_writer(self.out)))
            try:
                query.processAllAvailable()
                for texts in batches[1:]:
                    self.land(*texts)
                    query.processAllAvailable()
                return query.recentProgress
            finally:
                query.stop()

        def versions(self):
            return read_versions(spark, self.out)

    return Feed()


def dropped(progress):
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def bar_counts(df):
    start = START_MS // 1000
    return {int(r.window_start.timestamp()) - start: r.trade_count for r in df.collect()}


def test_late_trade_is_dropped_from_bars(feed):
    progress = feed.run(vwap, "update",
                        [frame(5)], [frame(100)], [frame(120)], [frame(10)])
    assert dropped(progress) == 1
    assert bar_counts(latest_bars(feed.versions())) == {0: 1, 60: 1, 120: 1}


def test_nearly_late_trade_still_counts(feed, spark):
    # Both rows of the last batch are judged by the watermark before it.
    progress = feed.run(vwap, "update", [frame(5), frame(50)], [frame(85)],
                        [frame(10), frame(120)])
    assert dropped(progress) == 0
    assert bar_counts(latest_bars(feed.versions())) == {0: 3, 60: 1, 120: 1}


def test_rows_are_never_late(feed):
    feed.run(lambda t: whales(t, 0), "append",
             [frame(5)], [frame(100)], [frame(120)], [frame(10)])
    assert feed.versions().count() == 4


def test_a_bar_has_a_version_per_batch_that_changed_it(feed):
    feed.run(vwap, "update", [frame(5)], [frame(20)], [frame(70)])
    assert feed.versions().count() == 3
    assert bar_counts(latest_bars(feed.versions())) == {0: 2, 60: 1}


def test_append_mode_emits_closed_bars_only(feed):
    feed.run(vwap, "append", [frame(5)], [frame(20)], [frame(95)])
    assert bar_counts(feed.versions()) == {0: 2}


def sample():
    return [
        frame(7 * i % 600 + i / 1000, ["BTCUSDT", "ETHUSDT", "FOOUSDT"][i % 3],
              f"{100 + i % 17}.25", f"{1 + i % 5}.5", i, i % 4 == 0)
        for i in range(240)
    ]


def plain(df, columns=None):
    return sorted(map(repr, df.select(columns or df.columns).collect()))


@pytest.mark.parametrize("build, keys", [
    (vwap, ["symbol", "window_start"]),
    (velocity, ["symbol", "side", "window_start"]),
    (moving_avg, ["symbol", "window_start"]),
])
def test_stream_equals_batch(feed, trades, build, keys):
    in_order = sorted(sample(), key=lambda t: int(t.split('"T": ')[1].split(",")[0]))
    feed.run(build, "update", in_order[:90], in_order[90:170], in_order[170:])
    expected = build(trades(*sample()))
    assert plain(newest_version(feed.versions(), *keys), expected.columns) == plain(expected)


def test_console_job_runs_four_named_queries(spark, raw, tmp_path, capfd):
    raw(*sample()).write.parquet(str(tmp_path / "frames"))
    running = jobs.start_console_job(
        parse_trades(file_frames(spark, str(tmp_path / "frames"))),
        symbol_reference(spark), str(tmp_path / "checkpoints"), 400.0, once=True)
    assert [q.name for q in running] == list(jobs.CONSOLE_ROWS)
    for query in running:
        query.awaitTermination()
        assert query.exception() is None
    assert {p.name for p in (tmp_path / "checkpoints").iterdir()} == set(jobs.CONSOLE_ROWS)


def test_all_queries_stop_when_one_does(spark, raw, tmp_path):
    raw(frame()).write.parquet(str(tmp_path / "frames"))
    spark.streams.resetTerminated()
    running = jobs.start_console_job(
        parse_trades(file_frames(spark, str(tmp_path / "frames"))), symbol_reference(spark),
        str(tmp_path / "c"), sink=lambda w, _: w.format("noop"))
    for query in running:
        query.processAllAvailable()
    running[2].stop()
    jobs.await_any(spark, running)
    assert not any(query.isActive for query in running)


def test_job_runner_lands_then_replays(spark, raw, tmp_path):
    texts = [*sample(), "junk", frame(e="24hrTicker")]
    raw(*texts).write.parquet(str(tmp_path / "topic"))
    land = options(["land", "--files", str(tmp_path / "topic"), "--once",
                    "--output", str(tmp_path / "bronze"), "--checkpoint", str(tmp_path / "c1")])
    for query in run(spark, land):
        query.awaitTermination()
    bronze = file_history(spark, str(tmp_path / "bronze"))
    assert sorted(bytes(r.value).decode() for r in bronze.collect()) == sorted(texts)
    recent = file_history(spark, str(tmp_path / "bronze"), since="2020-01-01")
    assert recent.count() == len(texts) and recent.schema == bronze.schema
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "landed" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert file_history(spark, str(tmp_path / "bronze"), since="2999-01-01").isEmpty()
    keyed = options(["keyed", "--files", str(tmp_path / "bronze"), "--once", "--final-bars",
                     "--output", str(tmp_path / "keyed"), "--checkpoint", str(tmp_path / "c2")])
    for query in run(spark, keyed):
        query.awaitTermination()
    assert read_keyed_trades(spark, str(tmp_path / "keyed/trades")).count() == len(sample())
    bars = vwap(parse_trades(bronze))
    last = max(r.window_end for r in bars.collect())
    assert read_keyed_bars(spark, str(tmp_path / "keyed/bars")).count() == \
        sum(r.window_end < last for r in bars.collect())


def test_metadata_from_file_serves_the_keyed_job(spark, raw, tmp_path):
    from tickloom.sources import publish_symbol_metadata

    publish_symbol_metadata(spark, str(tmp_path / "meta"))
    raw(frame()).write.parquet(str(tmp_path / "frames"))
    opts = options(["keyed", "--files", str(tmp_path / "frames"), "--once",
                    "--metadata", str(tmp_path / "meta"),
                    "--output", str(tmp_path / "keyed"), "--checkpoint", str(tmp_path / "c")])
    for query in run(spark, opts):
        query.awaitTermination()
    row = read_keyed_trades(spark, str(tmp_path / "keyed/trades")).first()
    expected = symbol_metadata(spark).filter("symbol = 'BTCUSDT'").first()
    assert row.description == expected.description


@pytest.mark.parametrize("kind", ["trades table", "bars table", "keyed trades"])
def test_batch_stored_but_not_committed_is_not_stored_twice(spark, raw, tmp_path, kind):
    """The job dies between the write of a batch and its commit, and is started again."""
    frames, keyed = str(tmp_path / "frames"), str(tmp_path / "keyed")
    table = f"t_{uuid.uuid4().hex[:8]}"
    create, writer, build, mode = {
        "trades table": (create_trades_table, table_trade_writer, lambda t: t, "append"),
        "bars table": (create_bars_table, table_bar_writer, vwap, "update"),
        "keyed trades": (None, lambda _: keyed_trade_writer(symbol_metadata(spark), keyed),
                         lambda t: t, "append"),
    }[kind]
    if create:
        create(spark, table, str(tmp_path / "table"))

    def run_once(write):
        trades = parse_trades(file_frames(spark, frames))
        jobs.start(build(trades), "crash", mode, str(tmp_path / "c"),
                   lambda w, _: w.foreachBatch(write), once=True).awaitTermination()

    def dies_after_writing(batch, batch_id):
        writer(table)(batch, batch_id)
        raise RuntimeError("lost")

    raw(frame(1, trade_id=1), frame(61, trade_id=2)).write.parquet(frames)
    run_once(writer(table))
    raw(frame(121, trade_id=3), frame(181, trade_id=4)).write.mode("append").parquet(frames)
    with pytest.raises(StreamingQueryException):
        run_once(dies_after_writing)
    run_once(writer(table))
    stored = spark.table(table) if create else spark.read.parquet(keyed)
    if kind == "bars table":
        assert bar_counts(stored) == {0: 1, 60: 1, 120: 1, 180: 1} and stored.count() == 4
    else:
        assert sorted(r.trade_id for r in stored.collect()) == [1, 2, 3, 4]
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_stream_can_drop_repeats(spark, raw, tmp_path):
    frames = str(tmp_path / "frames")
    raw(frame(1, trade_id=1), frame(1, trade_id=1)).write.parquet(frames)
    trades = parse_trades(file_frames(spark, frames), deduplicate=True)
    for more in ([], [frame(1, trade_id=1), frame(2, trade_id=2)]):
        if more:
            raw(*more).write.mode("append").parquet(frames)
        query = jobs.start(
            trades, "unique", "append", str(tmp_path / "c"),
            lambda w, _: w.foreachBatch(version_writer(str(tmp_path / "out"))), once=True)
        query.awaitTermination()
    assert sorted(r.trade_id for r in read_versions(spark, str(tmp_path / "out")).collect()) \
        == [1, 2]
