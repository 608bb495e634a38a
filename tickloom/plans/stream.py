"""Registered streaming queries.

Each lands frames as files, runs a streaming job over them until it has caught up, and returns
what the sink holds. Where a stream is fed in parts, the job is stopped after each part and
resumed from its checkpoint for the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import operators as op
from tickloom.plans.inputs import DAYS_SQUEEZE, events, parts
from tickloom.sources import (
    file_frames, file_history, frames_from_events, symbol_metadata, symbol_reference,
)
from tickloom.sources.events import TIME_SQUEEZE
from tickloom.streaming.audit import open_windows
from tickloom.streaming.jobs import start, start_console_job
from tickloom.streaming.progress import Progress
from tickloom.streaming.scratch import scratch
from tickloom.streaming.sinks import (
    BatchWriter, create_bars_table, create_trades_table, keyed_bar_writer, keyed_trade_writer,
    land_frames, read_keyed_bars, read_keyed_trades, read_versions, table_bar_writer,
    table_trade_writer, version_writer,
)

Build = Callable[[DataFrame], DataFrame]


def _finish(*running) -> None:
    for query in running:
        query.awaitTermination()


def _feed(
    spark: SparkSession,
    home: str,
    feed: Iterable[DataFrame],
    build: Build,
    mode: str,
    sink: Callable,
    name: str,
    progress: Progress | None = None,
    squeeze: int = TIME_SQUEEZE,
) -> None:
    """Land each part, then run the query until it has consumed it."""
    for part in feed:
        frames_from_events(part, squeeze).write.mode("append").parquet(f"{home}/frames")
        stream = build(op.parse_trades(file_frames(spark, f"{home}/frames")))
        query = start(stream, name, mode, f"{home}/checkpoints", sink, once=True)
        _finish(query)
        if progress:
            progress.settle(query)


def _to_files(path: str):
    return lambda writer, _: writer.format("parquet").option("path", path)


def _to_batches(write: BatchWriter):
    return lambda writer, _: writer.foreachBatch(write)


def _rows(spark, sf_dir, name, build, feed=None) -> DataFrame:
    """Run an append query into a file sink and read the sink."""
    home = scratch(spark, name)
    feed = feed or [events(spark, sf_dir)]
    _feed(spark, home, feed, build, "append", _to_files(f"{home}/out"), name)
    return spark.read.parquet(f"{home}/out")


def _latest(spark, name, build, feed, *keys, progress=None) -> DataFrame:
    """Run an update query into a versioned sink and read the newest version of each key."""
    home = scratch(spark, name)
    sink = _to_batches(version_writer(f"{home}/out"))
    _feed(spark, home, feed, build, "update", sink, name, progress)
    newest = op.newest_version(read_versions(spark, f"{home}/out"), *keys)
    return newest.drop("query_id", "batch_id", "ingested_at")


def stream_whales(spark, sf_dir):
    return _rows(spark, sf_dir, "stream_whales", op.whales, parts(spark, sf_dir))


def stream_vwap_final(spark, sf_dir):
    return _rows(spark, sf_dir, "stream_vwap_final", op.vwap)


def stream_vwap_latest(spark, sf_dir):
    return _latest(
        spark, "stream_vwap_latest", op.vwap, parts(spark, sf_dir), "symbol", "window_start")


def stream_velocity(spark, sf_dir):
    return _latest(
        spark, "stream_velocity", op.velocity, parts(spark, sf_dir),
        "symbol", "side", "window_start")


def stream_moving_avg(spark, sf_dir):
    return _latest(
        spark, "stream_moving_avg", op.moving_avg, parts(spark, sf_dir),
        "symbol", "window_start")


def stream_velocity_final(spark, sf_dir):
    return _rows(
        spark, sf_dir, "stream_velocity_final", lambda t: op.velocity(t, final=True), parts(spark, sf_dir))


def stream_moving_avg_final(spark, sf_dir):
    return _rows(
        spark, sf_dir, "stream_moving_avg_final", lambda t: op.moving_avg(t, final=True), parts(spark, sf_dir))


def stream_restart(spark, sf_dir):
    halves = parts(spark, sf_dir, (3631,))
    return _latest(spark, "stream_restart", op.vwap, halves, "symbol", "window_start")


def _with_latecomers(spark, sf_dir) -> list[DataFrame]:
    """Parts in time order, except that one symbol's first part arrives at the very end."""
    first, *rest = parts(spark, sf_dir)
    late = F.col("event_type") == "signup"
    return [first.filter(~late), *rest, first.filter(late)]


def stream_late_drop(spark, sf_dir):
    feed = _with_latecomers(spark, sf_dir)
    return _latest(spark, "stream_late_drop", op.vwap, feed, "symbol", "window_start")


def stream_late_counts(spark, sf_dir):
    """Trades that reached the bars and trades that came too late, by what the listener was told."""
    name, seen = "stream_late_counts", F.count(F.lit(1)).alias("rows")
    with Progress(spark) as progress:
        bars = _latest(
            spark, name, lambda t: op.vwap(t.observe("trades", seen)), _with_latecomers(spark, sf_dir),
            "symbol", "window_start", progress=progress)
    total = F.lit(progress.total(name, "trades.rows")).cast("long")
    kept = bars.agg(F.coalesce(F.sum("trade_count"), F.lit(0)).alias("kept"))
    return kept.select(total.alias("seen"), "kept", (total - F.col("kept")).alias("late"))


def stream_open_bars(spark, sf_dir):
    """Bars that a restart after the second part would go on with, from the checkpoint's state."""
    name, home = "stream_open_bars", scratch(spark, "stream_open_bars")
    sink = _to_batches(version_writer(f"{home}/out"))
    _feed(spark, home, parts(spark, sf_dir)[:2], op.vwap, "update", sink, name)
    return open_windows(spark, f"{home}/checkpoints/{name}")


def stream_high_low_24h(spark, sf_dir):
    home, provider = scratch(spark, "stream_high_low_24h"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    # custom state is kept by this store only
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        _feed(spark, home, parts(spark, sf_dir), lambda t: op.high_low_24h_stream(op.vwap(t)), "append",
              _to_files(f"{home}/out"), "stream_high_low_24h", squeeze=DAYS_SQUEEZE)
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{home}/out")


def stream_late_kept_rows(spark, sf_dir):
    return _rows(
        spark, sf_dir, "stream_late_kept_rows",
        lambda t: t.select("symbol", "trade_id", "event_ts", "side"),
        _with_latecomers(spark, sf_dir))


def stream_four_queries(spark, sf_dir):
    home = scratch(spark, "stream_four_queries")
    frames_from_events(events(spark, sf_dir)).write.parquet(f"{home}/frames")
    running = start_console_job(
        op.parse_trades(file_frames(spark, f"{home}/frames")),
        symbol_reference(spark),
        f"{home}/checkpoints",
        sink=lambda w, name: w.foreachBatch(version_writer(f"{home}/{name}")),
        once=True,
        landed=f"{home}/parsed",
    )
    names = [query.name for query in running[1:]]
    _finish(*running)
    counts = [
        read_versions(spark, f"{home}/{name}")
        .agg(F.count("*").alias("rows")).withColumn("query_name", F.lit(name))
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def _landed(spark, sf_dir, name) -> str:
    """Frames through the landing stream: a topic's files in, a bronze folder out."""
    home = scratch(spark, name)
    for part in parts(spark, sf_dir):
        frames_from_events(part).write.mode("append").parquet(f"{home}/topic")
        _finish(
            land_frames(file_frames(spark, f"{home}/topic"), f"{home}/bronze")
            .option("checkpointLocation", f"{home}/checkpoints").queryName(name)
            .trigger(availableNow=True).start()
        )
    return f"{home}/bronze"


def raw_frames(spark, sf_dir):
    bronze = file_history(spark, _landed(spark, sf_dir, "raw_frames"))
    return bronze.select(F.col("value").cast("string").alias("frame"))


def raw_replay(spark, sf_dir):
    bronze = file_history(spark, _landed(spark, sf_dir, "raw_replay"))
    return op.parse_trades(bronze).select("symbol", "trade_id", "event_ts", "notional", "side")


def _into_table(spark, sf_dir, name, create, writer, build, mode) -> DataFrame:
    home = scratch(spark, name)
    table = f"tickloom_{name}_{uuid.uuid4().hex[:12]}"
    create(spark, table, f"{home}/table")
    _feed(spark, home, parts(spark, sf_dir), build, mode, _to_batches(writer(table)), name)
    return spark.table(table)


def _bar_versions(spark, sf_dir, name) -> DataFrame:
    return _into_table(
        spark, sf_dir, name, create_bars_table, table_bar_writer, op.vwap, "update")


def trades_table(spark, sf_dir):
    return _into_table(
        spark, sf_dir, "trades_table", create_trades_table, table_trade_writer,
        lambda t: t, "append",
    ).drop("ingested_at", "query_id", "batch_id")


def vwap_versions(spark, sf_dir):
    return _bar_versions(spark, sf_dir, "vwap_versions").drop(
        "ingested_at", "query_id", "batch_id")


def vwap_latest_version(spark, sf_dir):
    return op.latest_bars(_bar_versions(spark, sf_dir, "vwap_latest_version")).drop(
        "ingested_at", "query_id", "batch_id")


def trades_keyed(spark, sf_dir):
    home = scratch(spark, "trades_keyed")
    first, second, third = parts(spark, sf_dir)
    delivered_twice = [first, second, second, third]
    sink = _to_batches(keyed_trade_writer(symbol_metadata(spark), f"{home}/keyed"))
    _feed(spark, home, delivered_twice, lambda t: t, "append", sink, "trades_keyed")
    return read_keyed_trades(spark, f"{home}/keyed")


def vwap_keyed(spark, sf_dir):
    home = scratch(spark, "vwap_keyed")
    sink = _to_batches(keyed_bar_writer(symbol_metadata(spark), f"{home}/keyed"))
    _feed(spark, home, parts(spark, sf_dir), op.vwap, "update", sink, "vwap_keyed")
    return read_keyed_bars(spark, f"{home}/keyed")


QUERIES = {
    "stream_whales": stream_whales,
    "stream_vwap_final": stream_vwap_final,
    "stream_vwap_latest": stream_vwap_latest,
    "stream_velocity": stream_velocity,
    "stream_moving_avg": stream_moving_avg,
    "stream_velocity_final": stream_velocity_final,
    "stream_moving_avg_final": stream_moving_avg_final,
    "stream_restart": stream_restart,
    "stream_late_drop": stream_late_drop,
    "stream_high_low_24h": stream_high_low_24h,
    "stream_late_counts": stream_late_counts,
    "stream_open_bars": stream_open_bars,
    "stream_late_kept_rows": stream_late_kept_rows,
    "stream_four_queries": stream_four_queries,
    "raw_frames": raw_frames,
    "raw_replay": raw_replay,
    "trades_table": trades_table,
    "vwap_versions": vwap_versions,
    "vwap_latest_version": vwap_latest_version,
    "trades_keyed": trades_keyed,
    "vwap_keyed": vwap_keyed,
}
