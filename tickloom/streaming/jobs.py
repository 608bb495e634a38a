"""The streaming jobs: console analytics, partitioned tables, keyed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators.enrich import vwap_with_class
from tickloom.operators.windows import moving_avg, velocity, vwap, whales
from tickloom.streaming.sinks import (
    Static, create_bars_table, create_trades_table, keyed_bar_writer, keyed_trade_writer,
    table_bar_writer, table_trade_writer,
)

CONSOLE_ROWS = {
    "vwap_1min": 20,
    "trade_velocity_30s": 30,
    "whale_alerts": 10,
    "moving_avg_price": 20,
}

# Adds a sink to a writer, given the query's name.
Sink = Callable[[DataStreamWriter, str], DataStreamWriter]


def console_sink(writer: DataStreamWriter, name: str) -> DataStreamWriter:
    return (
        writer.format("console").option("truncate", False)
        .option("numRows", CONSOLE_ROWS.get(name, 20))
    )


def start(
    frame: DataFrame,
    name: str,
    mode: str,
    checkpoint: str,
    sink: Sink,
    once: bool = False,
) -> StreamingQuery:
    """Start one named query with its own checkpoint; ``once`` stops when caught up."""
    writer = (
        frame.writeStream.outputMode(mode).queryName(name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return sink(writer, name).start()


def console_branches(
    trades: DataFrame, reference: DataFrame, threshold: float = 50000.0
) -> list[tuple[str, str, DataFrame]]:
    """Name, output mode and rows of bars, velocity, large trades and moving average."""
    return [
        ("vwap_1min", "update", vwap_with_class(trades, reference)),
        ("trade_velocity_30s", "update", velocity(trades)),
        ("whale_alerts", "append", whales(trades, threshold)),
        ("moving_avg_price", "update", moving_avg(trades)),
    ]


def landed_trades(
    spark: SparkSession, landed: str, schema: T.StructType, lateness: str = "30 seconds"
) -> DataFrame:
    """Parsed trades as a stream, from the folder a parsing query lands them in."""
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    place = spark._jvm.org.apache.hadoop.fs.Path(landed)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return spark.readStream.schema(plain).parquet(landed).withWatermark("event_ts", lateness)


def start_console_job(
    trades: DataFrame,
    reference: DataFrame,
    checkpoint: str,
    threshold: float = 50000.0,
    sink: Sink = console_sink,
    once: bool = False,
    landed: str | None = None,
) -> list[StreamingQuery]:
    """Bars, velocity, large trades and moving average, each as its own query.

    With ``landed`` a first query, ``parsed_trades``, parses the frames once and lands trades in that
    folder; the four read it, each only the columns it needs. Spark's own log of the folder tells
    them which files count, so a trade is landed and read once whatever is restarted.
    """
    first = []
    if landed:
        first = [start(trades, "parsed_trades", "append", checkpoint,
                       lambda w, _: w.format("parquet").option("path", landed), once)]
        if once:  # the others stop when they have caught up with what is landed
            first[0].awaitTermination()
        trades = landed_trades(trades.sparkSession, landed, trades.schema)
    return first + [
        start(frame, name, mode, checkpoint, sink, once)
        for name, mode, frame in console_branches(trades, reference, threshold)
    ]


def _bar_mode(final_bars: bool) -> str:
    return "append" if final_bars else "update"


def start_table_job(
    spark: SparkSession,
    trades: DataFrame,
    checkpoint: str,
    trades_table: str = "trades",
    bars_table: str = "vwap_bars",
    final_bars: bool = False,
    once: bool = False,
    location: str | None = None,
) -> list[StreamingQuery]:
    """Trades and bars to partitioned tables, which are created if absent.

    Without a persistent catalog a restarted job finds its tables only by ``location``, a folder
    for both. With one it can be left out.
    By default a bar is stored anew in every batch that changes it. ``final_bars`` stores it
    once, when the watermark has closed it.
    """
    create_trades_table(spark, trades_table, location and f"{location}/{trades_table}")
    create_bars_table(spark, bars_table, location and f"{location}/{bars_table}")
    return [
        start(trades, "table_trades", "append", checkpoint,
              lambda w, _: w.foreachBatch(table_trade_writer(trades_table)), once),
        start(vwap(trades), "table_bars", _bar_mode(final_bars), checkpoint,
              lambda w, _: w.foreachBatch(table_bar_writer(bars_table)), once),
    ]


def start_keyed_job(
    trades: DataFrame,
    metadata: Static,
    path: str,
    checkpoint: str,
    final_bars: bool = False,
    once: bool = False,
) -> list[StreamingQuery]:
    """Enriched trades and bars to keyed tables under ``path``.

    ``metadata`` is a table, or a function that gives the current one to every batch.
    """
    return [
        start(trades, "keyed_trades", "append", checkpoint,
              lambda w, _: w.foreachBatch(keyed_trade_writer(metadata, f"{path}/trades")), once),
        start(vwap(trades), "keyed_bars", _bar_mode(final_bars), checkpoint,
              lambda w, _: w.foreachBatch(keyed_bar_writer(metadata, f"{path}/bars")), once),
    ]


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until one of the queries ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
