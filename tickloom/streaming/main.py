"""Run a streaming job: ``spark-submit … -m tickloom.streaming.main <job>``.

Jobs: ``console``, ``tables``, ``keyed`` and ``land``. A Kafka source needs the Spark Kafka
connector on the class path. Options default to environment variables of the same meaning.
"""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import parse_trades
from tickloom.sources import (
    file_frames, following_metadata, kafka_frames, symbol_metadata, symbol_reference,
)
from tickloom.streaming.jobs import (
    await_any, start_console_job, start_keyed_job, start_table_job,
)
from tickloom.streaming.scratch import scratch_root
from tickloom.streaming.sinks import land_frames


def session(name: str, hive: bool = False, partitions: int | None = None) -> SparkSession:
    """State lives in RocksDB, off the heap, with incremental uploads to the checkpoint.

    ``partitions`` is the number of state partitions. A checkpoint fixes it for good.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.streaming.stopGracefullyOnShutdown", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", partitions)
    return (builder.enableHiveSupport() if hive else builder).getOrCreate()


def options(arguments: list[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["console", "tables", "keyed", "land"])
    parser.add_argument("--kafka", default=env("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"))
    parser.add_argument("--topic", default=env("KAFKA_TOPIC", "trades-raw"))
    parser.add_argument("--files", help="read landed frames from a folder, not from Kafka")
    parser.add_argument("--max-files", type=int, help="files per batch when catching up")
    parser.add_argument("--max-offsets", type=int, help="records per batch when catching up")
    parser.add_argument("--output", default=env("OUTPUT_DIR"), help="tables, bronze folder")
    parser.add_argument("--checkpoint", default=env("CHECKPOINT_DIR"))
    parser.add_argument("--metadata", default=env("SYMBOL_METADATA_PATH"))
    parser.add_argument("--threshold", type=float,
                        default=float(env("WHALE_THRESHOLD_USD", "50000")))
    parser.add_argument("--parsed", default=env("PARSED_DIR"),
                        help="parse once into this folder for the console queries")
    parser.add_argument("--trades-table", default="trades")
    parser.add_argument("--bars-table", default="vwap_bars")
    parser.add_argument("--final-bars", action="store_true")
    parser.add_argument("--hive", action="store_true", help="keep tables in a Hive catalog")
    parser.add_argument("--partitions", type=int, help="state partitions of a new checkpoint")
    parser.add_argument("--once", action="store_true", help="stop when caught up")
    return parser.parse_args(arguments)


def run(spark: SparkSession, opts: argparse.Namespace) -> list:
    """Start the job's queries."""
    checkpoint = opts.checkpoint or f"{scratch_root(spark)}/{opts.job}-checkpoints"

    def output() -> str:
        return opts.output or f"{scratch_root(spark)}/{opts.job}"

    raw = file_frames(spark, opts.files, opts.max_files) if opts.files else \
        kafka_frames(spark, opts.kafka, opts.topic, max_offsets=opts.max_offsets)
    if opts.job == "land":
        writer = land_frames(raw, output()).option("checkpointLocation", f"{checkpoint}/land")
        return [(writer.trigger(availableNow=True) if opts.once else writer).start()]
    trades: DataFrame = parse_trades(raw)
    if opts.job == "console":
        return start_console_job(
            trades, symbol_reference(spark), checkpoint, opts.threshold, once=opts.once,
            landed=opts.parsed)
    if opts.job == "tables":
        return start_table_job(
            spark, trades, checkpoint, opts.trades_table, opts.bars_table,
            opts.final_bars, opts.once, None if opts.hive else output())
    metadata = following_metadata(spark, opts.metadata) if opts.metadata \
        else symbol_metadata(spark)
    return start_keyed_job(
        trades, metadata, output(), checkpoint, opts.final_bars, opts.once)


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    opts = options()
    spark = session(f"tickloom-{opts.job}", opts.hive, opts.partitions)
    queries = run(spark, opts)
    if opts.once:
        for query in queries:
            query.awaitTermination()
    else:
        await_any(spark, queries)


if __name__ == "__main__":
    main()
