"""Where raw frames come from: a Kafka topic, or files that hold landed frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schema import RAW_SCHEMA


def kafka_frames(
    spark: SparkSession,
    servers: str = "localhost:9092",
    topic: str = "trades-raw",
    starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Live frames. ``max_offsets`` bounds the size of a micro-batch when catching up."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def kafka_history(
    spark: SparkSession, servers: str = "localhost:9092", topic: str = "trades-raw"
) -> DataFrame:
    """The whole topic from its beginning, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def file_frames(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed frames as a stream, oldest file first."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*RAW_SCHEMA.names)


def file_history(spark: SparkSession, path: str, since: str | date | None = None) -> DataFrame:
    """Landed frames as a batch, from the beginning or from those that landed on a UTC day on."""
    if since is None:
        return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_SCHEMA.names)
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("landed", T.DateType())])
    frames = spark.read.schema(schema).parquet(path)
    return frames.filter(F.col("landed") >= F.lit(str(since)).cast("date")).drop("landed")
