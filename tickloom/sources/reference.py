"""Static symbol tables.

The two taxonomies label the same symbols differently and serve different queries, so they
stay apart. No join here carries a broadcast hint: Catalyst broadcasts these tables because
their size is known and below ``spark.sql.autoBroadcastJoinThreshold``, and falls back to a
shuffled join when a user brings a table that is not.
"""

from __future__ import annotations

from collections.abc import Callable
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.schema import (
    METADATA_ROWS, METADATA_SCHEMA, REFERENCE_ROWS, TRACKED_SYMBOLS,
)


def _literal(value: str | int) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "\\'") + "'"


def _inline_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    # A VALUES relation has known statistics; a DataFrame made from a Python list has none.
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def symbol_reference(spark: SparkSession) -> DataFrame:
    """Market-cap rank and asset class of the five headline pairs."""
    names = ["ref_symbol", "base_asset", "quote_asset", "mcap_rank", "asset_class"]
    return _inline_table(spark, REFERENCE_ROWS, names).withColumn(
        "mcap_rank", F.col("mcap_rank").cast("bigint")
    )


def symbol_metadata(spark: SparkSession) -> DataFrame:
    """Category, tier and description of twenty pairs."""
    rows = [(base + "USDT", base, "USDT", *rest) for base, *rest in METADATA_ROWS]
    return _inline_table(spark, rows, METADATA_SCHEMA.names)


#: The file that names the current version's folder.
POINTER = "_current"


def publish_symbol_metadata(
    spark: SparkSession, path: str, metadata: DataFrame | None = None, keep: int = 2
) -> str:
    """Put metadata on shared storage as CSV with a header, beside jobs that read what was there.

    Each publication is a folder of its own. When it is whole a small file is replaced, in one step,
    that names it; readers follow that file. The last ``keep`` versions stay, so a batch that
    is reading the one before is not disturbed. Returns the new folder.
    """
    version = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = symbol_metadata(spark) if metadata is None else metadata
    rows.select(*METADATA_SCHEMA.names).coalesce(1).write.option("header", "true").csv(f"{path}/{version}")
    _, system = _file_system(spark, path)
    named = _path(spark, f"{path}/.{version}")
    out = system.create(named, True)
    out.write(version.encode())
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration()).rename(
        system.makeQualified(named), system.makeQualified(_path(spark, f"{path}/{POINTER}")), how)
    stored = sorted(s.getPath().getName() for s in system.globStatus(_path(spark, f"{path}/version-*")))
    for old in stored[:-keep]:
        if old != version:
            system.delete(_path(spark, f"{path}/{old}"), True)
    return f"{path}/{version}"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    place = _path(spark, path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str:
    """The folder to read: the one that was published last, or the path itself if it holds plain CSV."""
    place, system = _file_system(spark, f"{path}/{POINTER}")
    if not system.exists(place):
        return path
    lines = system.open(place)
    try:
        return f"{path}/{lines.readLine()}"
    finally:
        lines.close()


def _read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).option("header", "true").csv(folder)


def load_symbol_metadata(spark: SparkSession, path: str, cache: bool = False) -> DataFrame:
    """Read metadata CSV as it is now. ``cache`` keeps it for jobs that join it in every micro-batch."""
    df = _read_metadata(spark, current_version(spark, path))
    if cache:
        df = df.cache()
        df.count()
    return df


def following_metadata(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    """A function that gives the metadata published last, for joins inside a running job.

    Each call looks at the file that names the version; a version is read once, and kept.
    """
    held: dict[str, DataFrame] = {}

    def current() -> DataFrame:
        folder = current_version(spark, path)
        if folder not in held:
            for old in held.values():
                old.unpersist()
            held.clear()
            held[folder] = _read_metadata(spark, folder).cache()
        return held[folder]

    return current


def _clean(text: Column) -> Column:
    return F.upper(F.btrim(text, F.lit(" \t\r\n")))


def tracked_symbols(spark: SparkSession, symbols: str = TRACKED_SYMBOLS) -> DataFrame:
    """The watch list: comma-separated text to one upper-case symbol per row."""
    return (
        spark.range(1)
        .select(F.explode(F.split(F.lit(symbols), ",")).alias("symbol"))
        .select(_clean(F.col("symbol")).alias("symbol"))
    )
