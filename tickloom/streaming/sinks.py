"""Durable sinks.

Every writer is a ``foreachBatch`` function whose work is one Spark write from the executors.
Spark hands a batch to ``foreachBatch`` again when it was not committed before a failure, so
each sink defines what a repeat does:

* keyed tables: a batch owns one folder and overwrites it, readers take the newest version of
  each key, so a repeat changes nothing;
* plain tables: rows are appended. The first batch after a (re)start is looked for in the table:
  if all its rows are there it is skipped, and if a failed commit left a part of it, that part's
  files, which hold no other batch, are deleted first.

Batches are told apart by the query's id and the batch id. A caller who uses a writer outside
a stream must therefore give every batch an id of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.operators.enrich import bar_cells, enrich_bars, enrich_trades, trade_cells
from tickloom.operators.serving import last_write, recent_trades
from tickloom.schema import (
    BARS_TABLE_COLUMNS, BARS_TABLE_PARTITIONS, KEYED_BARS, KEYED_TRADES, TRADES_TABLE_COLUMNS,
    TRADES_TABLE_PARTITIONS,
)
from tickloom.streaming.store import NO_DAY, VERSION_COLUMNS, compact_days, exists, newest_days, read_stored

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]

# A static table, or what gives the current one to every batch.
Static = DataFrame | Callable[[], DataFrame]


def _now(table: Static) -> DataFrame:
    return table if isinstance(table, DataFrame) else table()


def _property(batch: DataFrame, name: str) -> str | None:
    return batch.sparkSession.sparkContext.getLocalProperty(name)


def _query_id(batch: DataFrame) -> str:
    """Id of the running query. It lives in the checkpoint, so it survives restarts."""
    return _property(batch, "sql.streaming.queryId") or "batch"


def _run_id(batch: DataFrame) -> str | None:
    """Id of this start of the query: streams use it as their job group."""
    return _property(batch, "spark.jobGroup.id")


def _counted(batch: DataFrame, key: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of running the batch a second time."""
    seen = Observation()
    keyless = F.count_if(F.col(key).isNull() if key else F.lit(False))
    return batch.observe(seen, F.count(F.lit(1)).alias("rows"), keyless.alias("keyless")), seen


def _create_table(
    spark: SparkSession,
    name: str,
    columns: list[tuple[str, str]],
    partitions: list[str],
    location: str | None,
) -> None:
    """Create a table if absent. One with a location finds what an earlier session stored there."""
    body = ", ".join(f"{column} {kind}" for column, kind in columns)
    at = f"LOCATION '{location}'" if location else ""
    known = spark.catalog.tableExists(name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet "
        f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(partitions)}) {at}"
    )
    if location and not known and exists(spark, location):
        spark.catalog.recoverPartitions(name)


def create_trades_table(
    spark: SparkSession, name: str = "trades", location: str | None = None
) -> None:
    _create_table(spark, name, TRADES_TABLE_COLUMNS, TRADES_TABLE_PARTITIONS, location)


def create_bars_table(
    spark: SparkSession, name: str = "vwap_bars", location: str | None = None
) -> None:
    _create_table(spark, name, BARS_TABLE_COLUMNS, BARS_TABLE_PARTITIONS, location)


def table_names(spark: SparkSession) -> list[str]:
    return [table.name for table in spark.catalog.listTables()]


def _stored(
    rows: DataFrame, table: str, query_id: str, batch_id: int, within: str
) -> tuple[int, DataFrame]:
    """Size of a batch, and what the table has of it.

    The search is bounded to the days the batch covers in the column ``within``, by partition or
    by file statistics, and to rows without one.
    """
    day = F.to_date(within)
    size, low, high = rows.agg(F.count(F.lit(1)), F.min(day), F.max(day)).first()
    days = F.col(within).isNull()
    if low is not None:
        days |= (F.col(within) >= F.lit(low)) & (F.col(within) < F.lit(high + timedelta(days=1)))
    return size, rows.sparkSession.table(table).filter(
        days & (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id))


def _delete_part(stored: DataFrame, table: str) -> None:
    """Delete the files of a batch that was stored in part: as many as its tasks wrote."""
    spark = stored.sparkSession
    files = [row.file for row in stored.select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        path.getFileSystem(conf).delete(path, False)
    spark.catalog.refreshTable(table)


def _append_writer(
    table: str,
    columns: list[str],
    within: str,
    prepare: Callable[[DataFrame], DataFrame],
    layout: Callable[[DataFrame], DataFrame],
) -> BatchWriter:
    checked: set[str | None] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id, run_id = _query_id(batch), _run_id(batch)
        rows = prepare(batch)
        # Only the first batch of a run can be a repeat. The check reads the whole batch, as a
        # stateful stream demands of every batch.
        if run_id not in checked:
            size, stored = _stored(rows, table, query_id, batch_id, within)
            found = stored.count()
            if found != size:
                if found:
                    log.warning("%s: batch %d has %d of %d rows; replaced", table, batch_id, found, size)
                    _delete_part(stored, table)
            elif size:
                log.info("%s: batch %d is already stored", table, batch_id)
                checked.add(run_id)
                return
            checked.add(run_id)
        stamped = (
            rows.withColumn("ingested_at", F.current_timestamp())
            .withColumn("query_id", F.lit(query_id))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        )
        counted, seen = _counted(layout(stamped.select(*columns)))
        counted.write.insertInto(table)
        log.info("%s: batch %d appended %d rows", table, batch_id, seen.get["rows"])

    return write


def _spread(rows: DataFrame, share: str, *by: str) -> DataFrame:
    """Few files a partition and batch, yet no partition's rows in one task.

    Adaptive execution splits partitions by size. Streams with state run without it; there as
    many tasks share a partition as the session has shuffle partitions.
    """
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", *by)
    tasks = int(conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(*by, F.pmod(F.xxhash64(share), F.lit(tasks)))


def table_trade_writer(table: str = "trades") -> BatchWriter:
    """Append trades to a table partitioned by symbol and date."""
    return _append_writer(
        table,
        [name for name, _ in TRADES_TABLE_COLUMNS],
        "trade_date",
        lambda batch: batch.withColumn("trade_date", F.to_date("event_ts")),
        lambda rows: _spread(rows, "trade_id", *TRADES_TABLE_PARTITIONS),
    )


def table_bar_writer(table: str = "vwap_bars") -> BatchWriter:
    """Append bar versions to a table partitioned by symbol.

    In update mode a bar arrives again in every batch that changes it. All versions are kept;
    ``operators.latest_bars`` reads the newest. A symbol's backlog is written by day.
    """
    return _append_writer(
        table,
        [name for name, _ in BARS_TABLE_COLUMNS],
        "window_start",
        lambda batch: batch,
        lambda rows: rows.repartition(F.col("symbol"), F.to_date("window_start")),
    )


def read_newest_trades(spark: SparkSession, table: str, symbols: list[str]) -> DataFrame:
    """The rows of a trades table that can hold the newest trade of each symbol.

    Days come from the catalog's partitions, a symbol's newest first. A symbol none of whose trades of that day has an id
    goes back, twice as many days each time. Trade ids of a symbol rise with time, so no older day holds a later id.
    Trades without a time have a partition of their own, which is always read. ``symbols`` is a watch list: it and
    one day for each are all that reaches the driver.
    """
    whole = spark.table(table)
    wanted = F.col("symbol").isin(*symbols)
    days: dict[str, list[date]] = {}
    for row in _partitions(spark, table).filter(wanted).collect():
        days.setdefault(row.symbol, []).append(row.trade_date)
    days = {symbol: sorted((d for d in own if d), reverse=True) for symbol, own in days.items()}
    width = dict.fromkeys(days, 1)

    def rows(some: dict[str, list[date]]) -> DataFrame:
        """Symbols with the same first day share a condition, so there are as many as days."""
        since: dict[date, list[str]] = {}
        for symbol, own in some.items():
            if own:
                since.setdefault(own[min(width[symbol], len(own)) - 1], []).append(symbol)
        reach = wanted & F.col("trade_date").isNull()
        for first, names in sorted(since.items()):
            reach |= F.col("symbol").isin(*names) & (F.col("trade_date") >= F.lit(first))
        return whole.filter(reach)

    while True:
        found = rows(days)
        held = {row.symbol for row in found.filter("trade_id IS NOT NULL").select("symbol").distinct().collect()}
        back = [symbol for symbol, own in days.items() if symbol not in held and width[symbol] < len(own)]
        if not back:
            return found
        width.update({symbol: 2 * width[symbol] for symbol in back})


def _partitions(spark: SparkSession, table: str) -> DataFrame:
    """symbol and trade_date of every partition of a trades table, from the catalog."""
    name = F.split("partition", "/")

    def value(k: int) -> Column:
        text = F.url_decode(F.replace(F.substring_index(name[k], "=", -1), F.lit("+"), F.lit("%2B")))
        return F.nullif(text, F.lit(NO_DAY))

    return spark.sql(f"SHOW PARTITIONS {table}").select(
        value(0).alias("symbol"), value(1).try_cast("date").alias("trade_date"))


def version_writer(
    path: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    sort: str | None = None,
    day: str | None = None,
) -> BatchWriter:
    """Write each batch to a folder of its own, replaced whole if the batch is repeated.

    The cost of a batch is the size of the batch: nothing that is already stored is rewritten.
    An empty batch leaves an empty folder; probing for it first would run the batch twice.
    ``sort`` orders rows within files, so that readers skip pages by that column, and ``day``,
    a SQL expression for a time, splits the folder by date; neither needs a shuffle.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/query_id={_query_id(batch)}/batch_id={batch_id}"
        rows, seen = _counted(prepare(batch).withColumn("ingested_at", F.current_timestamp()), sort)
        _write_sorted(rows, folder, sort, day, "overwrite")
        counts = seen.get
        log.info("%s: batch %d wrote %d rows", path, batch_id, counts["rows"])
        if counts["keyless"]:
            log.warning("%s: batch %d has %d rows without a key", path, batch_id, counts["keyless"])

    return write


def _write_sorted(
    rows: DataFrame, folder: str, sort: str | None, day: str | None, mode: str
) -> None:
    by_day = [] if day is None else ["day"]
    if by_day:
        rows = rows.withColumn("day", F.to_date(F.expr(day)))
    order = by_day + ([sort] if sort else [])
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows.write.mode(mode).partitionBy(*by_day).parquet(folder)


def read_versions(spark: SparkSession, path: str, columns: StructType | None = None) -> DataFrame:
    """Everything ``version_writer`` stored, with the batch that stored it.

    ``columns`` are those that were written, by day; with them, a table that has had empty batches
    only is empty. Without them the schema is the files'.
    """
    if columns is None:
        return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    added = StructType.fromDDL(VERSION_COLUMNS)
    return spark.read.schema(StructType(columns.fields + added.fields)).parquet(path)


TRADE_DAY = "timestamp_millis(trade_ts)"
BAR_DAY = "window_start"


def keyed_trade_writer(metadata: Static, path: str) -> BatchWriter:
    """Put enriched trades by row key; the last write of a key wins.

    Trades without a symbol or id have no key. They are kept beside the others, see
    ``read_rejects``, and never replace one another.
    """
    return version_writer(
        path, lambda batch: trade_cells(enrich_trades(batch, _now(metadata))), "row_key", TRADE_DAY)


def keyed_bar_writer(metadata: Static, path: str) -> BatchWriter:
    """Put enriched bars by row key; the last write of a key wins."""
    return version_writer(
        path, lambda batch: bar_cells(enrich_bars(batch, _now(metadata))), "row_key", BAR_DAY)


def _current(versions: DataFrame, *keys: str) -> DataFrame:
    rows = last_write(versions.filter("row_key IS NOT NULL"), *keys)
    return rows.drop("query_id", "batch_id", "ingested_at", "day")


def _read_keyed(
    spark: SparkSession, path: str, columns: StructType, since: str | date | None, *keys: str
) -> DataFrame:
    """Last write of every key. Filters on the keys pass below the windows to the scan.

    Keys spread evenly whatever the symbols do, and a key has as many rows as it has versions. One
    shuffle serves both windows.
    """
    versions = read_stored(spark, path, columns, since and date.fromisoformat(str(since)))
    return _current(versions.repartition(*keys), *keys)


TRADE_KEY = ("symbol", "row_key")
BAR_KEY = ("symbol", "window_start", "row_key")


def read_keyed_trades(
    spark: SparkSession, path: str, since: str | date | None = None
) -> DataFrame:
    """Current trades. ``since`` reads only trades of that UTC day and later."""
    return _read_keyed(spark, path, KEYED_TRADES, since, *TRADE_KEY)


def read_keyed_bars(
    spark: SparkSession, path: str, since: str | date | None = None
) -> DataFrame:
    """Current bars. ``since`` reads only bars of that UTC day and later."""
    return _read_keyed(spark, path, KEYED_BARS, since, *BAR_KEY)


def read_recent_trades(spark: SparkSession, path: str, symbol: str, limit: int = 30) -> DataFrame:
    """A symbol's newest trades, newest first, from as few of the newest days as hold them.

    Trade ids of a symbol rise with time, so no older day holds a later id. Only a day's trades of the
    symbol are read: files are sorted by key, and the filter reaches their statistics.
    """
    def newest(versions: DataFrame) -> DataFrame:
        own = versions.filter(F.col("symbol") == symbol.upper())
        return recent_trades(_current(own.repartition(*TRADE_KEY), *TRADE_KEY), symbol, limit)

    return newest_days(spark, path, KEYED_TRADES, newest, limit)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Trades that were put without a key, each as often as it came, with its batch."""
    return read_stored(spark, path, KEYED_TRADES).filter("row_key IS NULL")


def compact_keyed_trades(spark: SparkSession, path: str, before: str | date):
    """Compact a keyed table of trades in place while jobs write to it; see ``store.compact_days``."""
    return compact_days(spark, path, KEYED_TRADES, before)


def compact_keyed_bars(spark: SparkSession, path: str, before: str | date):
    """Compact a keyed table of bars in place while jobs write to it; see ``store.compact_days``."""
    return compact_days(spark, path, KEYED_BARS, before)


def compact_keyed(spark: SparkSession, path: str, target: str, day: str) -> None:
    """Write a keyed table's current content to a new place, range-partitioned by key.

    ``day`` is ``TRADE_DAY`` or ``BAR_DAY``. Ranges of row keys split a large symbol over many
    files, and a key or a symbol is found by file statistics. The folder names let readers and
    later batches go on there. No job may write to the old place meanwhile: if a batch has
    arrived there when all is written, this fails, and the target must not be used.
    """
    before = _batches(spark, path)
    columns = KEYED_TRADES if day == TRADE_DAY else KEYED_BARS
    # Ranges of the key also bring its versions together, so one shuffle serves both.
    versions = read_stored(spark, path, columns).repartitionByRange("row_key")
    rows = _current(versions, "symbol", "row_key").unionByName(
        versions.filter("row_key IS NULL").select(*columns.names))
    folder = f"{target}/query_id=compacted/batch_id=-1"
    _write_sorted(
        rows.withColumn("ingested_at", F.current_timestamp()), folder, "row_key", day, "errorifexists")
    if _batches(spark, path) != before:
        raise RuntimeError(f"a batch was written to {path} during its compaction")


def _batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """Folder and time of every batch in a keyed table."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/query_id=*/batch_id=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return {(status.getPath().toString(), status.getModificationTime()) for status in found or []}


def land_frames(raw: DataFrame, path: str):
    """Append every frame unchanged to a bronze folder, split by the day it arrived on.

    That is the day of the topic's timestamp, or of the batch. Returns an unstarted stream writer.
    """
    keep = [c for c in ["topic", "partition", "offset", "timestamp"] if c in raw.columns]
    arrived = F.col("timestamp") if "timestamp" in keep else F.current_timestamp()
    return (
        raw.select("value", *keep, F.to_date(arrived).alias("landed"))
        .writeStream.format("parquet").partitionBy("landed")
        .outputMode("append").option("path", path)
    )
