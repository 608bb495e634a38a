"""Writers called as a micro-batch would call them."""

import subprocess
import sys
import tempfile
import textwrap
from types import SimpleNamespace
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, frame
from tickloom.operators import last_write, latest_bars, newest_version, parse_trades, vwap, vwap_range
from tickloom.schema import TRADES_TABLE_COLUMNS
from tickloom.sources import file_frames, symbol_metadata
from tickloom.streaming import jobs, scratch as scratch_module, sinks
from tickloom.streaming.sinks import (
    compact_keyed, create_bars_table, create_trades_table, keyed_bar_writer,
    keyed_trade_writer, read_keyed_bars, read_keyed_trades, read_rejects, read_versions,
    table_bar_writer, table_names, table_trade_writer, TRADE_DAY,
)


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(df):
    return sorted(map(repr, df.collect()))


def test_create_if_absent(spark, table):
    for _ in range(2):
        create_trades_table(spark, table)
    assert table in table_names(spark)
    assert spark.table(table).dtypes == TRADES_TABLE_COLUMNS
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert details["Provider"] == "parquet"


def test_trades_append_into_partitions(spark, trades, table):
    create_trades_table(spark, table)
    write = table_trade_writer(table)
    write(trades(frame(1, trade_id=1), frame(86400, trade_id=2)), 0)
    write(trades(frame(2, symbol="ETHUSDT", trade_id=3)), 1)
    assert {(r.symbol, str(r.trade_date), r.trade_id, r.batch_id)
            for r in spark.table(table).collect()} == {
        ("BTCUSDT", "2024-01-01", 1, 0), ("BTCUSDT", "2024-01-02", 2, 0),
        ("ETHUSDT", "2024-01-01", 3, 1)}
    day = spark.table(table).filter("symbol = 'BTCUSDT' AND trade_date = DATE'2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "symbol" in filters and "trade_date" in filters


def test_a_repeat_after_a_restart_appends_nothing(spark, trades, table):
    create_trades_table(spark, table)
    batch = trades(frame(1, trade_id=1), frame(2, trade_id=2))
    table_trade_writer(table)(batch, 0)
    table_trade_writer(table)(batch, 0)  # a new writer is a new start
    assert spark.table(table).count() == 2
    table_trade_writer(table)(batch, 1)  # another batch with equal rows is no repeat
    assert spark.table(table).count() == 4


def test_empty_batches_are_harmless(spark, trades, table):
    create_trades_table(spark, table)
    table_trade_writer(table)(trades("junk"), 0)
    assert spark.table(table).count() == 0


def test_rows_are_counted_while_they_are_written(spark, trades, table, caplog):
    create_trades_table(spark, table)
    with caplog.at_level("INFO", "tickloom.streaming.sinks"):
        table_trade_writer(table)(trades(frame(1), frame(2), "junk"), 7)
    assert caplog.messages == [f"{table}: batch 7 appended 2 rows"]


@pytest.mark.parametrize("setting", [
    ("spark.sql.adaptive.enabled", "false"),
    ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k"),
])
def test_large_symbol_is_written_by_several_tasks(spark, trades, table, setting):
    create_trades_table(spark, table)
    batch = trades(*[frame(1, trade_id=i) for i in range(400)])
    spark.conf.set(*setting)
    try:
        table_trade_writer(table)(batch, 0)
    finally:
        spark.conf.unset(setting[0])
    assert spark.table(table).count() == 400
    assert spark.table(table).select(F.input_file_name()).distinct().count() > 1


def test_bar_versions_and_latest(spark, trades, table):
    create_bars_table(spark, table)
    write = table_bar_writer(table)
    write(vwap(trades(frame(1))), 0)
    write(vwap(trades(frame(1), frame(2))), 1)
    assert spark.table(table).count() == 2
    assert [r.trade_count for r in latest_bars(spark.table(table)).collect()] == [2]


def test_keyed_trades_keep_one_row_per_key(spark, trades, tmp_path):
    write = keyed_trade_writer(symbol_metadata(spark), str(tmp_path / "k"))
    first = trades(frame(1, trade_id=1, price="1"), frame(1, trade_id=2, price="2"))
    write(first, 0)
    before = content(read_keyed_trades(spark, str(tmp_path / "k")))
    write(first, 0)  # the same batch again
    assert content(read_keyed_trades(spark, str(tmp_path / "k"))) == before
    write(trades(frame(1, trade_id=2, price="9"), frame(1, trade_id=3, price="3")), 1)
    rows = read_keyed_trades(spark, str(tmp_path / "k")).collect()
    assert {r.trade_id: r.price for r in rows} == {1: 1.0, 2: 9.0, 3: 3.0}
    assert {r.row_key for r in rows} == {"BTCUSDT#" + str(i).zfill(20) for i in (1, 2, 3)}


def test_keyed_bars_hold_the_last_version(spark, trades, tmp_path):
    write = keyed_bar_writer(symbol_metadata(spark), str(tmp_path / "k"))
    write(vwap(trades(frame(61))), 0)
    write(vwap(trades(frame(61), frame(62))), 1)
    row, = read_keyed_bars(spark, str(tmp_path / "k")).collect()
    assert (row.row_key, row.trade_count) == ("BTCUSDT#000001704067260", 2)
    assert (row.asset_category, row.market_cap_tier) == ("Layer1", "Large Cap")


def test_keyed_reads_push_symbol_and_key_to_the_scan(spark, trades, tmp_path):
    keyed_trade_writer(symbol_metadata(spark), str(tmp_path / "k"))(trades(frame()), 0)
    stored = read_keyed_trades(spark, str(tmp_path / "k"))
    plan = stored.filter("symbol = 'BTCUSDT' AND row_key >= 'BTCUSDT#5'")._jdf \
        .queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1]
    assert "EqualTo(symbol,BTCUSDT)" in pushed and "GreaterThanOrEqual(row_key" in pushed


def test_keyed_bars_push_time_and_day_to_the_scan(spark, trades, tmp_path):
    path = str(tmp_path / "k")
    keyed_bar_writer(symbol_metadata(spark), path)(
        vwap(trades(frame(61), frame(86400), frame(2 * 86400))), 0)
    assert read_keyed_bars(spark, path, since="2024-01-02").count() == 2
    recent = vwap_range(read_keyed_bars(spark, path, since="2024-01-03"), "BTCUSDT",
                        "2024-01-03 00:01:00")
    assert recent.count() == 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(window_start" in plan.split("PushedFilters: ")[1]
    assert "day" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_compaction_keeps_the_content_and_takes_further_batches(spark, trades, tmp_path):
    old, new = str(tmp_path / "k"), str(tmp_path / "c")
    meta = symbol_metadata(spark)
    for batch_id in range(3):
        keyed_trade_writer(meta, old)(
            trades(frame(1, trade_id=1, price=str(batch_id)),
                   frame(1, trade_id=10 + batch_id)), batch_id)
    compact_keyed(spark, old, new, TRADE_DAY)
    assert content(read_keyed_trades(spark, new)) == content(read_keyed_trades(spark, old))
    keyed_trade_writer(meta, new)(trades(frame(1, trade_id=1, price="7")), 3)
    assert {r.trade_id: r.price for r in read_keyed_trades(spark, new).collect()}[1] == 7.0


def test_range_partitioning_serves_the_newest_version_too(spark, trades, tmp_path):
    path = str(tmp_path / "k")
    keyed_trade_writer(symbol_metadata(spark), path)(trades(frame()), 0)
    ranged = read_versions(spark, path).repartitionByRange("row_key")
    plan = newest_version(ranged, "symbol", "row_key")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1


def _store(spark, table, writer, create, full, keep, batch_id=5):
    """Store part of a batch, replay it whole by a new writer, and return the table's rows."""
    create(spark, table)
    writer(table)(full, batch_id - 1)
    writer(table)(full.filter(keep), batch_id)
    writer(table)(full, batch_id)
    writer(table)(full, batch_id)
    return spark.table(table).filter(F.col("batch_id") == batch_id)


def test_half_committed_trades_are_completed(spark, trades, table):
    full = trades(*[frame(i * 3600, trade_id=i) for i in range(10)], frame(trade_id=99, T="bad"))
    stored = _store(spark, table, table_trade_writer, create_trades_table, full, "trade_id < 3")
    assert sorted(r.trade_id for r in stored.collect()) == [*range(10), 99]
    assert spark.table(table).count() == 22


def test_half_committed_bars_are_completed(spark, trades, table):
    full = vwap(trades(*[frame(i * 60, symbol=s) for i in range(5) for s in ("A", "B")]))
    stored = _store(spark, table, table_bar_writer, create_bars_table, full, "symbol = 'A'")
    assert stored.count() == 10


def test_trades_without_time_are_stored_once(spark, trades, table):
    batch = trades(frame(T="bad"))
    stored = _store(spark, table, table_trade_writer, create_trades_table, batch, "true")
    assert stored.count() == 1


def test_trades_without_a_key_are_all_kept(spark, trades, tmp_path):
    path = str(tmp_path / "k")
    batch = trades(frame(1, t="bad"), frame(2, t="bad"), frame(3, trade_id=3), frame(4, s=None))
    keyed_trade_writer(symbol_metadata(spark), path)(batch, 0)
    assert [r.trade_id for r in read_keyed_trades(spark, path).collect()] == [3]
    assert read_rejects(spark, path).count() == 3


def test_keyed_tables_of_empty_batches_are_empty(spark, trades, tmp_path):
    meta, nothing = symbol_metadata(spark), trades("junk")
    keyed_trade_writer(meta, str(tmp_path / "t"))(nothing, 0)
    keyed_bar_writer(meta, str(tmp_path / "b"))(vwap(nothing), 0)
    assert read_keyed_trades(spark, str(tmp_path / "t")).count() == 0
    assert read_keyed_bars(spark, str(tmp_path / "b")).count() == 0


def test_the_last_batch_wins_whatever_the_clock_said(spark):
    rows = [("q", 2, 10, "new"), ("q", 1, 99, "old"), ("compacted", -1, 500, "oldest")]
    versions = spark.createDataFrame(rows, "query_id string, batch_id long, at int, v string") \
        .withColumn("k", F.lit("k")).withColumn("ingested_at", F.timestamp_seconds("at"))
    assert [r.v for r in last_write(versions, "k").collect()] == ["new"]
    later = versions.union(versions.limit(0)).unionByName(spark.createDataFrame(
        [("r", 0, 200, "later", "k")], "query_id string, batch_id long, at int, v string, k string")
        .withColumn("ingested_at", F.timestamp_seconds("at")))
    assert [r.v for r in last_write(later, "k").collect()] == ["later"]


def test_compaction_fails_if_a_batch_arrives_meanwhile(spark, trades, tmp_path, monkeypatch):
    old, meta = str(tmp_path / "k"), symbol_metadata(spark)
    keyed_trade_writer(meta, old)(trades(frame(trade_id=1)), 0)
    write = sinks._write_sorted

    def and_another(*args):
        write(*args)
        monkeypatch.setattr(sinks, "_write_sorted", write)
        keyed_trade_writer(meta, old)(trades(frame(trade_id=2)), 1)

    monkeypatch.setattr(sinks, "_write_sorted", and_another)
    with pytest.raises(RuntimeError):
        compact_keyed(spark, old, str(tmp_path / "c"), TRADE_DAY)


def test_table_job_goes_on_in_another_process(tmp_path):
    """Two processes, one checkpoint, catalogs in memory: the second adds what has arrived."""
    script = textwrap.dedent(f"""
        import sys
        from pyspark.sql import functions as F
        sys.path[:0] = [{ROOT!r}, {ROOT + '/tests'!r}]
        from conftest import ROOT, frame
        from tickloom.streaming import main
        spark = main.session("t", partitions=2)
        spark.sparkContext.setLogLevel("ERROR")
        n = int(sys.argv[1])
        spark.createDataFrame([(bytearray(frame(i, trade_id=i), "utf8"),) for i in range(n, n + 5)],
                              "value binary").write.mode("append").parquet("{tmp_path}/frames")
        opts = main.options(["tables", "--files", "{tmp_path}/frames", "--checkpoint", "{tmp_path}/c",
                             "--output", "{tmp_path}/out", "--once"])
        for query in main.run(spark, opts):
            query.awaitTermination()
        print("ROWS", spark.table("trades").count(), spark.table("vwap_bars").count())
    """)
    said = [
        subprocess.run([sys.executable, "-c", script, n], cwd=tmp_path, capture_output=True,
                       text=True, timeout=200).stdout.split("ROWS ")[-1].strip() for n in ("0", "5")]
    assert said == ["5 1", "10 2"]


def test_table_job_creates_and_fills_both_tables(spark, raw, tmp_path):
    raw(frame(1), frame(61), frame(130)).write.parquet(str(tmp_path / "frames"))
    names = [f"j_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    stream = parse_trades(file_frames(spark, str(tmp_path / "frames")))
    for _ in range(2):  # a restart from the same checkpoint finds nothing new
        for query in jobs.start_table_job(
                spark, stream, str(tmp_path / "c"), *names, once=True):
            query.awaitTermination()
    assert [spark.table(name).count() for name in names] == [3, 3]
    assert spark.table(names[0]).select("query_id").distinct().count() == 1
    for name in names:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("shared, master, root", [
    ("hdfs://shared/dir/", "yarn", "hdfs://shared/dir"),
    ("/data/ck", "local[2]", "/data/ck"),
    (None, "local[2]", tempfile.gettempdir() + "/tickloom"),
])
def test_scratch_follows_the_session(shared, master, root):
    one, two = (scratch_module.scratch(session_of(shared, master), "x") for _ in range(2))
    assert one.startswith(f"{root}/x-") and one != two


def test_scratch_on_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        scratch_module.scratch(session_of(None, "yarn"), "x")


def session_of(shared, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master))
