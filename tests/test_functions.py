import pytest
from pyspark.sql import functions as F

from tickloom.functions import (
    compact_notional, compact_volume, decode_double, decode_long, decode_text, epoch_seconds,
    known, money, parse_mixed_ts, price_label, price_label_fine, row_key, zfill,
)


@pytest.fixture(scope="module")
def value(spark):
    """Value of an expression over one input."""
    def evaluate(function, item, kind):
        return spark.createDataFrame([(item,)], f"x {kind}").select(function(F.col("x"))).first()[0]

    return evaluate


@pytest.mark.parametrize("number, text", [(7, "007"), (1234, "1234"), (None, None)])
def test_zfill_never_cuts(value, number, text):
    assert value(lambda c: zfill(c, 3), number, "bigint") == text


def test_row_keys_sort_like_numbers(value):
    key = lambda n: value(lambda c: row_key(F.lit("BTCUSDT"), c, 20), n, "bigint")
    assert key(42) == "BTCUSDT#" + "0" * 18 + "42"
    assert key(9) < key(10) < key(10**18)


@pytest.mark.parametrize("cell, number", [
    ("1.5", 1.5), ("abc", 0.0), ("", 0.0), (None, 0.0), ("-2", -2.0), ('{"k": 1}', 0.0)])
def test_decode_double(value, cell, number):
    assert value(decode_double, cell, "string") == number


@pytest.mark.parametrize("cell, number", [("15", 15), ("1.5", 0), ("x", 0), (None, 0)])
def test_decode_long(value, cell, number):
    assert value(decode_long, cell, "string") == number


def test_decode_text(value):
    assert value(decode_text, None, "string") == ""
    assert value(lambda c: decode_text(c, "BTCUSDT"), None, "string") == "BTCUSDT"


@pytest.mark.parametrize("text, second", [
    ("1704067200500", 1704067200.5), ("2024-01-01T00:00:00.500", 1704067200.5),
    ("2024-01-01 00:00:01", 1704067201), ("2024-01-01T01:00:00+01:00", 1704067200),
    ("", None), ("soon", None), (None, None)])
def test_mixed_timestamps(value, text, second):
    found = value(parse_mixed_ts, text, "string")
    assert (found and found.timestamp()) == second


@pytest.mark.parametrize("number, text", [
    (2.5e9, "2.5B"), (1.25e6, "1.3M"), (1000.0, "1.0K"), (999.4, "999"), (2.5, "3"), (0.0, "0")])
def test_compact_notional(value, number, text):
    assert value(compact_notional, number, "double") == text


@pytest.mark.parametrize("number, text", [
    (2.5e9, "2500.00M"), (1234.5, "1.23K"), (12.34567, "12.3457"), (0.0, "0.0000")])
def test_compact_volume(value, number, text):
    assert value(compact_volume, number, "double") == text


def test_price_labels(value):
    assert value(price_label, 78235.1, "double") == "$78,235.1"
    assert value(price_label, 1000.0, "double") == "$1,000"
    assert value(price_label_fine, 0.12345, "double") == "$0.1235"
    assert value(money, 36.7705158, "double") == "$36.77"
    assert value(money, 0.125, "double") == "$0.13"


@pytest.mark.parametrize("text, shown", [
    ("Layer1", "Layer1"), ("", None), ("Unknown", None), (None, None)])
def test_known(value, text, shown):
    assert value(known, text, "string") == shown


def test_instants_are_utc():
    assert epoch_seconds("2024-01-01 00:00:00") == 1704067200
    assert epoch_seconds("2024-01-01 01:00:00+01:00") == 1704067200
    assert epoch_seconds(1704067200.9) == 1704067200
