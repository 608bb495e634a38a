import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START_MS = 1704067200000  # 2024-01-01 00:00:00 UTC


def frame(second=0.0, symbol="BTCUSDT", price="100.0", qty="1.0", trade_id=1, maker=False,
          **other) -> str:
    """JSON text of one trade; ``other`` replaces or, with ``...``, removes fields."""
    fields = {
        "e": "trade", "E": START_MS, "s": symbol, "t": trade_id, "p": price, "q": qty,
        "b": 1, "a": 2, "T": START_MS + round(second * 1000), "m": maker, "M": True, **other,
    }
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


@pytest.fixture(scope="session")
def raw(spark):
    """Frames as the DataFrame a source would give."""
    def build(*texts):
        return spark.createDataFrame([(bytearray(t, "utf8"),) for t in texts], "value binary")

    return build


@pytest.fixture(scope="session")
def trades(raw):
    from tickloom.operators import parse_trades

    return lambda *texts: parse_trades(raw(*texts))
