"""Fixed values, spelled out: the SQL of the registered queries takes them from the package."""

from tickloom.plans.inputs import AS_OF, CUTS
from tickloom.schema import METADATA_ROWS, REFERENCE_ROWS, TRACKED_SYMBOLS
from tickloom.sources.events import EPOCH_MS, EVENT_SYMBOLS, OTHER_BASE, OTHER_SYMBOL, TICKER_EVERY, TIME_SQUEEZE


def test_reference_rows():
    assert [tuple(row) for row in REFERENCE_ROWS] == [
        ("BTCUSDT", "BTC", "USDT", 1, "Layer-1"),
        ("ETHUSDT", "ETH", "USDT", 2, "Layer-1"),
        ("BNBUSDT", "BNB", "USDT", 4, "Exchange-token"),
        ("SOLUSDT", "SOL", "USDT", 5, "Layer-1"),
        ("XRPUSDT", "XRP", "USDT", 6, "Payment"),
    ]


def test_metadata_rows():
    assert [tuple(row)[:3] for row in METADATA_ROWS] == [
        ("BTC", "Layer1", "Large Cap"), ("ETH", "Layer1", "Large Cap"),
        ("BNB", "Exchange Token", "Large Cap"), ("SOL", "Layer1", "Large Cap"),
        ("XRP", "Payments", "Large Cap"), ("ADA", "Layer1", "Mid Cap"),
        ("AVAX", "Layer1", "Large Cap"), ("DOGE", "Meme", "Mid Cap"),
        ("DOT", "Layer0", "Mid Cap"), ("MATIC", "Layer2", "Mid Cap"),
        ("LINK", "Oracle", "Mid Cap"), ("UNI", "DeFi", "Mid Cap"),
        ("LTC", "Layer1", "Mid Cap"), ("ATOM", "Layer0", "Mid Cap"),
        ("XLM", "Payments", "Mid Cap"), ("SHIB", "Meme", "Mid Cap"),
        ("NEAR", "Layer1", "Mid Cap"), ("ALGO", "Layer1", "Small Cap"),
        ("FTM", "Layer1", "Small Cap"), ("AAVE", "DeFi", "Mid Cap"),
    ]
    assert all(row[3] for row in METADATA_ROWS)


def test_derived_trades():
    assert [tuple(row) for row in EVENT_SYMBOLS] == [
        ("click", "BTCUSDT", 78000), ("view", "ETHUSDT", 3000), ("purchase", "BNBUSDT", 650),
        ("signup", "SOLUSDT", 150),
    ]
    assert (OTHER_SYMBOL, OTHER_BASE, TICKER_EVERY, TIME_SQUEEZE) == ("FOOUSDT", 2, 50, 360)
    assert (EPOCH_MS, AS_OF, CUTS) == (1704067200000, "2024-01-01 02:00:00", (2417, 4843))
    assert TRACKED_SYMBOLS == "BTCUSDT,ETHUSDT,BNBUSDT,SOLUSDT,XRPUSDT"
