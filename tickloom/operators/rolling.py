"""Rolling extremes of a stream, in custom state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.windows import DAY_S
from tickloom.workers import importable

SECOND_MS = 1000


class RollingExtremes(StatefulProcessor):
    """High and low over the ``span`` seconds that end with each bar, per symbol.

    State is a monotone queue of each: (time, value) in order of time, where every bar has removed the
    earlier ones that it outdoes. The head is the extreme, and a queue has at most one bar for each that
    fits the span. A timer clears the state of a symbol that has had no bar for a whole span.
    """

    def __init__(self, span: int = DAY_S, width: int = 60):
        self.reach = span - width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.highs = handle.getListState("highs", "at bigint, value double")
        self.lows = handle.getListState("lows", "at bigint, value double")
        self.due = handle.getValueState("due", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Closed bars of one batch come in any order, but none is older than those of the batch before.
        bars = pd.concat(list(rows)).sort_values("window_start")
        at = bars["window_start"].astype("datetime64[us]").astype("int64") // 1_000_000
        found = {}
        for name, queue, column, sign in (("high", self.highs, "high_usd", 1), ("low", self.lows, "low_usd", -1)):
            held = [(int(time), float(value)) for time, value in queue.get()]
            best, begin = [], 0
            for now, value in zip(at, bars[column]):
                if not pd.isna(value):
                    while len(held) > begin and sign * held[-1][1] <= sign * value:
                        held.pop()
                    held.append((int(now), float(value)))
                while len(held) > begin and held[begin][0] < now - self.reach:
                    begin += 1
                best.append(held[begin][1] if len(held) > begin else None)
            queue.put(held[begin:]) if held[begin:] else queue.clear()
            found[name] = best
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
        due = (int(at.iloc[-1]) + self.reach + 1) * SECOND_MS
        self.handle.registerTimer(due)
        self.due.update((due,))
        yield pd.DataFrame({
            "symbol": key[0], "window_start": bars["window_start"].to_numpy(),
            "high_24h_usd": found["high"], "low_24h_usd": found["low"]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.highs.clear()
        self.lows.clear()
        self.due.clear()
        return iter([])

    def close(self) -> None:
        pass


def high_low_24h_stream(bars: DataFrame, span: int = DAY_S, width: int = 60) -> DataFrame:
    """Extension: as ``high_low_24h``, over a stream of closed bars in append mode; needs a RocksDB state store.

    A symbol's bars of a batch are a row a minute, so a key's work is bounded by the time a batch covers.
    """
    importable(bars.sparkSession)
    return (
        bars.select("symbol", "window_start", "high_usd", "low_usd")
        .groupBy("symbol")
        .transformWithStateInPandas(
            RollingExtremes(span, width),
            "symbol string, window_start timestamp, high_24h_usd double, low_24h_usd double",
            "Append", "EventTime")
    )
