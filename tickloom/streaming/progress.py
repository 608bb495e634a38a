"""What running queries report: rows per batch, and what the watermark dropped."""

from __future__ import annotations

from dataclasses import dataclass
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class Batch:
    """One micro-batch. ``dropped`` counts rows as they reached the aggregate, after its partial step: several late
    trades of a bar can be one. ``observed`` has what ``observe`` counted, by its name and column."""

    query: str
    run_id: str
    batch_id: int
    rows: int
    dropped: int
    watermark: str | None
    observed: dict[str, int]


class Progress(StreamingQueryListener):
    """Keeps the batches of the queries that run while it listens; ``with Progress(spark) as seen:``."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark = spark
        self.batches: dict[tuple[str, int], Batch] = {}
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {
            f"{name}.{column}": value
            for name, row in (p.observedMetrics or {}).items() for column, value in row.asDict().items()}
        dropped = sum(operator.numRowsDroppedByWatermark for operator in p.stateOperators)
        self.batches[str(p.runId), p.batchId] = Batch(
            p.name, str(p.runId), p.batchId, p.numInputRows, dropped, (p.eventTime or {}).get("watermark"), observed)

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all that a finished query reported has arrived."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")

    def total(self, query: str, observed: str) -> int:
        """The sum of an observed count over a query's batches, whatever its restarts."""
        return sum(b.observed.get(observed, 0) for b in self.batches.values() if b.query == query)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per batch."""
        rows = [(b.query, b.run_id, b.batch_id, b.rows, b.dropped, b.watermark) for b in self.batches.values()]
        return spark.createDataFrame(
            rows, "query string, run_id string, batch_id long, rows long, dropped long, watermark string")
