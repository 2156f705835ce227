"""What each micro-batch did, as numbers."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from operator import or_
from threading import Event, Lock

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from eventlake.functions.bands import CRITICAL

READ, SCORED = "read", "scored"
log = logging.getLogger(__name__)


def read_counts(features: list[str]) -> list[Column]:
    """Messages, and those that lack a feature, are no number there, or are no message at all."""
    lacking = reduce(or_, [F.col(f"`{name}`").isNull() | F.isnan(f"`{name}`") for name in features])
    return [F.count(F.lit(1)).alias("read"), F.count_if(lacking).alias("incomplete")]


def scored_counts() -> list[Column]:
    """Predictions, and those of the highest severity."""
    return [F.count(F.lit(1)).alias("scored"), F.count_if(F.col("severity") == CRITICAL).alias("critical")]


class BatchCounts(StreamingQueryListener):
    """Counts of every micro-batch, passed on once the batch is done [STR5].

    They are observed while the batch's own rows go by, so nothing is read a
    second time. ``report`` gets a dictionary with the query's name, the batch's
    number and its counts; by default it goes to the log. A batch that was
    written before the stream went down is not counted again.
    """

    def __init__(self, report: Callable[[dict], None] | None = None) -> None:
        self.report = report or (lambda counts: log.info("%s", counts))
        self._of_batch: dict[tuple[str, int], Observation] = {}
        self._lock = Lock()
        self._queries: dict[str, str] = {}
        self._ended = Event()

    def observe(self, rows: DataFrame, name: str, counts: list[Column]) -> DataFrame:
        """Streaming rows, counted as they pass."""
        return rows.observe(name, *counts)

    def add(self, query: str, batch_id: int, observation: Observation) -> None:
        """Counts of rows that a batch's own code makes; they are reported with the rest of the batch."""
        with self._lock:
            self._of_batch[query, batch_id] = observation

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._queries[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = {key: value for row in progress.observedMetrics.values() for key, value in row.asDict().items()}
        with self._lock:
            observation = self._of_batch.pop((progress.name, progress.batchId), None)
        if observation is not None:
            counts.update(observation.get)
        if counts:
            self.report({"query": progress.name, "batch_id": progress.batchId, **counts})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._queries.pop(str(event.runId), None)
        if not self._queries:
            self._ended.set()

    def wait(self, seconds: float = 30.0) -> bool:
        """Waits until all counts of queries that have ended are reported; they come a little after the end."""
        return self._ended.wait(seconds)
