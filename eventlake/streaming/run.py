"""Waiting for queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery


class StreamFailure(RuntimeError):
    """A streaming query ended with an error; the message names every one that did."""


def run_all(queries: Iterable[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until all queries have ended; when one fails, stop the others and raise [STR5]."""
    queries = list(queries)
    waiting = list(queries)
    try:
        while waiting and not any(query.exception() for query in queries):
            try:
                waiting = [query for query in waiting if not query.awaitTermination(poll_seconds)]
            except StreamingQueryException:
                break
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    failures = [(query.name or query.id, query.exception()) for query in queries]
    failures = [(name, error) for name, error in failures if error is not None]
    if failures:
        raise StreamFailure("\n".join(f"{name}: {error}" for name, error in failures)) from failures[0][1]
