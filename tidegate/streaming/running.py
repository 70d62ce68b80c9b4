"""Running streams: progress while they run, and when to stop."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Progress(StreamingQueryListener):
    """Counts what one query has done in this run, from its progress reports.

    Nothing is read for it: rows in, batches and observed metrics come with every batch.
    """

    def __init__(self, query_id: str, metrics: str | None = None):
        self.query_id, self.metrics = query_id, metrics
        self.rows = self.batches = 0
        self.counters: dict[str, int] = {}
        self.active_at = time.monotonic()
        self.ended = threading.Event()
        self.changed = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) != self.query_id:
            return
        seen = event.progress.numInputRows
        self.batches += 1
        if seen:
            self.rows += seen
            self.active_at = time.monotonic()
        found = event.progress.observedMetrics.get(self.metrics) if self.metrics else None
        if found is not None and seen:
            for name, value in found.asDict().items():
                self.counters[name] = self.counters.get(name, 0) + (value or 0)
        self.changed.set()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.ended.set()
            self.changed.set()


def run_until(query: StreamingQuery, rows: int | None = None, idle_seconds: float | None = None, metrics: str | None = None, poll_seconds: float = 0.2) -> Progress:
    """Wait until the query has taken ``rows`` rows or has had none for ``idle_seconds``, then stop it.

    Batches are taken whole, so a few more rows than asked for may have gone through. What is done is in the
    checkpoint: the next run goes on from there. A failure of the query is raised. With neither limit this waits for its end.
    """
    spark = SparkSession.getActiveSession()
    progress = Progress(str(query.id), metrics)
    spark.streams.addListener(progress)
    try:
        while query.isActive:
            progress.changed.wait(poll_seconds)
            progress.changed.clear()
            # Reports of batches that ended before the listener was there are kept by the query.
            if rows is not None and max(progress.rows, sum(p.numInputRows for p in query.recentProgress)) >= rows:
                break
            if idle_seconds is not None and time.monotonic() - progress.active_at >= idle_seconds:
                break
        _finish_batch(query)
        query.stop()
        if failure := query.exception():
            raise failure
        progress.ended.wait(10)
    finally:
        spark.streams.removeListener(progress)
    return progress


def _finish_batch(query: StreamingQuery, most_seconds: float = 10) -> None:
    """Let a batch that is under way end, if that is soon; a batch stopped in its midst is repeated by the next run."""
    until = time.monotonic() + most_seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.01)
