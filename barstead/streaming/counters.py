"""Counters of a stream, observed in the pass that writes each batch and collected by a listener.

A batch that comes again after a failure replaces its counters. The listener lives in the driver and holds one row of
counters per batch since it was added; what must outlive the driver is written by the batch itself (see
``archives.taken_archives`` and the entries of a kept store).
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

NAME = "counters"


class StreamCounters(StreamingQueryListener):
    """Counters of the observed streams of a session, per run and batch."""

    def __init__(self) -> None:
        self._batches: dict[str, dict[int, Row]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(NAME)
        if seen is not None and event.progress.numInputRows:
            with self._lock:
                self._batches.setdefault(str(event.progress.runId), {})[event.progress.batchId] = seen

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, timeout: float = 60) -> dict[int, dict]:
        """Counters per batch of a run that has ended; events come in order, so none is missing once its end was told."""
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError("the listener wasn't told of the query's end")
        with self._lock:
            return {n: seen.asDict() for n, seen in sorted(self._batches.get(str(query.runId), {}).items())}


def observed(stream: DataFrame, **counters: Column) -> DataFrame:
    """The stream with counters, which are taken where this stands in its plan: put it last."""
    return stream.observe(NAME, *(c.alias(n) for n, c in counters.items()))


def run_counted(stream: DataFrame, write: Callable[[DataStreamWriter], DataStreamWriter], **counters: Column) -> dict[int, dict]:
    """Run a stream until all that has landed is taken; ``write`` sets sink and progress. Gives the counters per batch of this run."""
    listener = StreamCounters()
    streams = stream.sparkSession.streams
    streams.addListener(listener)
    try:
        query = write(observed(stream, **counters).writeStream).trigger(availableNow=True).start()
        query.awaitTermination()
        return listener.of(query)
    finally:
        streams.removeListener(listener)
