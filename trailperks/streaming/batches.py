"""Micro-batches named by the query that runs them, and what was counted while they ran."""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# How long the events of an ended query may take to arrive.
EVENTS_S = 60

Counts = dict[str, dict[str, int]]


class BatchCounts(StreamingQueryListener):
    """Hands the metrics that a query observed in each batch to the function given for that query.

    They come from the execution of the batch itself, so no message is read for them, and arrive after
    the batch was committed: a crash in between loses the counts of one batch, never the batch.
    """

    def __init__(self) -> None:
        self.followed: dict[str, tuple[StreamingQuery, Callable[[str, Counts], None]]] = {}
        self.ended: dict[str, threading.Event] = {}
        self.problems: list[Exception] = []

    def follow(self, query: StreamingQuery, tell: Callable[[str, Counts], None]) -> None:
        self.followed[query.id], self.ended[query.id] = (query, tell), threading.Event()

    def settle(self) -> None:
        """Wait for the events of the queries that have ended."""
        for name, (query, _) in list(self.followed.items()):
            if not query.isActive:
                if not self.ended[name].wait(EVENTS_S):
                    raise TimeoutError(f"the counts of query {name} have not arrived")
                del self.followed[name]
        if self.problems:
            raise RuntimeError("counts were not stored") from self.problems.pop()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        if found and str(progress.id) in self.followed:
            try:
                self.followed[str(progress.id)][1](f"{progress.id}-{progress.batchId}", found)
            except Exception as problem:  # Spark only logs what a listener raises
                self.problems.append(problem)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.ended:
            self.ended[str(event.id)].set()


_listeners: dict[str, BatchCounts] = {}


def batch_counts(spark: SparkSession) -> BatchCounts:
    """The listener of this application."""
    application = spark.sparkContext.applicationId
    if application not in _listeners:
        _listeners[application] = BatchCounts()
        spark.streams.addListener(_listeners[application])
    return _listeners[application]


def start_batches(
    messages: DataFrame, checkpoint: str, work: Callable[[DataFrame, str], None],
    interval: str | None = None, drain: bool = False,
    tell: Callable[[str, Counts], None] | None = None,
) -> StreamingQuery:
    """Call ``work(batch, name)`` for each micro-batch; without an interval, until the stream is read.

    Batch numbers start at zero with every new checkpoint, so the name holds the id that Spark stores in
    the checkpoint: a batch that runs again has the same name, one of another checkpoint never has.
    ``drain`` runs batch after batch and stops when nothing is left, for sources that limit a batch
    themselves. ``tell(name, counts)`` gets what the stream observes.
    """
    started, named = threading.Event(), {}

    def run(batch: DataFrame, number: int) -> None:
        started.wait()
        work(batch, f"{named['query']}-{number}")

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if interval or drain:
        writer = writer.trigger(processingTime=interval or "0 seconds")
    else:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    named["query"] = query.id
    if tell:
        batch_counts(messages.sparkSession).follow(query, tell)
    started.set()
    if drain and not interval:
        threading.Thread(target=_drain, args=(query,), daemon=True).start()
    return query


def _drain(query: StreamingQuery) -> None:
    with suppress(StreamingQueryException):  # awaitTermination raises it
        query.processAllAvailable()
        query.stop()
