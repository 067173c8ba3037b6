"""What running queries report."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Adds up the rows dropped by the watermark over every report of every query.

    A query itself remembers its last hundred reports only. ``say`` is called with each number above
    zero as it comes, so that a job that never ends reports them too. Spark counts rows after each task
    has summed up its own, so several late trips of a window and zone may be one row.
    """

    def __init__(self, say: Callable[[str], None] | None = None):
        self.say = say
        self.dropped: Counter[str] = Counter()
        self._ended: defaultdict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.dropped[str(progress.runId)] += late
        if late and self.say:
            self.say(f"late rows dropped in batch {progress.batchId}: {late}")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def total(self, query: StreamingQuery, seconds: float = 60) -> int:
        """All late rows of a query that has ended; reports come in their order, the end last."""
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the end of the query was not reported")
        return self.dropped[str(query.runId)]


@contextmanager
def late_rows(spark: SparkSession, say: Callable[[str], None] | None = None) -> Iterator[LateRows]:
    """Count late rows of the queries started inside."""
    listener = LateRows(say)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
