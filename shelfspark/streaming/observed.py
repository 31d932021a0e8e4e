"""What streams count while they run, by a listener."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ObservedCounts(StreamingQueryListener):
    """Sums of the numbers that streams ``observe``, over all their batches."""

    def __init__(self) -> None:
        self.sums: dict[str, int] = defaultdict(int)
        self._open, self._changed = 0, threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        with self._changed:
            self._open += 1

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._changed:
            for row in event.progress.observedMetrics.values():
                for name, value in row.asDict().items():
                    self.sums[name] += value or 0

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._changed:
            self._open -= 1
            self._changed.notify_all()

    def wait(self, seconds: float = 60) -> None:
        """Until the events of all queries that have ended are here; they come a little later."""
        with self._changed:
            if not self._changed.wait_for(lambda: self._open == 0, seconds):
                raise TimeoutError("a streaming query is still running")


@contextmanager
def observed_counts(spark: SparkSession) -> Iterator[ObservedCounts]:
    """Counts of the queries that run inside, complete at the end."""
    counts = ObservedCounts()
    spark.streams.addListener(counts)
    try:
        yield counts
        counts.wait()
    finally:
        spark.streams.removeListener(counts)
