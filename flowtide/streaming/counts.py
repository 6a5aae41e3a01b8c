"""Counts of what a stream read, passed on and rejected, taken from the metrics its batches observe."""

from __future__ import annotations

import time
from collections import Counter

from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent


class FlowCounts(StreamingQueryListener):
    """Adds up the metrics observed under ``name`` (see :func:`counted_flows`), over all batches of all queries.

    Register it with ``spark.streams.addListener``. A batch repeated after a failure is counted again, as it is read again.
    """

    def __init__(self, name: str = "flows") -> None:
        self.name = name
        self.totals: Counter[str] = Counter()
        self.ended: set[str] = set()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        metrics = event.progress.observedMetrics.get(self.name)
        if metrics is not None:
            self.totals.update({k: v for k, v in metrics.asDict().items() if v is not None})

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.ended.add(str(event.id))

    def wait(self, query_id: str, seconds: float = 30) -> bool:
        """Whether the end of a query was reported in time; its counts are complete then."""
        end = time.monotonic() + seconds
        while str(query_id) not in self.ended and time.monotonic() < end:
            time.sleep(0.05)
        return str(query_id) in self.ended
