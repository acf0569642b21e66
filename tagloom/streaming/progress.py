"""Progress of running streams, kept for polling."""

from __future__ import annotations

from collections import deque

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """The latest events of all streams of a session; add with ``spark.streams.addListener``."""

    def __init__(self, most: int = 60):
        self.lines: deque[str] = deque(maxlen=most)
        self.rows = 0
        self.ended = 0

    def onQueryStarted(self, event) -> None:
        self.lines.append(f"started {event.name or event.id}")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += max(0, p.numInputRows)
        self.lines.append(f"batch {p.batchId} of {p.name or p.id}: {p.numInputRows} rows")

    def onQueryIdle(self, event) -> None:
        self.lines.append(f"idle {event.id}")

    def onQueryTerminated(self, event) -> None:
        self.ended += 1
        self.lines.append(f"ended {event.id}")

    def tail(self, n: int = 10) -> list[str]:
        return list(self.lines)[-n:]
