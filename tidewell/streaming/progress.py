"""Progress of live queries as rows (T01 T06): what each trigger took in."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = "query string, run string, batch long, n_rows long, trigger_ms long"


class ProgressRows(StreamingQueryListener):
    """Collects a row per trigger of the named queries; ``write`` appends them to a table and
    lets them go, so a long-lived query keeps few on the driver.

    Reports come one after the other, through a queue that drops what it cannot hold. So a
    report is taken as its JSON text, in two calls to the JVM (PySpark's event object takes
    some seventy), and ``wait_for`` looks for what was dropped."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names = set(names)
        self._rows: list[tuple] = []
        self._last: dict[str, int] = {}              # last batch reported, by run
        self._missing: dict[str, set[int]] = {}      # batches before it that were not
        self._reports = 0
        self._lock = threading.Lock()

    @property
    def _jlistener(self):
        if not hasattr(self, "_jlistenerobj"):
            from pyspark import SparkContext
            self._jlistenerobj = SparkContext._jvm.PythonStreamingQueryListenerWrapper(_Reports(self))
        return self._jlistenerobj

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.add(p.name, str(p.runId), p.batchId, p.numInputRows, p.durationMs)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def add(self, name: str | None, run: str, batch: int, n_rows: int, durations: Mapping[str, int]) -> None:
        """Takes a report in, that of a run's batch only once."""
        if name not in self.names:
            return
        with self._lock:
            self._reports += 1
            last, missing = self._last.get(run, batch - 1), self._missing.setdefault(run, set())
            if batch <= last and batch not in missing:
                return
            missing.update(range(last + 1, batch))
            missing.discard(batch)
            self._last[run] = max(last, batch)
            self._rows.append((name, run, batch, n_rows, int(durations.get("triggerExecution", 0))))

    def _through(self, run: str, last: int) -> bool:
        with self._lock:
            return self._last.get(run, -1) >= last and not self._missing.get(run)

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all of the query's batches up to its last one with rows have been reported, however
        long that takes while reports come in. Once none has for ``seconds``, or the last
        one is in, those missing are taken from the query's own record, which holds its
        latest ones; fails if a batch is in neither."""
        known, run = query.recentProgress, str(query.runId)
        last = max((p["batchId"] for p in known if p["numInputRows"]), default=-1)
        end, seen = time.monotonic() + seconds, self._reports
        while self._last.get(run, -1) < last and time.monotonic() < end:
            if self._reports != seen:
                end, seen = time.monotonic() + seconds, self._reports
            time.sleep(0.05)
        if self._through(run, last):
            return
        for p in known:
            self.add(p["name"], str(p["runId"]), p["batchId"], p["numInputRows"], p["durationMs"])
        if not self._through(run, last):
            raise TimeoutError(f"batches up to {last} of {query.name} were not all reported: no report within "
                               f"{seconds} s, missing {sorted(self._missing.get(run, ()))[:5]}")

    def write(self, spark: SparkSession, path: str) -> DataFrame:
        with self._lock:
            rows, self._rows = self._rows, []
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)
        return spark.read.parquet(path)


class _Reports:
    """The listener that the JVM calls, without PySpark's event objects."""

    def __init__(self, rows: ProgressRows) -> None:
        self.rows = rows

    def onQueryStarted(self, jevent) -> None:
        pass

    def onQueryProgress(self, jevent) -> None:
        p = json.loads(jevent.progress().json())
        self.rows.add(p.get("name"), p["runId"], p["batchId"], p["numInputRows"], p.get("durationMs", {}))

    def onQueryIdle(self, jevent) -> None:
        pass

    def onQueryTerminated(self, jevent) -> None:
        pass

    class Java:
        implements = ["org.apache.spark.sql.streaming.PythonStreamingQueryListener"]


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Stops live queries once all there is has passed through them, in the order given
    (each one's output is a later one's input): one that is through polls no longer."""
    for q in list(queries):
        q.processAllAvailable()
        q.stop()
