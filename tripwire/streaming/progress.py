"""Stream progress as a lasting table, for starvation and late-row reports.

A listener appends a record per micro-batch to files of JSON lines in the shared folder; the Spark operators in
`tripwire.operators.analytics` (e.g. `starvation_episodes`) read them.
"""
from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tripwire.config import PROGRESS_SCHEMA, STARVATION_SECONDS
from tripwire.streaming.folders import Folder


def _dropped(progress) -> int:
    ops = getattr(progress, "stateOperators", None) or []
    return int(sum(getattr(op, "numRowsDroppedByWatermark", 0) or 0 for op in ops))


class ProgressLog(StreamingQueryListener):
    """Appends the progress of the session's queries to a folder that outlives them and the driver.

    At most `held` records wait in memory; they are written when so many have come, when a query
    ends, and by `flush`. A record: query, batch, at (the trigger's time), num_input_rows,
    rows_dropped (late rows, as the state operators count them), watermark. A replay gives its own clock for `at`: a
    function of (query name, batch id) to an ISO time. `names` limits the log to some queries."""

    def __init__(self, spark: SparkSession, path: str, held: int = 100,
                 clock: Callable[[str, int], str] | None = None, names: Iterable[str] | None = None):
        self.path, self._folder, self._held, self._clock = path, Folder(spark, path), held, clock
        self._names = None if names is None else set(names)
        self._lock = threading.Lock()
        self._records: list[str] = []
        self._ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        if self._names is not None and name not in self._names:
            return
        at = self._clock(name, p.batchId) if self._clock else p.timestamp
        record = {"query": name, "batch": p.batchId, "at": at, "num_input_rows": int(p.numInputRows),
                  "rows_dropped": _dropped(p), "watermark": dict(p.eventTime or {}).get("watermark")}
        with self._lock:
            self._records.append(json.dumps(record))
            full = len(self._records) >= self._held
        if full:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()
        with self._lock:
            self._ended.add(str(event.runId))

    def flush(self) -> None:
        with self._lock:
            records, self._records = self._records, []
        if records:
            self._folder.put(f"{uuid.uuid4().hex}.json", ("\n".join(records) + "\n").encode())

    def wait(self, queries: Iterable[StreamingQuery], seconds: float = 60) -> None:
        """Until the ends of these queries have been noted: Spark reports events some time after they happen."""
        runs, until = {str(q.runId) for q in queries}, time.monotonic() + seconds
        while not runs <= self._ended:
            if time.monotonic() > until:
                raise TimeoutError("the ends of the queries were not reported")
            time.sleep(0.02)
        with self._lock:
            self._ended -= runs

    def frame(self, spark: SparkSession) -> DataFrame:
        """Every record so far; one per query and batch, also if a batch was reported again."""
        self.flush()
        return read_progress(spark, self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A progress log as a table. A batch that was reported again (a repeated trigger, a second
    listener) counts once, with its largest numbers."""
    if not Folder(spark, path).names():
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return (spark.read.schema(PROGRESS_SCHEMA).json(path).groupBy("query", "batch")
            .agg(F.min("at").alias("at"), F.max("num_input_rows").alias("num_input_rows"),
                 F.max("rows_dropped").alias("rows_dropped"), F.max("watermark").alias("watermark")))


def record_progress(spark: SparkSession, path: str, **options) -> ProgressLog:
    log = ProgressLog(spark, path, **options)
    spark.streams.addListener(log)
    return log


class StarvationWarning(StreamingQueryListener):
    """Warns once per episode in which a running query got no input for `limit` seconds.
    Spark reports progress and idleness by itself, so nothing polls; what is kept is one
    time per running query."""

    def __init__(self, limit: float = STARVATION_SECONDS, warn=None, now=time.monotonic):
        self.limit, self.warn, self.now = limit, warn or logging.getLogger("tripwire").warning, now
        self._fed: dict[str, float] = {}
        self._warned: set[str] = set()

    def _fresh(self, run: str) -> None:
        self._fed[run] = self.now()
        self._warned.discard(run)

    def _look(self, run: str) -> None:
        starved = self.now() - self._fed.setdefault(run, self.now())
        if starved >= self.limit and run not in self._warned:
            self._warned.add(run)
            self.warn(f"streaming query {run}: no input for {starved:.0f} s")

    def onQueryStarted(self, event):
        self._fresh(str(event.runId))

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        if event.progress.numInputRows > 0:
            self._fresh(run)
        else:
            self._look(run)

    def onQueryIdle(self, event):
        self._look(str(event.runId))

    def onQueryTerminated(self, event):
        self._fed.pop(str(event.runId), None)
        self._warned.discard(str(event.runId))


def late_rows(query) -> int:
    """Rows a query dropped as too late (sum over its recent progress)."""
    return sum(_dropped_dict(p) for p in query.recentProgress)


def _dropped_dict(p: dict) -> int:
    return int(sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", [])))


def windows_in_state(spark: SparkSession, checkpoint: str) -> int:
    """Groups (window and user) that a window query holds in its state after its newest batch, read with
    Spark's state reader from the checkpoint."""
    return spark.read.format("statestore").load(checkpoint).count()
