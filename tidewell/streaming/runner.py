"""Micro-batch runner.

``run_batches`` wires a streaming frame to a per-batch function with a
checkpoint; the function receives a bounded DataFrame and the epoch id.
Exactly-once output comes from the sink: writers key their output by
(run, epoch) and overwrite it, so a replayed epoch rewrites the same rows.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..sources.folders import qualified


def trigger_args(trigger) -> dict:
    """``"available_now"`` | ``"once"`` | ``"30 seconds"`` | dict -> ``trigger(**kw)``."""
    if trigger is None or trigger == "available_now":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    if isinstance(trigger, dict):
        return trigger
    if isinstance(trigger, (int, float)):
        return {"processingTime": f"{trigger} seconds"}
    return {"processingTime": str(trigger)}


def current_run_id(spark: SparkSession) -> str:
    """Id of the streaming query running the current batch function.

    Stable across restarts from one checkpoint, new for a new checkpoint. Fails
    outside a batch function: two writers must never share an id.
    """
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("no streaming query is running this code")
    return run


def run_batches(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                trigger="available_now", name: str | None = None) -> StreamingQuery:
    """Start ``fn(batch_df, epoch_id)`` for each micro-batch of ``stream``."""
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint) \
        .trigger(**trigger_args(trigger))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def await_done(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for a finite (available-now) query, without limit unless one is given;
    re-raise its failure."""
    finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.id} did not finish within {timeout}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream {query.id} failed: {exc}")
    return query


def await_all(queries: Iterable[StreamingQuery]) -> list[StreamingQuery]:
    """Wait for finite queries that run side by side; the first failure stops the others."""
    queries = list(queries)
    try:
        return [await_done(q) for q in queries]
    finally:
        stop_queries(queries)


@contextmanager
def batch_scope(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a micro-batch that several actions read; always unpersist."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_MANAGERS = tuple(f"org.apache.spark.sql.execution.streaming.{p}FileSystemBasedCheckpointFileManager"
                  for p in ("checkpointing.", ""))   # Spark 4.1 and before
_MANAGER_LOCK = threading.Lock()
_manager_users: dict[SparkSession, int] = {}


@contextmanager
def light_checkpoints(spark: SparkSession, checkpoint: str):
    """For streams of many small triggers: while it is open, checkpoint files on a local
    disk are renamed by Hadoop's FileSystem. Spark's choice, its FileContext, starts a
    process (chmod, readlink) several times a file where Hadoop has no native library.
    Both write aside and rename; other stores keep Spark's choice, as does a session that
    names a manager."""
    with _MANAGER_LOCK:
        n = _manager_users.get(spark, 0)
        name = _local_manager(spark, checkpoint) if n or spark.conf.get(_MANAGER, None) is None else None
        if name:
            _manager_users[spark] = n + 1
            spark.conf.set(_MANAGER, name)
    try:
        yield
    finally:
        if name:
            with _MANAGER_LOCK:
                _manager_users[spark] -= 1
                if not _manager_users[spark]:
                    del _manager_users[spark]
                    spark.conf.unset(_MANAGER)


def _local_manager(spark: SparkSession, checkpoint: str) -> str | None:
    if not qualified(spark, checkpoint).startswith("file:"):
        return None
    for name in _MANAGERS:
        try:
            spark.sparkContext._jvm.java.lang.Class.forName(name)
            return name
        except Py4JJavaError:   # not of this version of Spark
            pass
    return None


def stop_queries(queries: Iterable[StreamingQuery]) -> int:
    """Stop the given queries that are still active (T08); returns how many were.
    Other queries of the session go on."""
    n = 0
    for q in queries:
        if q.isActive:
            q.stop()
            n += 1
    return n
