"""Message log source and sink.

``format="kafka"`` passes through to Spark's Kafka connector (needs the
spark-sql-kafka package on the cluster; not exercised in this repo's tests):
offsets, start positions and records per trigger are the connector's.
``format="files"`` carries the same messages through Spark's own parquet stream
sink and file stream source. The sink's commit log makes the relay exactly-once;
files have no offsets, so ``offset`` is null there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import envelope
from ..streaming.runner import trigger_args
from .folders import ensure

MESSAGE_SCHEMA = T.StructType([f for f in envelope.ENVELOPE_SCHEMA.fields if f.name != "offset"])


def publish(stream: DataFrame, target: str, checkpoint: str, columns: Sequence[str] | None = None,
            fmt: str = "json", key: str | None = None, trigger="available_now",
            format: str = "files", options: Mapping[str, str] | None = None,
            name: str | None = None) -> StreamingQuery:
    """Encode each row of ``stream`` and publish it to the log."""
    w = envelope.encode(stream, columns, fmt=fmt, key=key).writeStream \
        .option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)).options(**dict(options or {}))
    if name:
        w = w.queryName(name)
    if format == "kafka":
        return w.format("kafka").option("topic", target).start()
    if format == "files":
        return w.format("parquet").option("path", target).start()
    raise ValueError(f"unknown log format {format!r}")


def subscribe(spark: SparkSession, source: str, format: str = "files",
              max_per_trigger: int | None = None, starting: str = "earliest",
              options: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming read of the log as ``key string, value string, offset long``.

    ``max_per_trigger`` caps records per batch for Kafka and files per batch for
    files; ``starting`` (Kafka only) is the connector's start position.
    """
    if format == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", source) \
            .option("startingOffsets", starting)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        raw = r.options(**dict(options or {})).load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                          F.col("offset").cast("long"))
    if format != "files":
        raise ValueError(f"unknown log format {format!r}")
    if starting != "earliest":
        raise ValueError("files are read from the earliest on")
    ensure(spark, source)  # the reader may start before the relay's first message
    r = spark.readStream.schema(MESSAGE_SCHEMA).format("parquet")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_per_trigger))
    return r.options(**dict(options or {})).load(source) \
        .select("key", "value", F.lit(None).cast("long").alias("offset"))
