"""Preview sink for streams (S06): the first rows of each micro-batch.

``console`` prints them (like ``show``); ``table`` writes them, per (run, epoch),
under a path. Only ``num_rows`` rows per batch leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.evaluate import preview
from ..streaming.runner import current_run_id, run_batches


def stream_preview(stream: DataFrame, checkpoint: str, fmt: str = "console", num_rows: int = 20,
                   order_by: Sequence[str] | None = None, truncate: bool = True,
                   name: str | None = None, path: str | None = None,
                   trigger="available_now") -> StreamingQuery:
    if fmt not in ("console", "table"):
        raise ValueError(f"unknown preview format {fmt!r}")

    def show_batch(df: DataFrame, epoch: int) -> None:
        head = preview(df, num_rows, order_by)
        if fmt == "console":
            head.show(num_rows, truncate=truncate)
        else:
            head.write.mode("overwrite").parquet(f"{path}/run={current_run_id(df.sparkSession)}/epoch={epoch}")

    return run_batches(stream, show_batch, checkpoint, trigger, name)
