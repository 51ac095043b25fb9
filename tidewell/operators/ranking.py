"""Distributed dense numbering of a globally sorted frame.

``row_number() over (order by ...)`` without a partition moves every row into
one task. Here the frame is range-partitioned and sorted by Spark, each row
gets its position inside its partition, partition sizes (one row per partition,
a proven size bound) give the starting offsets, and a broadcast join of that
tiny table adds them. The sorted frame is checkpointed once so both passes see
the same partitioning, which also cuts the lineage for executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def global_row_number(df: DataFrame, order_by: Sequence[Column], out: str = "index",
                      base: int = 0) -> DataFrame:
    """Append ``out`` = position of each row in ``order_by`` order, from ``base``."""
    ensure_checkpoint_dir(df.sparkSession)
    staged = (df.orderBy(*order_by)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    sizes = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                        F.min("__mid").alias("__first"))
    # one row per partition: this window is bounded by the partition count
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    numbered = staged.join(F.broadcast(offsets.select("__pid", "__first", "__start")), "__pid")
    return numbered.withColumn(
        out, (F.col("__start") + F.col("__mid") - F.col("__first") + F.lit(base)).cast("long")
    ).drop("__pid", "__mid", "__first", "__start")
