"""Exact quantiles by range counts, and the fill stage built on them.

Values are counted (partial counts per task, so a value with a third of all rows is one row a
task), the distinct ones range-sorted, and each partition's rows added up; those sums, a row
per partition and column, tell in which partition the wanted rank lies. Only there are
values counted off one by one. Nothing is approximated and no value list meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5) -> DataFrame:
    """``column, value``: the smallest value that at least a share ``q`` of the column's values
    does not exceed (SQL's ``quantile_disc``). Nulls, NaN and text that is no number do not count; a column without
    values has no row."""
    if not 0 <= q <= 1:
        raise ValueError(f"a quantile lies between 0 and 1, got {q}")
    ensure_checkpoint_dir(df.sparkSession)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").try_cast("double").alias("value")) for c in columns])
    counts = df.select(F.explode(cells).alias("c")).select("c.column", "c.value") \
        .where(F.col("value").isNotNull() & ~F.isnan("value")) \
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    placed = counts.orderBy("column", "value").withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    # a row per partition and column
    sums = placed.groupBy("column", "part").agg(F.sum("n").alias("held"))
    ahead = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("column")
    wanted = F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.sum("held").over(everything)))
    hit = sums.withColumn("ahead", F.coalesce(F.sum("held").over(ahead), F.lit(0))).withColumn("wanted", wanted) \
        .where("ahead < wanted and wanted <= ahead + held").select("column", "part", (F.col("wanted") - F.col("ahead")).alias("left"))
    upto = Window.partitionBy("column").orderBy("value")
    return placed.join(F.broadcast(hit), ["column", "part"]).withColumn("upto", F.sum("n").over(upto)) \
        .where(F.col("upto") >= F.col("left")).groupBy("column").agg(F.min("value").alias("value"))


class QuantileFillModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls, NaN and text that is no number with the columns' fitted values."""

    values = Param(Params._dummy(), "values", "a value per input column", typeConverter=TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.values))
        return dataset.withColumns({out: F.coalesce(F.nanvl(F.col(f"`{c}`").try_cast("double"), F.lit(None).cast("double")),
                                                    F.lit(v)) for c, out, v in fills})


class QuantileFill(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact ``q`` quantile (the median by default) of every input column as its fill value."""

    q = Param(Params._dummy(), "q", "share of the values not above the fill value", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, q: float = 0.5) -> None:
        super().__init__()
        self._set(**self._input_kwargs)
        self._set(q=q)

    def _fit(self, dataset: DataFrame) -> QuantileFillModel:
        columns = self.getInputCols()
        # a row per column
        found = {r["column"]: r["value"] for r in exact_quantiles(dataset, columns, self.getOrDefault(self.q)).collect()}
        if missing := [c for c in columns if c not in found]:
            raise ValueError(f"no value to fill {missing} with")
        return self._copyValues(QuantileFillModel())._set(values=[found[c] for c in columns])
