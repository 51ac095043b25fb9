"""Metrics and previews as DataFrames.

Metrics are single distributed aggregates (partial per task, one tiny final
merge); they return one-row DataFrames instead of pulling rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _num(c: str | Column) -> Column:
    return (F.col(f"`{c}`") if isinstance(c, str) else c).cast("double")


def squared_error(prediction: str | Column, label: str | Column) -> Column:
    return F.pow(_num(prediction) - _num(label), 2)


def rmse(df: DataFrame, prediction: str | Column = "prediction", label: str | Column = "label",
         digits: int | None = None) -> DataFrame:
    """Root mean squared error over rows where both sides are known.

    Unlike ``RegressionEvaluator`` a null prediction does not fail the job; the
    row is left out and counted in ``n_missing``.
    """
    err = squared_error(prediction, label)
    r = F.sqrt(F.avg(err))
    out = df.agg((F.round(r, digits) if digits is not None else r).alias("rmse"),
                 F.count(err).alias("n_scored"),
                 F.count_if(err.isNull()).alias("n_missing"))
    return out


def match_rate(df: DataFrame, prediction: str | Column, label: str | Column,
               digits: int | None = None) -> DataFrame:
    """Share of rows whose prediction equals the label exactly."""
    hit = F.avg(F.when(_num(prediction) == _num(label), 1.0).otherwise(0.0))
    return df.agg((F.round(hit, digits) if digits is not None else hit).alias("match_rate"),
                  F.count(F.lit(1)).alias("n_rows"))


def report(df: DataFrame, prediction: str | Column, label: str | Column,
           digits: int | None = None, name: str | None = None) -> DataFrame:
    """RMSE, exact-match share and row count in one pass."""
    err = squared_error(prediction, label)
    r = F.sqrt(F.avg(err))
    hit = F.avg(F.when(_num(prediction) == _num(label), 1.0).otherwise(0.0))
    rd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    cols = [rd(r).alias("rmse"), rd(hit).alias("match_rate"), F.count(err).alias("n_scored")]
    if name is not None:
        cols.insert(0, F.lit(name).alias("model"))
    return df.agg(*cols)


def split_by(df: DataFrame, holdout: Column) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/holdout split by a row condition (e.g. a time cutoff
    or a key-hash bucket): ``(rows where it is not true, rows where it is)``.
    Both halves are filters over the same scan; nothing is sampled."""
    cond = F.coalesce(holdout, F.lit(False))
    return df.where(~cond), df.where(cond)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows (L01). With ``order_by`` this is a deterministic top-k
    (planned as TakeOrderedAndProject: per-task top-k, then a final merge)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
