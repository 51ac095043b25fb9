"""Column expressions shared by operators. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def clamp_index(prediction: str | Column, n_labels: int) -> Column:
    """Prediction in index space -> valid 0-based index, or null.

    NaN and null give null (checked first: ``least``/``greatest`` would turn
    both into the last index). Otherwise clamp to [0, n-1] and truncate toward
    zero, as an index lookup of a truncated double would.
    """
    p = _c(prediction).cast("double")
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(float(n_labels - 1)), p))
    return F.when(p.isNull() | F.isnan(p), F.lit(None).cast("int")).otherwise(clamped.cast("int"))

