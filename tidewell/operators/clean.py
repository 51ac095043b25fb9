"""Typing and null handling.

All of these are narrow projections: no shuffle, one codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec



def cast_columns(df: DataFrame, casts: Mapping[str, str | T.DataType], safe: bool = True) -> DataFrame:
    """Cast columns in place, keeping column order.

    ``safe`` uses ``try_cast``: text that is not a number becomes null instead of
    failing the job (ANSI mode rejects ``CAST('NA' AS INT)``). One ``withColumns``
    keeps the analyzed plan flat however many columns are cast.
    """
    def conv(c: str, t):
        col = F.col(f"`{c}`")
        return col.try_cast(t) if safe else col.cast(t)
    return df.withColumns({c: conv(c, t) for c, t in casts.items()})


def fill(df: DataFrame, value=None, by_column: Mapping[str, object] | None = None,
         subset: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls (and NaN in float columns) with a scalar or a per-column value.

    ``fill(df, 0)`` fills every numeric column (P06); ``fill(df, by_column={...})``
    casts each value to its column's type (P07), like ``na.fill`` does.
    """
    if by_column:
        return df.na.fill(dict(by_column))
    if subset is not None:
        return df.na.fill(value, subset=list(subset))
    return df.na.fill(value)



def null_key(df: DataFrame, key: str, mode: str = "default", default=0) -> DataFrame:
    """Deal with a null primary key before a keyed write.

    ``default``: replace with ``default`` (cast to the key's type; every null key
    then lands on the same row of the table). ``drop``: remove such rows.
    ``quarantine``: keep only such rows (to write them aside).
    """
    k = F.col(f"`{key}`")
    if mode == "default":
        return df.withColumn(key, F.coalesce(k, F.lit(default).cast(df.schema[key].dataType)))
    if mode == "drop":
        return df.where(k.isNotNull())
    if mode == "quarantine":
        return df.where(k.isNull())
    raise ValueError(f"unknown null-key mode {mode!r}")


def conform(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Names (case-insensitive), order and types of a keyed table."""
    return spec.conform(df, strict=strict)



def select_exprs(df: DataFrame, exprs: Sequence[str | Column]) -> DataFrame:
    """Fixed-order projection from SQL text or columns."""
    cols = [F.expr(e) if isinstance(e, str) else e for e in exprs]
    return df.select(*cols)
