"""Per-key reduction of a micro-batch and its merge with stored history
(A01 A02 A03 J01 J02 U01 P08).

Plan shape at scale (history large, batch small):

* ``reduce_max`` is a two-phase hash aggregate: map-side partial max per key,
  so a key holding a third of all rows still ships one row per map task.
* ``lookup`` is a left-semi join of history against the batch's distinct keys.
  No hint: adaptive execution broadcasts the keys when their measured bytes are
  within the session's threshold and splits skewed history keys otherwise.
* ``merge_max`` reads the batch once: the reduced batch is left-joined with the
  history and the rows of a key are folded where the join put them, so there is
  one shuffle per side and none after the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _q(c: str):
    return F.col(f"`{c}`")


def absent_columns(df: DataFrame, columns: Sequence[str], value=0.0,
                   dtype: T.DataType = T.DoubleType()) -> DataFrame:
    """Add constant columns for features this side does not carry.

    ``value=None`` adds typed nulls (null-safe merge: ``max`` ignores them).
    """
    lit = F.lit(value).cast(dtype) if value is not None else F.lit(None).cast(dtype)
    return df.withColumns({c: lit for c in columns})


def reduce_max(df: DataFrame, key: str, columns: Sequence[str],
               absent: Sequence[str] = (), absent_value=0.0,
               absent_type: T.DataType = T.DoubleType()) -> DataFrame:
    """One row per key: max of each column (nulls ignored, NaN greatest) (A01),
    plus constant columns for ``absent`` features (A02)."""
    out = df.groupBy(key).agg(*[F.max(_q(c)).alias(c) for c in columns])
    if absent:
        out = absent_columns(out, absent, absent_value, absent_type)
    return out


def keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a frame."""
    return df.select(key).distinct()


def lookup(history: DataFrame, batch_keys: DataFrame, key: str) -> DataFrame:
    """History rows whose key occurs in ``batch_keys`` (J01, replaces the
    collected ``key = a or key = b ...`` filter). Null keys never match."""
    return history.join(batch_keys.select(key), on=key, how="left_semi")


def _resolve_types(batch: DataFrame, history: DataFrame, columns: Sequence[str],
                   batch_cols: Sequence[str], history_cols: Sequence[str]) -> dict[str, T.DataType]:
    out = {}
    for c in columns:
        tb = batch.schema[c].dataType if c in batch_cols else None
        th = history.schema[c].dataType if c in history_cols else None
        if tb is not None and th is not None and tb != th:
            out[c] = T.DoubleType()
        else:
            out[c] = tb or th
    return out


def merge_max(batch: DataFrame, history: DataFrame, key: str,
              batch_columns: Sequence[str], history_columns: Sequence[str],
              absent=0.0, reduced: DataFrame | None = None) -> DataFrame:
    """Merge a micro-batch with stored history per key.

    Output: one row per distinct batch key with every column of
    ``batch_columns`` + ``history_columns``; each is the max over the batch rows
    and the stored rows of that key. A null key finds no history.

    ``absent=0.0`` is the parity mode: features a side lacks count as 0.0 and
    null/NaN stored values are filled with 0.0 before the max, so a negative
    stored value reads as 0.0. ``absent=None`` is the null-safe mode: lacking
    and null values are ignored, a negative stored value survives.

    ``reduced`` may pass an already computed (and persisted) ``reduce_max`` of
    the batch.
    """
    batch_columns = list(batch_columns)
    history_columns = list(history_columns)
    columns = batch_columns + [c for c in history_columns if c not in batch_columns]
    types = _resolve_types(batch, history, columns, batch_columns, history_columns)
    if reduced is None:
        reduced = reduce_max(batch, key, batch_columns)

    def nothing(c):
        return (F.lit(absent) if absent is not None else F.lit(None)).cast(types[c])

    def stored(c):
        if c not in history_columns:
            return nothing(c)
        col = _q(c).cast(types[c])
        if absent is not None:
            if isinstance(types[c], (T.FloatType, T.DoubleType)):
                col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
            col = F.coalesce(col, nothing(c))
        return col

    found = history.select(_q(key), *[stored(c).alias(f"__h_{c}") for c in columns])
    joined = reduced.join(found, on=key, how="left")
    return joined.groupBy(key).agg(*[
        F.greatest(F.max(_q(c).cast(types[c]) if c in batch_columns else nothing(c)),
                   F.max(_q(f"__h_{c}"))).alias(c) for c in columns])
