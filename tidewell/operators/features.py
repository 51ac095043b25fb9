"""Feature operators.

The index of a label or category is its rank by descending frequency, ties by
text ascending, 0-based. Two forms:

* ``frequency_index``: a DataFrame ``value, count, index`` computed on the
  cluster (partial count per task, distributed numbering). Used for the label
  rank and the inverse mapping, which are joins, so no label list has to fit on
  the driver.
* ``categorical``: Spark ML ``StringIndexer`` + ``OneHotEncoder`` stages for
  feature columns inside a saved pipeline (their label lists are per-column
  category sets).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clamp_index
from .ranking import global_row_number

EMPTY_MARKER = "__empty__"

#: An index of at most so many labels is broadcast to its joins, whose rows crowd on few labels.
BROADCAST_LABELS = 100_000


def _q(c: str):
    return F.col(f"`{c}`")


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """``value string, count long, index long`` for the non-null values of
    ``column`` (A05 W01). Values are compared as text (``cast(x as string)``)."""
    counts = (df.select(_q(column).cast("string").alias("value"))
                .where(F.col("value").isNotNull())
                .groupBy("value").agg(F.count(F.lit(1)).alias("count")))
    return global_row_number(counts, [F.col("count").desc(), F.col("value").asc()], "index")


def _joinable(index: DataFrame, n: int) -> DataFrame:
    return F.broadcast(index) if n <= BROADCAST_LABELS else index


def rank_label(df: DataFrame, column: str, index: DataFrame, out: str = "label",
               keep_unseen: bool = True, n_labels: int | None = None) -> DataFrame:
    """Numeric or text target -> its frequency rank as a double label.

    ``keep_unseen`` maps values missing from ``index`` (and nulls) to the extra
    rank ``n`` like ``handleInvalid="keep"``; otherwise they are dropped. An index of
    few labels is broadcast, so the labelled rows stay put; a larger one is a join
    whose hot labels adaptive execution splits.
    """
    n = n_labels if n_labels is not None else index.count()
    idx = index.select(F.col("value").alias("__value"), F.col("index").alias("__index"))
    joined = df.join(_joinable(idx, n), _q(column).cast("string") == F.col("__value"),
                     "left" if keep_unseen else "inner")
    lab = F.coalesce(F.col("__index"), F.lit(n)).cast("double")
    return joined.withColumn(out, lab).drop("__value", "__index")


def unrank(df: DataFrame, prediction: str, index: DataFrame, out: str,
           n_labels: int | None = None) -> DataFrame:
    """Prediction in rank space -> original label text.

    Guarded: NaN/null -> null; below 0 -> first label; beyond the last rank ->
    last label; otherwise the truncated rank. A join with the index table (no
    label list on the driver); one of few labels is broadcast, as predictions crowd on
    a rank and would all be read by its task.
    """
    n = n_labels if n_labels is not None else index.count()
    idx = index.select(F.col("index").cast("int").alias("__i"), F.col("value").alias(out))
    with_i = df.withColumn("__i", clamp_index(prediction, n))
    return with_i.join(_joinable(idx, n), "__i", "left").drop("__i")


def blank_categories(columns: Sequence[str], marker: str = EMPTY_MARKER,
                     suffix: str = "__cat") -> SQLTransformer:
    """Pipeline stage: ``''`` -> marker into ``{c}{suffix}``; null stays null
    (and lands in the indexer's extra bucket)."""
    sel = ", ".join(
        f"CASE WHEN `{c}` = '' THEN '{marker}' ELSE CAST(`{c}` AS STRING) END AS `{c}{suffix}`"
        for c in columns)
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


def categorical(columns: Sequence[str], handle_invalid: str = "keep",
                drop_last: bool = True) -> tuple[list, list[str]]:
    """Stages that turn text categories into one-hot vectors.

    One multi-column ``StringIndexer`` (one counting job for all columns) and one
    multi-column ``OneHotEncoder``. Returns ``(stages, vector_columns)``.
    """
    cats = [f"{c}__cat" for c in columns]
    idx = [f"{c}__idx" for c in columns]
    vec = [f"{c}__vec" for c in columns]
    stages = [
        blank_categories(columns),
        StringIndexer(inputCols=cats, outputCols=idx, handleInvalid=handle_invalid,
                      stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=idx, outputCols=vec, handleInvalid=handle_invalid,
                      dropLast=drop_last),
    ]
    return stages, vec


def constant_fill(values: Mapping[str, float]) -> SQLTransformer:
    """Pipeline stage: null/NaN -> constant, per column, same column name.

    Inside the pipeline so training and serving fill the same way."""
    repl = ", ".join(
        f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), CAST({float(v)!r} AS DOUBLE)) AS `{c}__filled`"
        for c, v in values.items())
    return SQLTransformer(statement=f"SELECT *, {repl} FROM __THIS__")


def impute(columns: Sequence[str], strategy: str = "mean", suffix: str = "__imp") -> tuple[Imputer, list[str]]:
    """Mean/median/mode imputation stage (M04). Returns ``(stage, output_columns)``.
    The surrogate values are one small aggregate, stored in the model."""
    outs = [f"{c}{suffix}" for c in columns]
    return Imputer(inputCols=list(columns), outputCols=outs, strategy=strategy), outs


def numeric_as_double(columns: Sequence[str], suffix: str = "__dbl") -> SQLTransformer:
    """Pipeline stage: ``{c}{suffix}`` = ``c`` as double (text that is not a number -> null)."""
    sel = ", ".join(f"TRY_CAST(`{c}` AS DOUBLE) AS `{c}{suffix}`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


def assemble(inputs: Sequence[str], output: str = "features",
             handle_invalid: str = "keep") -> VectorAssembler:
    """Numeric columns and vectors -> one feature vector (M03). ``keep`` writes
    missing values as NaN; regressors reject NaN, so impute before."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid)
