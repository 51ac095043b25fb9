"""Keyed stores behind a Spark connector (S07 S08 with ``format=...``).

For stores whose connector writes ``mode("append")`` as an upsert by primary
key (wide-column stores do), the flows can read history from and write
predictions to the store directly instead of the keyed parquet table. The
connector jar must be on the cluster; none is available in this repository's
tests, so only the generic path is exercised (with ``parquet``).

A lookup is a semi join of the store with the batch's keys; connectors that
support join pushdown turn it into key reads instead of a full scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TableSpec


def read_store(spark: SparkSession, fmt: str, options: Mapping[str, str],
               spec: TableSpec | None = None) -> DataFrame:
    """Batch read of a store table; with ``spec`` the columns are put in the
    table's order and types (stores may return columns alphabetically)."""
    df = spark.read.format(fmt).options(**dict(options)).load()
    return spec.conform(df) if spec is not None else df


def lookup_store(spark: SparkSession, fmt: str, options: Mapping[str, str], spec: TableSpec,
                 keys: DataFrame) -> DataFrame:
    """Stored rows for the given keys only."""
    k = keys.select(F.col(spec.key).cast(spec.schema[spec.key].dataType).alias(spec.key))
    return read_store(spark, fmt, options, spec).join(k, spec.key, "left_semi")


class StoreHistory:
    """A connector-backed store used as stored history, read by the batch's keys."""

    def __init__(self, fmt: str, options: Mapping[str, str], spec: TableSpec):
        self.fmt, self.options, self.spec = fmt, dict(options), spec

    def lookup(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        return lookup_store(spark, self.fmt, self.options, self.spec, keys)


def append_store(df: DataFrame, fmt: str, options: Mapping[str, str], spec: TableSpec) -> None:
    """Write rows conformed to ``spec`` with ``mode("append")`` (an upsert for
    primary-key stores)."""
    spec.conform(df).write.format(fmt).options(**dict(options)).mode("append").save()


def store_writer(fmt: str, options: Mapping[str, str], spec: TableSpec):
    """A per-batch writer for ``flows.MergeScore(writer=...)``."""
    def write(df: DataFrame, epoch: int) -> None:
        append_store(df, fmt, options, spec)
    return write
