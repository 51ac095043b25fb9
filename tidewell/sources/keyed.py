"""Keyed table with replay-safe upserts.

Layout: ``{path}/seq={n}/run={run}/epoch={epoch}/bucket={b}/part-*.parquet``. Each
micro-batch of a streaming query is one slice. A replayed (run, epoch) overwrites its own
slice; a new one gets the next sequence number after all slices there are, so what
counts as latest follows the order of the writes and no clock. A number is claimed by
creating a file, which succeeds for one writer only, so writers at the same time never
share one; a process lists the slices once a table, not at every write. A restart from
the same checkpoint keeps the run id, a fresh checkpoint starts a new run.

A slice names the columns it sets (``_set``, a character per value column). The current
value of a column is that of the last slice that set it, so an append of some columns
leaves the others as they were. Reading is one aggregate of ``max_by`` per column,
partial in every task, so a key updated in every batch is no hot spot.

Within a slice rows lie in ``BUCKETS`` folders by a hash of their key. ``lookup`` joins
the slices with the buckets of the wanted keys (at most ``BUCKETS`` rows, broadcast),
which Spark turns into dynamic partition pruning: folders without a wanted key are not
read. What is read is semi-joined with the keys *before* the aggregation (Catalyst does
not push a semi join below it), so only matching rows are shuffled. A slice that its writer
knows to be small is one file in the folder of bucket ``WHOLE``, which every lookup reads.
"""

from __future__ import annotations

import re
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec
from .folders import claim, matching

SET_COL = "_set"
BUCKET_COL = "bucket"
BUCKETS = 16
WHOLE = -1

#: slices this process knows of, by table: last sequence number, and that of each (run, epoch)
_KNOWN: dict[str, tuple[int, dict[tuple[str, int], int]]] = {}
_KNOWN_LOCK = threading.Lock()


def _q(c: str):
    return F.col(f"`{c}`")


def dedupe(df: DataFrame, spec: TableSpec, rule: str = "max") -> DataFrame:
    """One row per key before a write. ``max``: per-column max (nulls ignored);
    ``none``: caller guarantees unique keys."""
    if rule == "none":
        return df
    if rule == "max":
        return df.groupBy(spec.key).agg(*[F.max(_q(c)).alias(c) for c in spec.value_columns]) \
                 .select(*spec.columns)
    raise ValueError(f"unknown dedupe rule {rule!r}")


def _slice_path(spark: SparkSession, path: str, run: str, epoch: int) -> str:
    """The slice of (run, epoch): its own if it was written before, else the next."""
    with _KNOWN_LOCK:   # streams of one process write side by side
        if path not in _KNOWN:
            found = [re.search(r"/seq=(\d+)/run=([^/]*)/epoch=(\d+)$", p)
                     for p in matching(spark, f"{path}/seq=*/run=*/epoch=*")]
            own = {(m[2], int(m[3])): int(m[1]) for m in found if m}
            _KNOWN[path] = (max(own.values(), default=0), own)
        last, own = _KNOWN[path]
        seq = own.get((run, epoch))
        if seq is None:
            seq = last + 1
            while not claim(spark, f"{path}/_claims/{seq}"):
                seq += 1
            own[run, epoch] = seq
            _KNOWN[path] = (seq, own)
    return f"{path}/seq={seq}/run={run}/epoch={epoch}"


def _bucket(spec: TableSpec):
    return F.pmod(F.xxhash64(_q(spec.key)), F.lit(BUCKETS)).cast("int")


def upsert(df: DataFrame, path: str, spec: TableSpec, epoch: int, run_id: str,
           dedupe_rule: str = "none", strict: bool = True, small: bool = False) -> None:
    """Write one batch as the (run, epoch) slice of the table.

    Rows are conformed to ``spec`` (names, order, types); a null key fails the
    write, as a store with a primary key would — default it or set it aside first
    (``clean.null_key``). ``strict=False`` allows absent columns, which the slice
    then does not set. ``small`` is for batches of a bounded number of rows: one task
    writes one file, not one a bucket.
    """
    if not run_id or not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"an upsert needs the id of its run, got {run_id!r}")
    given = {c.lower() for c in df.columns}
    mask = "".join("1" if c.lower() in given else "0" for c in spec.value_columns)
    out = dedupe(spec.conform(df, strict=strict), spec, dedupe_rule)
    out = out.withColumn(SET_COL, F.lit(mask)).withColumn(BUCKET_COL, F.lit(WHOLE) if small else _bucket(spec)) \
             .where(F.assert_true(_q(spec.key).isNotNull(), f"null key in {spec.name}").isNull())
    target = _slice_path(df.sparkSession, path.rstrip("/"), run_id, int(epoch))
    # a task holds few buckets, so a slice has about as many files as buckets and tasks
    out = out.coalesce(1) if small else out.repartition(BUCKET_COL)
    out.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(target)


def _empty(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def read_slices(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame | None:
    schema = T.StructType(spec.schema.fields + [
        T.StructField(SET_COL, T.StringType(), True),
        T.StructField("seq", T.LongType(), True),
        T.StructField("run", T.StringType(), True),
        T.StructField("epoch", T.LongType(), True),
        T.StructField(BUCKET_COL, T.IntegerType(), True)])
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _latest(slices: DataFrame, spec: TableSpec) -> DataFrame:
    def order(i: int):
        return F.when(F.substring(SET_COL, i + 1, 1) == "1", F.col("seq"))

    return slices.groupBy(spec.key).agg(
        *[F.max_by(_q(c), order(i)).alias(c) for i, c in enumerate(spec.value_columns)])


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Current state: the latest value per key and column."""
    slices = read_slices(spark, path, spec)
    return _empty(spark, spec) if slices is None else _latest(slices, spec)


def lookup(spark: SparkSession, path: str, spec: TableSpec, keys: DataFrame) -> DataFrame:
    """Current state of the keys in ``keys`` only (J01 against a keyed table)."""
    slices = read_slices(spark, path, spec)
    if slices is None:
        return _empty(spark, spec)
    k = keys.select(_q(spec.key).cast(spec.schema[spec.key].dataType).alias(spec.key))
    # at most BUCKETS + 1 rows; the condition, true for all, tells the planner that they prune
    touched = k.select(F.explode(F.array(_bucket(spec), F.lit(WHOLE))).alias(BUCKET_COL)) \
        .where(F.col(BUCKET_COL) >= WHOLE).distinct()
    near = slices.join(F.broadcast(touched), BUCKET_COL, "left_semi")
    return _latest(near.join(k, on=spec.key, how="left_semi"), spec)


class KeyedHistory:
    """A keyed table used as stored history: read per batch, by the batch's keys."""

    def __init__(self, path: str, spec: TableSpec):
        self.path, self.spec = path, spec

    def lookup(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        return lookup(spark, self.path, self.spec, keys)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.spec)
