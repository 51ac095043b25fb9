"""File sources: batch CSV, streaming file directories, literal rows
(S01 S02 S03 S13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import TableSpec


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             header: bool = True, options: Mapping[str, str] | None = None,
             rejected: str | None = None) -> DataFrame:
    """Batch CSV scan (S01/S02). ``rejected`` (with a schema) as in ``stream_files``. Without ``schema`` every column is text (type it
    with ``clean.cast_columns``); with one, a bad numeric field is null (the rest
    of the row is kept). Never infers: inference is an extra full pass."""
    reader = spark.read.options(header=str(header).lower(), sep=sep, **dict(options or {}))
    if schema is not None and rejected:
        schema = with_rejected(schema, rejected)
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=rejected)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def with_rejected(schema: T.StructType, column: str) -> T.StructType:
    if column.lower() in {f.name.lower() for f in schema.fields}:
        raise ValueError(f"{column!r} is a column of the data already")
    return T.StructType([*schema.fields, T.StructField(column, T.StringType(), True)])


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                 max_files_per_trigger: int | None = None, sep: str = ",", header: bool = True,
                 options: Mapping[str, str] | None = None,
                 max_bytes_per_trigger: int | None = None, rejected: str | None = None) -> DataFrame:
    """Streaming scan of a directory of files.

    ``rejected`` adds a text column that holds the raw line of a malformed CSV or JSON row
    (a value that its type cannot hold, too many or too few fields, broken JSON) and
    null for the others; ``flows.RejectAside`` parts the two.

    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound each
    micro-batch by file count or by data volume (no default of 1: let a batch
    take what has arrived). ``options`` passes e.g. ``pathGlobFilter``.
    """
    if rejected:
        schema = with_rejected(schema, rejected)
    reader = spark.readStream.format(fmt).schema(schema)
    if rejected:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=rejected)
    if fmt == "csv":
        reader = reader.options(sep=sep, header=str(header).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    if options:
        reader = reader.options(**dict(options))
    return reader.load(path)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str],
                 spec: TableSpec | None = None) -> DataFrame:
    """Hand-written rows naming only some columns (S13); with ``spec`` the rest
    of the table's columns are typed nulls, in the table's order."""
    by_name = {f.name: f for f in spec.schema.fields} if spec else {}
    fields = [T.StructField(c, by_name[c].dataType if c in by_name else _infer(rows, i), True)
              for i, c in enumerate(columns)]
    conv = []
    for r in rows:
        conv.append(tuple(_coerce(v, f.dataType) for v, f in zip(r, fields)))
    df = spark.createDataFrame(conv, T.StructType(fields))
    return spec.conform(df, strict=False) if spec else df


def append_rows(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks become nulls."""
    return base.unionByName(extra, allowMissingColumns=True)


def _infer(rows, i) -> T.DataType:
    for r in rows:
        v = r[i]
        if v is None:
            continue
        if isinstance(v, bool):
            return T.BooleanType()
        if isinstance(v, int):
            return T.LongType()
        if isinstance(v, float):
            return T.DoubleType()
        return T.StringType()
    return T.StringType()


def _coerce(v, t: T.DataType):
    if v is None:
        return None
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return float(v)
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return int(v)
    return v
