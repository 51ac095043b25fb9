"""Message envelope: a row becomes ``key, value, offset`` and back.

Two wire forms:

* ``json`` (default): ``to_json(struct(...))`` / ``from_json``. Lossless, texts
  may hold commas, quotes and newlines.
* ``text``: the row printed as a struct literal, ``{1, 2.0, null}``; decoding
  strips the outer brackets or braces, splits on commas, trims and casts each
  field with ``try_cast``. Kept for compatibility with producers that emit it;
  it cannot carry commas inside a field.

Both are per-row expressions: no shuffle, stays in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("offset", T.LongType(), True),
])


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def encode_value(columns: Sequence[str], fmt: str = "json") -> Column:
    s = F.struct(*[_q(c) for c in columns])
    if fmt == "json":
        return F.to_json(s)
    if fmt == "text":
        return s.cast("string")
    raise ValueError(f"unknown envelope format {fmt!r}")


def encode(df: DataFrame, columns: Sequence[str] | None = None, fmt: str = "json",
           key: str | Column | None = None, offset: str | Column | None = None) -> DataFrame:
    """Rows -> ``key string, value string[, offset long]``.

    ``key`` defaults to a null string (the log then spreads rows over its
    partitions); ``offset`` is passed through when given (a log assigns its own).
    """
    columns = list(columns or df.columns)
    k = (F.lit(None).cast("string") if key is None else
         (_q(key) if isinstance(key, str) else key).cast("string"))
    cols = [k.alias("key"), encode_value(columns, fmt).alias("value")]
    if offset is not None:
        cols.append((_q(offset) if isinstance(offset, str) else offset).cast("long").alias("offset"))
    return df.select(*cols)


def strip_delimiters(value: Column) -> Column:
    """Remove one leading ``[``/``{`` and one trailing ``]``/``}``."""
    return F.regexp_replace(value, r"^\s*[\[{]|[\]}]\s*$", "")


def decode(df: DataFrame, schema: T.StructType, fmt: str = "json", value: str = "value",
           keep: Sequence[str] = ("offset",)) -> DataFrame:
    """``value`` text -> typed columns of ``schema``, plus the ``keep`` columns
    (the message position by default) (P12 P13).

    Malformed input never fails the job: a missing or non-numeric field is null. The text
    form writes a null as ``null`` without quoting, so a text field of that very word comes
    back as null there; the JSON form tells the two apart.
    """
    keep = [c for c in keep if c in df.columns]
    v = _q(value).cast("string")
    if fmt == "json":
        parsed = F.from_json(v, schema, {"mode": "PERMISSIVE"}).alias("__row")
        out = df.select(parsed, *[_q(c) for c in keep])
        return out.select(*[F.col("__row").getField(f.name).alias(f.name) for f in schema.fields],
                          *[_q(c) for c in keep])
    if fmt == "text":
        parts = F.split(strip_delimiters(v), ",")
        out = df.select(parts.alias("__parts"), *[_q(c) for c in keep])
        fields = []
        for i, f in enumerate(schema.fields):
            raw = F.trim(F.get(F.col("__parts"), i))
            if isinstance(f.dataType, T.StringType):
                col = F.when(raw == "null", F.lit(None)).otherwise(raw)
            else:
                col = raw.try_cast(f.dataType)
            fields.append(col.alias(f.name))
        return out.select(*fields, *[_q(c) for c in keep])
    raise ValueError(f"unknown envelope format {fmt!r}")
