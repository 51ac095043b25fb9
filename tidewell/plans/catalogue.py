"""Query catalogue: each entry pairs a Spark plan over the driver's tables with
an equivalent SQL text (DuckDB dialect) used as an independent oracle.

Entries without SQL are checked by row count only (model fits, streams whose
output is not a closed form).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, ops: tuple[str, ...] = (), sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules registers their queries
    from . import q_relational, q_models, q_streams  # noqa: F401
    return REGISTRY
