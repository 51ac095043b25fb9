"""Cutting lineage at a shared, reliable place."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir, scratch


def cut(df: DataFrame, most_rows: int | None = None, rows_per_task: int = 200_000) -> DataFrame:
    """``df`` computed once and read back from the checkpoint folder all executors
    share, so that several consumers neither repeat its work nor lose it with an
    executor. Where the caller knows how many rows it can have at most, tasks are
    merged (never added) to about ``rows_per_task``: rounds over small tables then
    leave few files."""
    ensure_checkpoint_dir(df.sparkSession)
    return merged(df, most_rows, rows_per_task).checkpoint(eager=True)


def free_prefix(columns: list[str], wanted: str) -> str:
    """``wanted``, or a longer form of it that no column begins with (in any case):
    names behind it clash with none."""
    while any(c.lower().startswith(wanted.lower()) for c in columns):
        wanted = "x" + wanted
    return wanted


def merged(df: DataFrame, most_rows: int | None, rows_per_task: int = 200_000) -> DataFrame:
    if most_rows is None:
        return df
    return df.coalesce(max(1, -(-most_rows // rows_per_task)))


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` as a table in the shared folder, read back: its size is then known to the
    planner, which sends a small one to all tasks and shuffles a large one.
    ``rows_per_file`` is for rows of some MB: a file's rows are in memory together."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.parquet(path)
