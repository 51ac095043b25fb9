"""How the driver's tables stand in for the original data sets.

* stream rows (id + a few numeric features, many rows per id): ``orders``
* stored history (one row per id, other features, negative values): ``customer``
* log messages: ``events`` (``event_id`` plays the offset); texts with commas:
  ``documents``
* rank label with few distinct values: ``lineitem.l_quantity``
* a house-like training table (categoricals + numerics): ``orders`` x ``customer``

The SQL fragments below are the oracle's view of the same frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

BATCH_FEATURES = ["totalprice", "order_year"]
HISTORY_FEATURES = ["acctbal", "nation"]


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("id"),
                    F.col("o_totalprice").alias("totalprice"),
                    F.year("o_orderdate").cast("double").alias("order_year"),
                    F.col("o_orderkey"))


STREAM_ROWS_SQL = """(select o_custkey as id, o_totalprice as totalprice,
  cast(year(o_orderdate) as double) as order_year, o_orderkey from orders)"""


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"),
                    F.col("c_nationkey").cast("double").alias("nation"))


HISTORY_ROWS_SQL = """(select c_custkey as id, c_acctbal as acctbal,
  cast(c_nationkey as double) as nation from customer)"""
