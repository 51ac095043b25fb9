import math

from pyspark.sql import functions as F

from tidewell.operators import merge

BATCH = [(1, 10.0, None), (1, 12.0, 3.0), (2, 5.0, 1.0), (3, None, None), (None, 4.0, 4.0)]
HIST = [(1, -7.0, 2.0), (2, None, float("nan")), (4, 100.0, 100.0), (None, 9.0, 9.0)]


def frames(spark):
    b = spark.createDataFrame(BATCH, "id int, age double, price double")
    h = spark.createDataFrame(HIST, "id int, physics double, chemistry double")
    return b, h


def rows(df):
    return {r.id: r for r in df.collect()}


def test_parity_mode_clobbers_negative_and_fills(spark):
    b, h = frames(spark)
    out = rows(merge.merge_max(b, h, "id", ["age", "price"], ["physics", "chemistry"], absent=0.0))
    assert set(out) == {1, 2, 3, None}          # only batch keys; 4 is not in the batch
    assert out[1].age == 12.0 and out[1].price == 3.0
    assert out[1].physics == 0.0                # -7 stored, 0.0 absent in the batch side wins
    assert out[1].chemistry == 2.0
    assert out[2].physics == 0.0 and out[2].chemistry == 0.0   # null and NaN filled with 0
    assert out[3].age is None                   # all-null batch column, key absent from history
    assert out[3].physics == 0.0                # history-only feature: the batch side's 0.0
    assert out[None].physics == 0.0             # null key finds no history


def test_null_safe_mode_keeps_negative(spark):
    b, h = frames(spark)
    out = rows(merge.merge_max(b, h, "id", ["age", "price"], ["physics", "chemistry"], absent=None))
    assert out[1].physics == -7.0
    assert out[3].age is None and out[3].physics is None       # key absent from history
    assert math.isnan(out[2].chemistry)         # NaN is kept (and is the greatest)


def test_several_stored_rows_of_a_key_are_folded(spark):
    b, h = frames(spark)
    h = h.union(spark.createDataFrame([(1, 5.0, 0.5)], h.schema))
    out = rows(merge.merge_max(b, h, "id", ["age"], ["physics", "chemistry"], absent=None))
    assert (out[1].physics, out[1].chemistry) == (5.0, 2.0) and set(out) == {1, 2, 3, None}


def test_empty_batch(spark):
    b, h = frames(spark)
    out = merge.merge_max(b.limit(0), h, "id", ["age"], ["physics"])
    assert out.count() == 0


def test_lookup_keeps_matching_rows_only(spark):
    b, h = frames(spark)
    assert sorted(r.id for r in merge.lookup(h, merge.keys(b, "id"), "id").collect()) == [1, 2]


def test_hot_key_reduce(spark):
    # one key holds a third of the rows: partial aggregation keeps it cheap and exact
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("double").alias("v"))
    out = merge.reduce_max(df, "k", ["v"]).where("k = 7").first()
    assert out.v == 29997.0
