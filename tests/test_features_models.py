import math

from pyspark.sql import functions as F

from tidewell.operators import evaluate, features as feat, models
from tidewell.operators.ranking import global_row_number
from tidewell.plans import flows


def test_frequency_index_matches_window_rank(spark):
    vals = ["b"] * 5 + ["a"] * 5 + ["c"] * 7 + ["d"] + ["e"] * 2 + [None] * 3
    df = spark.createDataFrame([(v,) for v in vals], "v string").repartition(4)
    idx = {r.value: (r["count"], r["index"]) for r in feat.frequency_index(df, "v").collect()}
    assert idx == {"c": (7, 0), "a": (5, 1), "b": (5, 2), "e": (2, 3), "d": (1, 4)}


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(9)
    out = global_row_number(df, [F.col("x").desc()], "pos")
    bad = out.where(F.col("pos") != F.lit(4999) - F.col("x")).count()
    assert bad == 0 and out.count() == 5000


def test_unrank_guard(spark):
    index = spark.createDataFrame([("10", 5, 0), ("20", 3, 1), ("30", 1, 2)],
                                  "value string, count long, index long")
    preds = [(0, 1.99), (1, -0.5), (2, -3.0), (3, 99.0), (4, float("nan")), (5, None), (6, 2.0)]
    df = spark.createDataFrame(preds, "k int, p double")
    out = {r.k: r.label for r in feat.unrank(df, "p", index, "label").collect()}
    assert out == {0: "20", 1: "10", 2: "10", 3: "30", 4: None, 5: None, 6: "30"}


def test_rank_label_unseen_gets_extra_rank(spark):
    index = spark.createDataFrame([("1.0", 2, 0), ("2.0", 1, 1)], "value string, count long, index long")
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "y double")
    out = sorted((r.y, r.label) for r in feat.rank_label(df, "y", index).collect()
                 if r.y is not None)
    assert out == [(1.0, 0.0), (2.0, 1.0), (3.0, 2.0)]


def test_categorical_empty_null_unseen(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("",), (None,)], "c string")
    stages, vec = feat.categorical(["c"])
    m = models.fit(stages, train)
    new = spark.createDataFrame([("a",), ("",), ("zzz",), (None,)], "c string")
    got = {r.c: r.c__idx for r in m.transform(new).collect()}
    n = len(m.stages[1].labelsArray[0])
    assert got["a"] == 0.0 and got["zzz"] == float(n) and got[None] == float(n)
    assert got[""] < n


def test_linear_matches_closed_form(spark):
    df = spark.range(0, 200).select(F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 3.0 + 5.0 + F.sin("id")).alias("y"))
    bundle = flows.train_linear(df, ["x"], "y", fill=None)
    scored = bundle.score(df)
    ref = df.agg(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a")).first()
    worst = scored.select(F.max(F.abs(F.col("predicted") - (F.lit(ref.a) + F.lit(ref.b) * F.col("x"))))).first()[0]
    assert worst < 1e-6


def test_rank_mode_round_trip_and_save_load(spark, tmp):
    df = spark.range(0, 300).select(F.col("id").cast("double").alias("x"),
                                    (F.col("id") % 5).cast("double").alias("y"))
    bundle = flows.train_linear(df, ["x"], "y", label_mode="rank", fill=None)
    a = bundle.score(df).select("id" if "id" in df.columns else "x", "predicted")
    path = tmp("model")
    bundle.save(path)
    loaded = models.load(spark, path)
    b = loaded.score(df).select("x", "predicted")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert b.where(F.col("predicted").isNull()).count() == 0


def test_gbt_finite_and_better_than_mean(spark):
    df = spark.range(0, 400).select(
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "").otherwise(None).alias("cat"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 17).cast("double").alias("num"),
        ((F.col("id") % 17) * 10.0 + (F.col("id") % 3)).alias("y"))
    bundle = flows.train_gbt(df, ["cat"], ["num"], "y", max_iter=5)
    scored = bundle.score(df)
    assert scored.where(F.col("predicted").isNull() | F.isnan("predicted")).count() == 0
    r = evaluate.rmse(scored, "predicted", "y").first().rmse
    sd = df.agg(F.stddev_pop("y")).first()[0]
    assert r < sd


def test_rmse_ignores_null_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 1.0)], "p double, l double")
    r = evaluate.rmse(df, "p", "l").first()
    assert math.isclose(r.rmse, math.sqrt(2.0)) and r.n_scored == 2 and r.n_missing == 1


def test_cross_validate_folds(spark):
    df = spark.range(0, 300).select(F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 2.0).alias("label"),
                                    (F.col("id") % 3).cast("int").alias("fold"))
    est = models.linear()
    _, metrics = models.cross_validate(df, [feat.assemble(["x"]), est], est,
                                       {"regParam": [0.01, 0.1]}, fold_col="fold")
    assert metrics.count() == 2


def test_gbt_save_load_identical(spark, tmp):
    df = spark.range(0, 300).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("cat"),
        (F.col("id") % 13).cast("double").alias("num"),
        ((F.col("id") % 13) * 3.0).alias("y"))
    bundle = flows.train_gbt(df, ["cat"], ["num"], "y", max_iter=3, label_mode="rank")
    path = tmp("gbt")
    bundle.save(path)
    loaded = models.load(spark, path)
    a = sorted(map(tuple, bundle.score(df).select("num", "cat", "predicted").collect()))
    b = sorted(map(tuple, loaded.score(df).select("num", "cat", "predicted").collect()))
    assert a == b
