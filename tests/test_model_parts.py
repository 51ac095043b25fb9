"""Exact quantiles, wide categories and versioned model folders."""
import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.operators import features as feat, models
from tidewell.operators.quantiles import QuantileFill, exact_quantiles
from tidewell.operators.wide_features import WideFeatures, WideFeaturesModel, sparse_vector, vector_parts


# -- quantiles ---------------------------------------------------------------------

@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.75, 1.0])
def test_quantiles_equal_the_sorted_list(spark, q):
    r = random.Random(7)
    rows = [(r.choice([1.0, 2.0, 2.0, 2.0, 9.0]), r.random() if r.random() < 0.8 else None,
             float("nan") if r.random() < 0.3 else r.gauss(0, 5)) for _ in range(500)]
    got = {x.column: x.value for x in exact_quantiles(
        spark.createDataFrame(rows, "ties double, gaps double, nans double").repartition(5), ["ties", "gaps", "nans"], q).collect()}
    for i, c in enumerate(["ties", "gaps", "nans"]):
        values = sorted(x[i] for x in rows if x[i] is not None and not math.isnan(x[i]))
        assert got[c] == values[max(1, math.ceil(q * len(values))) - 1]


def test_quantiles_of_a_hot_value_and_of_nothing(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("x"))
    assert [r.value for r in exact_quantiles(hot, ["x"]).collect()] == [-1.0]
    assert exact_quantiles(hot.where("x < -5"), ["x"]).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(hot, ["x"], 1.5)
    with pytest.raises(ValueError, match="no value"):
        QuantileFill(inputCols=["x"], outputCols=["y"]).fit(hot.where("x < -5"))


def test_median_stage_in_a_saved_pipeline(spark, tmp):
    df = spark.createDataFrame([(1.0, "7"), (None, "x"), (5.0, "9"), (3.0, None)], "a double, b string")
    stage = QuantileFill(inputCols=["a", "b"], outputCols=["a_full", "b_full"])
    path = tmp("median")
    Pipeline(stages=[stage]).fit(df).write().overwrite().save(path)
    got = PipelineModel.load(path).transform(df).select("a_full", "b_full").collect()
    assert sorted(map(tuple, got)) == [(1.0, 7.0), (3.0, 7.0), (3.0, 7.0), (5.0, 9.0)]


# -- wide categories ---------------------------------------------------------------

def test_slots_equal_indexer_and_encoder(spark):
    r = random.Random(3)
    rows = [(i, r.choice("aabbbccd"), r.choice(["x", "y", None, "z z", '"q"\\']), r.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, c string, d string, n double")
    train = df.where("id < 200 and c != 'd'")
    cats = ["c", "d"]
    plain = Pipeline(stages=[
        StringIndexer(inputCols=cats, outputCols=["ci", "di"], handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=["ci", "di"], outputCols=["cv", "dv"], handleInvalid="keep"),
        feat.assemble(["cv", "dv", "n"])]).fit(train)
    wide = WideFeatures(inputCols=cats, numericCols=["n"]).fit(train)
    dense = lambda m: {x.id: list(x.v) for x in m.transform(df).select("id", vector_to_array("features").alias("v")).collect()}
    assert dense(wide) == dense(plain)
    hot = wide.transform(df).select(vector_parts(F.col("features")).alias("p")).select("p.*").distinct()
    assert {x.type for x in hot.collect()} == {0} and {x.size for x in hot.collect()} == {wide.width}


def test_a_million_categories_need_no_list_on_the_driver(spark, tmp):
    df = spark.range(1_000_000).select(F.concat(F.lit("k"), F.col("id")).alias("c"), (F.col("id") % 7).cast("double").alias("n"))
    model = WideFeatures(inputCols=["c"], numericCols=["n"]).fit(df)
    path = tmp("wide")
    model.write().save(path)
    loaded = WideFeaturesModel.load(path)
    assert loaded.sizes == [1_000_000] and loaded.width == 1_000_002
    few = spark.createDataFrame([("k0", 3.0), ("k999999", None), ("new", 1.0)], "c string, n double")
    got = {x.c: x.p for x in loaded.transform(few).select("c", vector_parts(F.col("features")).alias("p")).collect()}
    assert got["k0"].indices == [0, 1_000_001] and got["k999999"].indices == [999_999, 1_000_001]
    assert got["new"].indices == [1_000_000, 1_000_001] and math.isnan(got["k999999"]["values"][1])


def test_trees_learn_from_wide_features(spark):
    df = spark.range(400).select(F.concat(F.lit("k"), F.col("id") % 5).alias("c"), F.lit(1.0).alias("n"),
                                 ((F.col("id") % 5) * 10).cast("double").alias("label"))
    model = models.fit([WideFeatures(inputCols=["c"], numericCols=["n"]), models.gbt(max_iter=2)], df)
    assert model.transform(df).where("abs(prediction - label) > 0.01").count() == 0


def test_sparse_vectors_without_slots(spark):
    none = spark.range(1).select(sparse_vector(3, F.array().cast("array<int>"), F.array().cast("array<double>")).alias("v"))
    assert list(none.select(vector_to_array("v")).first()[0]) == [0.0, 0.0, 0.0]


# -- versions of a model -----------------------------------------------------------

def _bundle(spark, slope, mode="value"):
    df = spark.range(30).select(F.col("id").cast("double").alias("x"), (F.col("id") * slope).cast("double").alias("y"))
    return models.train(df, [feat.assemble(["x"]), models.linear()], "y", mode)


def _at_ten(spark, bundle):
    return round(bundle.score(spark.createDataFrame([(10.0,)], "x double")).first().predicted, 6)


@pytest.mark.parametrize("step", ["pipeline", "index", "meta", "commit"])
def test_a_save_that_dies_leaves_the_model_before_it(spark, tmp, monkeypatch, step):
    path = tmp("model")
    _bundle(spark, 2, "rank").save(path)
    before = _at_ten(spark, models.load(spark, path))
    new = _bundle(spark, 5, "rank")

    def die(*a, **k):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as m:
        if step == "pipeline":
            m.setattr(type(new.pipeline), "write", die)
        elif step == "index":
            new.index = type("Dying", (), {"write": property(die)})()
        elif step == "meta":
            m.setattr(models.json, "dumps", die)
        else:
            real = models.folders.claim
            m.setattr(models.folders, "claim", lambda s, p: die() if p.endswith(models.COMMITTED) else real(s, p))
        with pytest.raises(KeyboardInterrupt):
            new.save(path)
    assert _at_ten(spark, models.load(spark, path)) == before
    assert _bundle(spark, 7).save(path).endswith("/v=3")            # the dead one's number is not used again
    assert _at_ten(spark, models.load(spark, path)) == 70.0


def test_old_versions_go_only_on_request(spark, tmp):
    path = tmp("model")
    with pytest.raises(FileNotFoundError):
        models.load(spark, path)
    for slope in (1, 2, 3):
        _bundle(spark, slope).save(path)
    assert sorted(models._versions(spark, path, "v=*")) == [1, 2, 3]
    _bundle(spark, 4).save(path, keep=2)
    assert sorted(models._versions(spark, path, "v=*")) == [3, 4] and _at_ten(spark, models.load(spark, path)) == 40.0
