"""The rank label and its inverse as pipeline stages, and the trees on several features."""
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidewell.operators import features as feat, models
from tidewell.operators.rank_stage import RankLabel, RankLabelModel, Unrank, UnrankModel


@pytest.fixture
def points(spark):
    rows = [("a", 1.0)] * 4 + [("b", 2.0)] * 3 + [("", 3.0)] * 2 + [("c", 4.0), (None, 5.0)]
    return spark.createDataFrame(rows, "target string, x double")


def test_ranks_by_frequency_with_an_extra_rank_for_the_rest(spark, points):
    model = RankLabel(labelCol="target", outputCol="label").fit(points)
    assert isinstance(model, RankLabelModel) and model.n == 4
    seen = spark.createDataFrame([("a",), ("b",), ("",), ("c",), ("new",), (None,)], "target string")
    assert {r.target: r.label for r in model.transform(seen).collect()} == \
        {"a": 0.0, "b": 1.0, "": 2.0, "c": 3.0, "new": 4.0, None: 4.0}
    serving = points.drop("target")
    assert model.transform(serving).columns == serving.columns


def test_unrank_guards_both_ends(spark, points):
    model = Unrank(labelCol="target", inputCol="p", outputCol="value").fit(points)
    assert isinstance(model, UnrankModel)
    got = model.transform(spark.createDataFrame([(-3.0,), (0.9,), (1.0,), (99.0,), (float("nan"),), (None,)], "p double"))
    assert [r.value for r in got.collect() if r.p is None or r.p != r.p] == [None, None]
    assert {r.p: r.value for r in got.collect() if r.p is not None and r.p == r.p} == \
        {-3.0: "a", 0.9: "a", 1.0: "b", 99.0: "c"}


def test_pipeline_with_ranks_is_one_model_on_disk(spark, points, tmp):
    est = models.linear()
    stages = [RankLabel(labelCol="target", outputCol="label"), feat.assemble(["x"]), est,
              Unrank(labelCol="target", inputCol="prediction", outputCol="predicted")]
    unfitted, fitted = tmp("estimators"), tmp("pipeline")
    Pipeline(stages=stages).write().overwrite().save(unfitted)
    model = Pipeline.load(unfitted).fit(points)
    model.write().overwrite().save(fitted)
    loaded = PipelineModel.load(fitted)
    assert [type(s).__name__ for s in loaded.stages] == [type(s).__name__ for s in model.stages]
    for frame in (points, points.drop("target")):
        want = sorted(map(str, model.transform(frame).select("x", "predicted").collect()))
        assert sorted(map(str, loaded.transform(frame).select("x", "predicted").collect())) == want


def test_each_fold_ranks_by_its_own_rows(spark):
    """A value that one fold alone holds is unseen where that fold is held out."""
    rows = [(i, "ab"[i % 2] if i % 3 else "c", float(i % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, target string, x double, fold int")
    fits = []

    class Watched(RankLabel):
        def _fit(self, dataset):
            model = super()._fit(dataset)
            fits.append(sorted(r.value for r in model.index.collect()))
            return model

    est = models.linear()
    stages = [Watched(labelCol="target", outputCol="label"), feat.assemble(["x"]), est]
    models.cross_validate(df, stages, est, {"regParam": [0.1]}, fold_col="fold", parallelism=1)
    assert fits == [["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["a", "b", "c"]]   # the last fit takes all rows


def test_hot_label_is_no_single_group(spark):
    """A value with nearly all rows is one row a task before the shuffle."""
    df = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, F.col("id").cast("string")).otherwise("hot").alias("target"))
    model = RankLabel(labelCol="target", outputCol="label").fit(df)
    first = model.index.orderBy("index").first()
    assert (first["value"], first["count"], model.n) == ("hot", 19_600, 401)
