"""Model operators.

A ``ModelBundle`` is a fitted Spark ML ``PipelineModel`` plus, for rank labels,
the frequency-index table that maps ranks back to label values. Both are saved
under one directory (pipeline directory + parquet table), so serving needs no
driver-side label list.

A save writes a new version, ``{path}/v={n}/``, and marks it as committed when all of it is
there; loading takes the last committed one. So a save that dies at any step leaves the
model before it in place, readers never see half of one, and a loaded model may be
saved over its own folder.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import folders
from . import features as feat

COMMITTED = "_COMMITTED"

#: Training rows of a partition of an iterative fit, which a task reads from the cache in each pass.
PARTITION_ROWS = 250_000


def linear(features: str = "features", label: str = "label", max_iter: int = 10,
           reg_param: float = 0.0, elastic_net: float = 0.0) -> LinearRegression:
    """Linear regression (M06). With no L1 term and few features Spark solves the
    normal equations from one distributed pass (exact least squares)."""
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net)


def gbt(features: str = "features", label: str = "label", max_iter: int = 10,
        max_depth: int = 5, seed: int = 42) -> GBTRegressor:
    """Gradient-boosted regression trees (M07), fixed seed for repeatability."""
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter,
                        maxDepth=max_depth, seed=seed)


def fit(stages: Sequence, df: DataFrame) -> PipelineModel:
    """Fit a pipeline."""
    return Pipeline(stages=list(stages)).fit(df)



@dataclass
class ModelBundle:
    pipeline: PipelineModel
    label: str
    label_mode: str = "value"          # "value" or "rank"
    index: DataFrame | None = None     # value, count, index (rank mode)
    n_labels: int | None = None
    prediction: str = "prediction"

    def score(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """Score and map the prediction back to label space as ``out`` (double)."""
        scored = self.pipeline.transform(df)
        if self.label_mode == "rank":
            scored = feat.unrank(scored, self.prediction, self.index, "__label_text",
                                 n_labels=self.n_labels)
            return scored.withColumn(out, F.col("__label_text").try_cast("double")).drop("__label_text")
        return scored.withColumn(out, F.col(self.prediction))

    def save(self, path: str, keep: int | None = None) -> str:
        """Persist the bundle as the next version of ``path`` (S10) and return its folder.
        ``keep`` removes committed versions but the last so many; by default none, as
        a loaded bundle still reads the index of the version it came from."""
        spark, path = self.pipeline_spark(), path.rstrip("/")
        n = max(_versions(spark, path, "v=*"), default=0) + 1
        while not folders.claim(spark, f"{path}/_claims/{n}"):      # another save's
            n += 1
        target = f"{path}/v={n}"
        self.pipeline.write().save(f"{target}/pipeline")
        if self.index is not None:
            self.index.write.parquet(f"{target}/index")
        meta = {"label": self.label, "label_mode": self.label_mode, "n_labels": self.n_labels,
                "prediction": self.prediction}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{target}/meta")
        folders.claim(spark, f"{target}/{COMMITTED}")
        for old in sorted(_versions(spark, path, f"v=*/{COMMITTED}"))[:-keep] if keep else ():
            folders.remove(spark, f"{path}/v={old}")
        return target

    def pipeline_spark(self) -> SparkSession:
        return SparkSession.getActiveSession()


def _versions(spark: SparkSession, path: str, pattern: str) -> list[int]:
    return [int(m[1]) for p in folders.matching(spark, f"{path}/{pattern}") if (m := re.search(r"/v=(\d+)(/|$)", p))]


def load(spark: SparkSession, path: str) -> ModelBundle:
    """Load the last committed version of a saved bundle."""
    path = path.rstrip("/")
    committed = _versions(spark, path, f"v=*/{COMMITTED}")
    if not committed:
        raise FileNotFoundError(f"no committed model in {path}")
    at = f"{path}/v={max(committed)}"
    pipeline = PipelineModel.load(f"{at}/pipeline")
    meta = json.loads(spark.read.json(f"{at}/meta").first()["meta"])
    index = spark.read.parquet(f"{at}/index") if meta["label_mode"] == "rank" else None
    return ModelBundle(pipeline, meta["label"], meta["label_mode"], index, meta["n_labels"], meta["prediction"])


def label_frame(df: DataFrame, label: str, label_mode: str = "value",
                out: str = "label") -> tuple[DataFrame, DataFrame | None, int | None]:
    """Training frame with a double ``label`` column (value or frequency rank)."""
    if label_mode == "value":
        return df.withColumn(out, F.col(f"`{label}`").try_cast("double")), None, None
    if label_mode == "rank":
        index = feat.frequency_index(df, label)
        n = index.count()
        return feat.rank_label(df, label, index, out=out, n_labels=n), index, n
    raise ValueError(f"unknown label mode {label_mode!r}")


def train(df: DataFrame, stages: Sequence, label: str, label_mode: str = "value",
          partitions: int | None = None) -> ModelBundle:
    """Fit ``stages`` on ``df`` with the label prepared per ``label_mode``.

    ``partitions`` spreads the training rows round-robin over that many
    partitions, and one for every ``PARTITION_ROWS`` rows, if they arrive in fewer: worth one shuffle for iterative fits
    (trees make dozens of passes over the cached data); round-robin ignores keys,
    so a hot key cannot skew it. An input with more partitions stays as it is."""
    labelled, index, n = label_frame(df, label, label_mode)
    if not partitions:
        return ModelBundle(fit(stages, labelled), label, label_mode, index, n)
    labelled = labelled.persist()  # counted and then read by the fit's passes
    try:
        spread = labelled
        partitions = max(int(partitions), math.ceil(labelled.count() / PARTITION_ROWS))
        if labelled.rdd.getNumPartitions() < partitions:
            spread = labelled.repartition(partitions)
        return ModelBundle(fit(stages, spread), label, label_mode, index, n)
    finally:
        labelled.unpersist()


def cross_validate(df: DataFrame, stages: Sequence, estimator, grid: dict, num_folds: int = 3,
                   fold_col: str | None = None, parallelism: int = 2, label: str = "label",
                   prediction: str = "prediction", seed: int = 42):
    """k-fold cross-validation over a parameter grid.

    ``grid`` maps an estimator param name to candidate values, e.g.
    ``{"regParam": [0.01, 0.1]}``. ``fold_col`` (int in [0, k)) makes folds
    repeatable. Returns ``(cv_model, metrics)`` where ``metrics`` has one row per
    candidate with its mean RMSE.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    cv = CrossValidator(estimator=Pipeline(stages=list(stages)), estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=label, predictionCol=prediction,
                                                      metricName="rmse"),
                        numFolds=num_folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    model = cv.fit(df)
    rows = []
    for pm, metric in zip(maps, model.avgMetrics):
        params = {p.name: v for p, v in pm.items()}
        rows.append((json.dumps(params, sort_keys=True), float(metric)))
    spark = df.sparkSession
    metrics = spark.createDataFrame(rows, "params string, avg_rmse double")
    return model, metrics
