"""The rank label and its inverse as stages of a Spark ML pipeline.

``RankLabel`` fits the frequency index of a target on the rows it is given, so each
fold of a cross-validation has an index of its own; ``Unrank`` maps predictions in rank
space back to target values. Both models carry their index as a table (a join, no
label list on the driver) and save it with the stage, so a pipeline with them is one
``PipelineModel`` on disk. Rows without the target column pass ``RankLabelModel`` as they
are, as serving data do.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from . import features as feat


class _IndexWriter(MLWriter):
    def __init__(self, model: _IndexModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"n": self.model.n})
        self.model.index.write.parquet(f"{path}/index")


class _IndexReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/index"), metadata["n"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _IndexModel(Model, HasLabelCol, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """A fitted stage that carries a frequency index (value, count, index) of ``n`` values."""

    def __init__(self, index: DataFrame | None = None, n: int = 0) -> None:
        super().__init__()
        self.index, self.n = index, n

    def write(self) -> MLWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexReader(cls)


class _IndexEstimator(Estimator, HasLabelCol, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    model: type

    def _fit(self, dataset: DataFrame) -> _IndexModel:
        spark = dataset.sparkSession
        path = scratch(spark, "rank-index")
        feat.frequency_index(dataset, self.getLabelCol()).write.parquet(path)
        index = spark.read.parquet(path)
        return self._copyValues(self.model(index, index.count()))


class RankLabelModel(_IndexModel):
    """Adds ``outputCol``, the rank of ``labelCol``; values the fit did not see and nulls
    get the rank after the last."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getLabelCol() not in dataset.columns:
            return dataset
        return feat.rank_label(dataset, self.getLabelCol(), self.index, out=self.getOutputCol(), n_labels=self.n)


class RankLabel(_IndexEstimator):
    """Target ``labelCol`` -> its frequency rank ``outputCol``."""

    model = RankLabelModel

    @keyword_only
    def __init__(self, *, labelCol: str = "target", outputCol: str = "label") -> None:
        super().__init__()
        self._set(**self._input_kwargs)


class UnrankModel(_IndexModel):
    """Adds ``outputCol``, the value of ``labelCol`` whose rank ``inputCol`` predicts (G2's
    guards: null for NaN and null, the first or last value beyond the ends)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return feat.unrank(dataset, self.getInputCol(), self.index, self.getOutputCol(), n_labels=self.n)


class Unrank(_IndexEstimator):
    """Prediction ``inputCol`` in rank space -> value ``outputCol`` of ``labelCol``."""

    model = UnrankModel

    @keyword_only
    def __init__(self, *, labelCol: str = "target", inputCol: str = "prediction",
                 outputCol: str = "predicted") -> None:
        super().__init__()
        self._set(**self._input_kwargs)
