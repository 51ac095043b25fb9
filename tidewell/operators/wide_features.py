"""Category indexes as tables and sparse feature vectors by joins.

For columns whose categories do not fit a driver: each column's frequency index (value, index)
is a table, the planner sends a small one to all tasks and shuffles a large one, and hot
values are split by adaptive execution. A row's vector holds one slot per category of every
column and one more for unseen and null, then the numbers; only the slots that are set are
stored. The slots are those of ``StringIndexer`` and ``OneHotEncoder`` with
``handleInvalid="keep"``.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch
from . import features as feat

_STORED = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def sparse_vector(size: int, indices, values):
    """Columns ``indices`` (array of int, ascending) and ``values`` (array of double) as a
    sparse vector. Spark SQL has no constructor for one, but reads its stored form."""
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    return F.from_json(F.to_json(F.struct(stored.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def vector_parts(vector):
    """The stored form of a vector column: ``type, size, indices, values``."""
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), f"struct<v:{_STORED}>")["v"]


class _Writer(MLWriter):
    def __init__(self, model: WideFeaturesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes})
        for i, index in enumerate(self.model.indexes):
            index.write.parquet(f"{path}/index-{i}")


class _Reader(MLReader):
    def load(self, path: str) -> WideFeaturesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        sizes = metadata["sizes"]
        model = WideFeaturesModel([self.sparkSession.read.parquet(f"{path}/index-{i}") for i in range(len(sizes))], sizes)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _WideParams(HasInputCols, HasOutputCol):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns behind the categories",
                        typeConverter=TypeConverters.toListString)

    def getNumericCols(self) -> list[str]:
        return self.getOrDefault(self.numericCols)


class WideFeaturesModel(Model, _WideParams, MLReadable, MLWritable):
    """Adds the sparse vector ``outputCol``. Nulls and NaN among the numbers are stored as NaN."""

    def __init__(self, indexes: list[DataFrame] | None = None, sizes: list[int] | None = None) -> None:
        super().__init__()
        self.indexes, self.sizes = indexes or [], sizes or []

    @property
    def width(self) -> int:
        return sum(n + 1 for n in self.sizes) + len(self.getNumericCols())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, slots, offset = dataset, [], 0
        for i, (c, index, n) in enumerate(zip(self.getInputCols(), self.indexes, self.sizes)):
            found = index.select(F.col("value").alias(f"__value_{i}"), F.col("index").alias(f"__index_{i}"))
            rows = rows.join(found, F.col(f"`{c}`").cast("string") == F.col(f"__value_{i}"), "left")
            slots.append(F.lit(offset) + F.coalesce(F.col(f"__index_{i}"), F.lit(n)).cast("int"))
            offset += n + 1
        numbers = self.getNumericCols()
        indices = F.array(*slots, *[F.lit(offset + k) for k in range(len(numbers))])
        values = F.array(*[F.lit(1.0)] * len(slots),
                         *[F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(float("nan"))) for c in numbers])
        drop = [f"__{kind}_{i}" for i in range(len(slots)) for kind in ("value", "index")]
        return rows.withColumn(self.getOutputCol(), sparse_vector(self.width, indices, values)).drop(*drop)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class WideFeatures(Estimator, _WideParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a frequency index table per category column."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, numericCols: list[str] | None = None,
                 outputCol: str = "features") -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._set(numericCols=numericCols or [], outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> WideFeaturesModel:
        spark, indexes = dataset.sparkSession, []
        for c in self.getInputCols():
            path = scratch(spark, "category-index")
            feat.frequency_index(dataset, c).write.parquet(path)
            indexes.append(spark.read.parquet(path))
        return self._copyValues(WideFeaturesModel(indexes, [index.count() for index in indexes]))
