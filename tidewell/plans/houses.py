"""The house-price workflow on its own CSV layout.

Train: all-text CSV read, per-column casts, 43 text categories indexed and
one-hot encoded, a lot-frontage default and mean imputation inside the
pipeline, gradient-boosted trees. Serve: a CSV directory with the 80 stream
columns, typed and null-key defaulted on the stream, scored per micro-batch and
upserted as ``id, saleprice``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, evaluate, models
from ..schemas import (HOUSE_CATEGORICAL, HOUSE_LABEL, HOUSE_NUMERIC, house_predictions_table,
                       house_stream_schema, house_train_casts)
from ..sources import external, files, keyed
from . import flows

# Fixed value: default lot frontage for missing values.
LOT_FRONTAGE_DEFAULT = 60.0


def load_training(spark: SparkSession, csv_path: str, sep: str = ",") -> DataFrame:
    return clean.cast_columns(files.read_csv(spark, csv_path, sep=sep), house_train_casts())


def train(spark: SparkSession, csv_path: str, model_path: str | None = None,
          label_mode: str = "rank", max_iter: int = 10, sep: str = ",",
          seed: int = 42) -> tuple[models.ModelBundle, DataFrame]:
    df = load_training(spark, csv_path, sep)
    bundle = flows.train_gbt(df, HOUSE_CATEGORICAL, HOUSE_NUMERIC, HOUSE_LABEL,
                             label_mode=label_mode, max_iter=max_iter,
                             fill={"LotFrontage": LOT_FRONTAGE_DEFAULT}, seed=seed)
    if model_path:
        bundle.save(model_path)
    return bundle, evaluate.report(bundle.score(df), "predicted", HOUSE_LABEL)


def serve(spark: SparkSession, stream_dir: str, out_path: str, model_path: str, checkpoint: str,
          sep: str = ",", trigger="available_now", max_files_per_trigger: int | None = None,
          null_key: str = "default", out_store: tuple[str, dict] | None = None):
    """Start the scorer. ``out_store = (format, options)`` upserts into a
    connector-backed store instead of the keyed table at ``out_path``."""
    bundle = models.load(spark, model_path)
    stream = files.stream_files(spark, stream_dir, house_stream_schema(), sep=sep,
                                max_files_per_trigger=max_files_per_trigger)
    cleaned = flows.clean_stream(stream, {"LotFrontage": "float", "Id": "int"},
                                 {"LotFrontage": LOT_FRONTAGE_DEFAULT}, key="Id",
                                 key_mode=null_key)
    step = flows.ScoreOnly(bundle, "Id", out_path, house_predictions_table(),
                           output={"id": "Id", "saleprice": "predicted"},
                           writer=external.store_writer(out_store[0], out_store[1],
                                                        house_predictions_table())
                           if out_store else None)
    return flows.score_stream(cleaned, step, checkpoint, trigger)


def predictions(spark: SparkSession, out_path: str) -> DataFrame:
    return keyed.read_table(spark, out_path, house_predictions_table())
