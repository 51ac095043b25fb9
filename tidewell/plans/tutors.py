"""The tutor workflow on its own CSV layout.

Train: all-text CSV read, float casts, linear regression on ten features with
the exam points as a frequency-rank label (``label_mode="rank"``, the original
behaviour) or as a plain value. Serve: a CSV directory of ``id, age,
years_of_experience, lesson_price`` rows, optionally relayed through a message
log, merged per id with the stored history table, scored and upserted into the
predictions table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, evaluate, models
from ..schemas import (TUTOR_FEATURES, TUTOR_HISTORY_DDL, TUTOR_LABEL, TUTOR_STREAM_DDL,
                       TUTOR_STREAM_FEATURES, struct, tutor_history_table,
                       tutor_predictions_table)
from ..sources import external, files, keyed
from . import flows


def load_training(spark: SparkSession, csv_path: str, sep: str = ",") -> DataFrame:
    raw = files.read_csv(spark, csv_path, sep=sep)
    casts = {"Id": "int", **{c: "float" for c in TUTOR_FEATURES}}
    return clean.cast_columns(raw, casts)   # the label stays text, as in the source


def train(spark: SparkSession, csv_path: str, model_path: str | None = None,
          label_mode: str = "rank", max_iter: int = 10, reg_param: float = 0.0,
          sep: str = ",") -> tuple[models.ModelBundle, DataFrame]:
    """Fit, optionally save, and return the bundle with its in-sample report."""
    df = load_training(spark, csv_path, sep)
    bundle = flows.train_linear(df, TUTOR_FEATURES, TUTOR_LABEL, label_mode=label_mode,
                                max_iter=max_iter, reg_param=reg_param)
    if model_path:
        bundle.save(model_path)
    scored = bundle.score(df)
    return bundle, evaluate.report(scored, "predicted", TUTOR_LABEL)


def seed_history(spark: SparkSession, csv_path: str, table_path: str, sep: str = ";") -> None:
    """Stored points (8 of the 11 columns) from CSV into the keyed history table."""
    rows = files.read_csv(spark, csv_path, schema=struct(TUTOR_HISTORY_DDL), sep=sep)
    flows.seed_history(rows, table_path, tutor_history_table())


def serve(spark: SparkSession, stream_dir: str, history_path: str, out_path: str,
          model_path: str, checkpoint: str, sep: str = ";", via_log: str | None = None,
          log_checkpoint: str | None = None, trigger="available_now",
          max_files_per_trigger: int | None = None, absent: float | None = 0.0,
          history_store: tuple[str, dict] | None = None,
          out_store: tuple[str, dict] | None = None, null_key: str = "quarantine") -> list:
    """Start the scorer (and the relay when ``via_log`` names a log); returns
    the started queries. ``absent=0.0`` keeps the original merge rule.

    ``history_store`` / ``out_store`` = ``(format, options)`` read the history
    from and upsert the predictions into a connector-backed store instead of
    the keyed tables at ``history_path`` / ``out_path``; rows without an id are set
    aside beside ``out_path``. With a processing-time trigger relay and scorer run
    side by side until the caller stops them (``runner.stop_queries``)."""
    bundle = models.load(spark, model_path)
    stream = files.stream_files(spark, stream_dir, struct(TUTOR_STREAM_DDL), sep=sep,
                                max_files_per_trigger=max_files_per_trigger)
    started = []
    if via_log:
        started.append(flows.relay_to_log(stream, via_log, log_checkpoint or f"{checkpoint}-relay",
                                          fmt="json", trigger=trigger))
        for q in started:          # available-now: the relay finishes first; live, both run
            if trigger == "available_now":
                from ..streaming.runner import await_done
                await_done(q)
        stream = flows.parse_log(spark, via_log, struct(TUTOR_STREAM_DDL),
                                 max_per_trigger=max_files_per_trigger)
    if history_store:
        fmt, opts = history_store
        history = external.StoreHistory(fmt, opts, tutor_history_table())
    else:
        history = keyed.KeyedHistory(history_path, tutor_history_table())
    writer = external.store_writer(out_store[0], out_store[1], tutor_predictions_table()) \
        if out_store else None
    step = flows.MergeScore(history=history, bundle=bundle, key="id",
                            batch_features=TUTOR_STREAM_FEATURES,
                            history_features=TUTOR_FEATURES, table_path=out_path,
                            spec=tutor_predictions_table(), absent=absent,
                            prediction_col=TUTOR_LABEL, writer=writer, null_key=null_key)
    started.append(flows.score_with_history(stream, step, checkpoint, trigger))
    return started


def predictions(spark: SparkSession, out_path: str) -> DataFrame:
    return keyed.read_table(spark, out_path, tutor_predictions_table())
