"""Composite flows (C01-C05 S14 T06 T10 T11): operators wired together.

Per micro-batch the scoring flows run one aggregation of the batch, one
history lookup by its keys, one merge, the model transform and one write.
Nothing is collected to the driver.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean, envelope, features as feat, merge, models
from ..schemas import TableSpec
from ..session import parallelism
from ..sources import external, keyed, log
from ..streaming.runner import batch_scope, current_run_id, run_batches


# --- training (C01 C02) ----------------------------------------------------------

def train_linear(train_df: DataFrame, features: Sequence[str], label: str,
                 label_mode: str = "value", max_iter: int = 10, reg_param: float = 0.0,
                 fill: float | None = 0.0) -> models.ModelBundle:
    """Linear model on numeric features (C01). ``fill`` replaces missing
    feature values inside the pipeline (regressors reject NaN)."""
    stages = []
    cols = list(features)
    if fill is not None:
        stages.append(feat.constant_fill({c: fill for c in cols}))
        cols = [f"{c}__filled" for c in cols]
    stages += [feat.assemble(cols), models.linear(max_iter=max_iter, reg_param=reg_param)]
    return models.train(train_df, stages, label, label_mode)


def train_gbt(train_df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str,
              label_mode: str = "value", max_iter: int = 10, impute: str = "mean",
              fill: Mapping[str, float] | None = None, seed: int = 42,
              partitions: int | None = None) -> models.ModelBundle:
    """Gradient-boosted trees on text categories + numerics.

    Optional constant fills (e.g. a lot-frontage default) run inside the
    pipeline, then mean imputation for the remaining gaps, so training and
    serving treat missing values the same way."""
    cat_stages, vecs = feat.categorical(categorical)
    stages = list(cat_stages)
    nums = list(numeric)
    if fill:
        stages.append(feat.constant_fill(fill))
        nums = [f"{c}__filled" if c in fill else c for c in nums]
    stages.append(feat.numeric_as_double(nums, suffix="__dbl"))
    dbl = [f"{c}__dbl" for c in nums]
    imp, imputed = feat.impute(dbl, strategy=impute)
    stages += [imp, feat.assemble([*vecs, *imputed]),
               models.gbt(max_iter=max_iter, seed=seed)]
    if partitions is None:
        partitions = parallelism(train_df.sparkSession)
    return models.train(train_df, stages, label, label_mode, partitions=partitions)


def train_and_evaluate(df: DataFrame, holdout, fit_fn, label: str, digits: int | None = None):
    """Fit on the rows outside ``holdout`` and report RMSE on both parts.

    ``fit_fn(train_df) -> ModelBundle``. Returns ``(bundle, report)`` where
    ``report`` has one row per part: ``part, rmse, n_scored``.
    """
    from ..operators import evaluate
    train_df, test_df = evaluate.split_by(df, holdout)
    bundle = fit_fn(train_df)
    parts = []
    for name, part in (("train", train_df), ("holdout", test_df)):
        r = evaluate.rmse(bundle.score(part), "predicted", label, digits)
        parts.append(r.select(F.lit(name).alias("part"), "rmse", "n_scored"))
    return bundle, parts[0].unionByName(parts[1])


# --- history -----------------------------------------------------------------------

def seed_history(df: DataFrame, table_path: str, spec: TableSpec, run_id: str | None = None) -> None:
    """Append stored history to a keyed table (S14). Every call is an append of its
    own, as an upsert by key: keys of earlier loads stay, and so do columns that
    this load does not name."""
    run = run_id or f"seed-{uuid.uuid4().hex}"
    keyed.upsert(df, table_path, spec, epoch=0, run_id=run, dedupe_rule="max", strict=False)


# --- per-batch logic ---------------------------------------------------------------

_LOG = logging.getLogger(__name__)


@dataclass
class MergeScore:
    """The per-micro-batch function of the history-enriched scorers.

    Rows without a key (a malformed message decodes to nulls) are set aside under
    ``{table_path}_quarantine`` and counted in ``set_aside`` unless ``null_key`` says
    otherwise."""

    # stored history read by the batch's keys, or a frame factory re-read per batch
    history: Callable[[SparkSession], DataFrame] | keyed.KeyedHistory | external.StoreHistory
    bundle: models.ModelBundle
    key: str
    batch_features: Sequence[str]
    history_features: Sequence[str]
    table_path: str
    spec: TableSpec
    absent: float | None = 0.0
    prediction_col: str = "prediction"
    null_key: str = "quarantine"     # quarantine (kept aside) | default (-> 0) | drop
    # output writer (df, epoch); default: replay-safe upsert into ``table_path``
    writer: Callable[[DataFrame, int], None] | None = None
    # rows set aside, by (run, epoch): a replayed epoch counts once
    aside: dict[tuple[str, int], int] = field(default_factory=dict, init=False)

    @property
    def set_aside(self) -> int:
        return sum(self.aside.values())

    def __call__(self, df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        if self.null_key != "quarantine":
            df = clean.null_key(df, self.key, self.null_key)
        with batch_scope(merge.reduce_max(df, self.key, self.batch_features)) as reduced:
            if self.null_key == "quarantine":
                # the null key is one of the groups: the batch is read again only if it is there
                if not clean.null_key(reduced, self.key, "quarantine").isEmpty():
                    self._set_aside(df, epoch)
                keyed_rows = clean.null_key(reduced, self.key, "drop")
            else:
                keyed_rows = reduced
            if keyed_rows.isEmpty():      # header-only file / empty trigger
                return
            if hasattr(self.history, "lookup"):
                hist = self.history.lookup(spark, keyed_rows.select(self.key))
            else:
                hist = self.history(spark)
            merged = merge.merge_max(df, hist, self.key, self.batch_features,
                                     self.history_features, absent=self.absent, reduced=keyed_rows)
            scored = self.bundle.score(merged, out=self.prediction_col)
            if self.writer is not None:
                self.writer(self.spec.conform(scored), epoch)
            else:
                keyed.upsert(scored, self.table_path, self.spec, epoch,
                             run_id=current_run_id(spark), dedupe_rule="none")

    def _set_aside(self, df: DataFrame, epoch: int) -> None:
        if not self.table_path:
            raise ValueError("rows without a key need a table_path beside which to set them aside")
        run = current_run_id(df.sparkSession)
        where = f"{self.table_path.rstrip('/')}_quarantine/run={run}/epoch={epoch}"
        clean.null_key(df, self.key, "quarantine").write.mode("overwrite").parquet(where)
        n = df.sparkSession.read.parquet(where).count()
        self.aside[run, epoch] = n
        _LOG.warning("epoch %s: %s rows without %s set aside in %s", epoch, n, self.key, where)


def score_with_history(stream: DataFrame, step: MergeScore, checkpoint: str,
                       trigger="available_now") -> StreamingQuery:
    """File stream -> reduce per key -> merge with history -> score -> upsert."""
    return run_batches(stream, step, checkpoint, trigger)


def relay_to_log(stream: DataFrame, log_path: str, checkpoint: str, columns=None,
                 fmt: str = "json", trigger="available_now", format: str = "files",
                 options=None, name: str | None = None) -> StreamingQuery:
    """First half of C03: publish a stream's rows to the log."""
    return log.publish(stream, log_path, checkpoint, columns=columns, fmt=fmt,
                       trigger=trigger, format=format, options=options, name=name)


def parse_log(spark: SparkSession, log_path: str, schema, fmt: str = "json",
              max_per_trigger: int | None = None, format: str = "files") -> DataFrame:
    """Second half's source: log -> typed rows + offset."""
    raw = log.subscribe(spark, log_path, format=format, max_per_trigger=max_per_trigger)
    return envelope.decode(raw, schema, fmt=fmt)


@dataclass
class ScoreOnly:
    """Per-batch function of the direct scorer (C05): clean, score, upsert."""

    bundle: models.ModelBundle
    key: str
    table_path: str
    spec: TableSpec
    output: Mapping[str, str]        # table column -> frame column
    dedupe_rule: str = "max"
    writer: Callable[[DataFrame, int], None] | None = None
    small: bool = False              # the intake bounds a batch's rows: a slice is one file

    def __call__(self, df: DataFrame, epoch: int) -> None:
        scored = self.bundle.score(df)
        out = scored.select(*[F.col(f"`{src}`").alias(dst) for dst, src in self.output.items()])
        if self.writer is not None:
            self.writer(keyed.dedupe(self.spec.conform(out), self.spec, self.dedupe_rule), epoch)
            return
        keyed.upsert(out, self.table_path, self.spec, epoch,
                     run_id=current_run_id(df.sparkSession), dedupe_rule=self.dedupe_rule, small=self.small)


@dataclass
class RejectAside:
    """A batch function with a second sink: rows whose ``column`` holds the raw text of a
    malformed line go to ``path``, the others (without that column) to ``step``. Both sinks
    are written by (run, epoch), so a replayed epoch leaves one copy in each."""

    step: Callable[[DataFrame, int], None]
    column: str
    path: str

    def __call__(self, df: DataFrame, epoch: int) -> None:
        bad = F.col(f"`{self.column}`")
        where = f"{self.path.rstrip('/')}/run={current_run_id(df.sparkSession)}/epoch={epoch}"
        with batch_scope(df) as rows:   # two sinks, one parse
            rows.where(bad.isNotNull()).select(bad.alias("raw")).write.mode("overwrite").parquet(where)
            self.step(rows.where(bad.isNull()).drop(self.column), epoch)


def clean_stream(stream: DataFrame, casts: Mapping[str, str], fills: Mapping[str, object],
                 key: str, key_mode: str = "default") -> DataFrame:
    """Stateless typing of a text-heavy stream (T09): try-casts, fills, null key."""
    out = clean.cast_columns(stream, casts)
    if fills:
        out = clean.fill(out, by_column=fills)
    return clean.null_key(out, key, mode=key_mode, default=0)


def score_stream(stream: DataFrame, step: ScoreOnly, checkpoint: str,
                 trigger="available_now", name: str | None = None) -> StreamingQuery:
    """CSV stream -> clean -> score -> upsert id + prediction."""
    return run_batches(stream, step, checkpoint, trigger, name)
