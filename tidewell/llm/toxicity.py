"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

* Features: how densely a text holds its character n-grams (3 to 5, ASCII lower
  case, white space as blanks), hashed to ``2 ** bits`` slots: occurrences per
  1000 characters, damped for short texts by ``extra_chars``. Abuse is a matter
  of density here: harmless texts hold the odd such word, more so long ones.
* Ratios: r = log of (smoothed share of the toxic texts' density in the slot)
  over (that of the others); slots in fewer than ``min_texts`` texts or with a
  ratio below ``neutral`` get 0.
* Model: logistic regression on density * r, full-batch Adam with L2, trained
  in one task on a sample of at most ``max_per_class`` labelled rows a class
  (smallest hashes of doc_id; the bound is this parameter).
* Scoring: every whole text where it is read; what tasks carry is the weight
  table, 4 * 2 ** bits bytes at any corpus size.

Labels are used only from rows whose crc32(doc_id as text) mod 3 is not 1, and
only for training. Defined cases: null and empty texts get the model's bias; very
long texts are scored whole, a slice of their own; repeated rows get equal scores
and train once a doc_id; a null doc_id is not held out; labels other than 0 and 1,
null ids and ids with contradicting labels do not train; without both classes, as with
empty labels, every score is 0; an empty table gives no rows; extra columns pass
through ``keep_clean``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .cut import free_prefix


@dataclass(frozen=True)
class ToxicitySpec:
    bits: int = 19
    grams: tuple[int, ...] = (3, 4, 5)
    max_per_class: int = 1500
    neutral: float = 0.2
    min_texts: int = 3
    smoothing: float = 1.0
    extra_chars: int = 600
    l2: float = 1e-3
    steps: int = 120
    threshold: float = 0.7


#: texts whose features the fit holds apart at once
FIT_TEXTS = 250

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[0x41:0x5B] += 0x20
_CLEAN[0x09:0x0E] = 0x20


def gram_slots(data: np.ndarray, offs: np.ndarray, spec: ToxicitySpec):
    """``(slot, row)`` arrays of all n-grams per size, and each row's characters."""
    clean = _CLEAN[data]
    chars = np.frombuffer(clean.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    before = np.concatenate([[0], np.cumsum((clean & 0xC0) != 0x80)])
    at = before[offs]
    length = np.diff(at)
    row = np.repeat(np.arange(len(length)), length)
    shift = np.uint64(64 - spec.bits)
    found = []
    h = chars * np.uint64(0xBF58476D1CE4E5B9)
    for n in range(2, max(spec.grams) + 1):
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + chars[n - 1:]
        if n in spec.grams and len(h):
            inside = row[:len(h)] == row[n - 1:]
            mixed = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            found.append(((mixed >> shift).astype(np.int64)[inside], row[:len(h)][inside]))
    return found, length


def density(count: np.ndarray, chars: np.ndarray, spec: ToxicitySpec) -> np.ndarray:
    return 1000.0 * count / (chars + spec.extra_chars)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec) -> DataFrame:
    """doc_id, toxic, text of the bounded sample."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")) \
        .filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()) \
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")) \
        .filter("toxic = most").select("doc_id", "toxic")
    known = known.join(docs.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
    few = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.max_per_class)
           for c in (0, 1)]
    picked = few[0].unionByName(few[1])
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # 2 * max_per_class rows of two numbers
    return texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec()) -> tuple[bytes, float]:
    """Weight table (float32 bytes) and bias."""
    def features(batches):
        size = 1 << spec.bits
        for batch in batches:
            slots, values = [], []
            for lo, hi, data, offs in tb.column_slices(batch, 1):
                found, chars = gram_slots(data, offs, spec)
                key = np.concatenate([r * size + s for s, r in found] or [np.zeros(0, np.int64)])
                key, count = np.unique(key, return_counts=True)
                row = key // size
                x = density(count, chars[row], spec).astype(np.float32)
                slot = (key % size).astype(np.int32)
                at = tb.runs(row, hi - lo)
                slots.extend(slot[a:b].tobytes() for a, b in zip(at[:-1], at[1:]))
                values.extend(x[a:b].tobytes() for a, b in zip(at[:-1], at[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(slots, pa.binary()), pa.array(values, pa.binary())],
                names=["toxic", "slots", "x"])

    def fit(batches):
        y, rows, x = [], [], []
        for batch in batches:
            y.extend(batch.column(0).to_pylist())
            rows.extend(np.frombuffer(v.as_buffer(), np.int32) for v in batch.column(1))
            x.extend(np.frombuffer(v.as_buffer(), np.float32) for v in batch.column(2))
        if not y:
            rows, x = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        w, bias = fit_ratios(np.array(y, float), rows, x, spec)
        tb.give_back()
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()]), pa.array([bias])], names=["w", "bias"])

    sample = training_rows(docs, labels, spec).select("toxic", "text") \
        .mapInArrow(features, "toxic int, slots binary, x binary")
    model = sample.coalesce(1).mapInArrow(fit, "w binary, bias double").first()
    return bytes(model["w"]), model["bias"]


def fit_ratios(y: np.ndarray, rows: list[np.ndarray], x: list[np.ndarray],
               spec: ToxicitySpec) -> tuple[np.ndarray, float]:
    """Ratios, then logistic regression on density times ratio; one table of products."""
    size = 1 << spec.bits
    if not len(y) or y.min() == y.max():
        return np.zeros(size, np.float32), -np.inf
    blocks = [slice(k, k + FIT_TEXTS) for k in range(0, len(y), FIT_TEXTS)]
    sums, texts = [np.zeros(size), np.zeros(size)], np.zeros(size, np.int64)
    for b in blocks:
        row = np.repeat(y[b] == 1, [len(r) for r in rows[b]])
        idx, val = np.concatenate(rows[b]), np.concatenate(x[b])
        for side, own in ((0, row), (1, ~row)):
            sums[side] += np.bincount(idx[own], weights=val[own], minlength=size)
        texts += np.bincount(idx, minlength=size)
    p, q = sums[0] / y.sum(), sums[1] / (1 - y).sum()
    low = spec.smoothing / len(y)
    r = np.log((p + low) / (q + low))
    r[texts < spec.min_texts] = 0.0
    r[np.abs(r) < spec.neutral] = 0.0
    # from here on only slots with a ratio, block by block; the sample is let go on the way
    used = np.flatnonzero(r)
    place, size = np.full(len(r), -1, np.int32), len(used)
    place[used] = np.arange(size, dtype=np.int32)
    held = []
    for b in blocks:
        row = np.repeat(np.arange(len(rows[b]), dtype=np.int16), [len(t) for t in rows[b]])
        idx, val = np.concatenate(rows[b]), np.concatenate(x[b])
        rows[b], x[b] = [None] * len(rows[b]), [None] * len(x[b])
        keep = place[idx] >= 0
        held.append((b, place[idx[keep]], row[keep], val[keep] * r[idx[keep]].astype(np.float32)))
    # classes weigh alike, whatever their share of the sample
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    v, bias = np.zeros(size), 0.0
    m, s, mb, sb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, spec.steps + 1):
        g, gb, w32 = spec.l2 * v, 0.0, v.astype(np.float32)
        for b, idx, row, val in held:
            n = len(y[b])
            z = np.bincount(row, weights=w32[idx] * val, minlength=n) + bias
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[b]) * each[b]
            g += np.bincount(idx, weights=err.astype(np.float32)[row] * val, minlength=size)
            gb += err.sum()
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        rate = 0.02
        v -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-6)
        bias -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(sb / (1 - 0.99 ** t)) + 1e-6)
    w = np.zeros(len(r), np.float32)
    w[used] = v * r[used]
    return w, float(bias)


def score(docs: DataFrame, model: tuple[bytes, float], spec: ToxicitySpec = ToxicitySpec(),
          out: str = "tox_score") -> DataFrame:
    """The columns of ``docs`` and ``out`` (0 to 1), which must not be among them."""
    names = docs.columns
    at = names.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        raw, bias = sent.value
        w = np.frombuffer(raw, np.float32)
        for batch in batches:
            z = np.full(batch.num_rows, bias)
            for lo, hi, data, offs in tb.column_slices(batch, at):
                found, chars = gram_slots(data, offs, spec)
                for slot, row in found:
                    total = np.bincount(row, weights=w[slot], minlength=hi - lo)
                    z[lo:hi] += density(total, chars, spec)
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            p[np.isneginf(z)] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*names, out])

    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score(slim, train(docs, labels, spec), spec).select(
        "doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= spec.threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """The documents below the threshold, with their columns."""
    out = free_prefix(docs.columns, "tox_score")
    return score(docs, train(docs, labels, spec), spec, out).filter(F.col(out) < spec.threshold).drop(out)
