"""Importance resampling towards a target: hashed n-gram features, Gumbel top-k.

A text's features are its runs of 1 to ``longest`` words, repeats counted; a
feature's bucket is the crc32 of its bytes modulo ``buckets``. A bucket's gain is the
scaled, smoothed log ratio of its share in the target to its share in the source, a
document's weight the mean gain of its features. Adding a Gumbel to every weight
and taking the highest draws without replacement, in proportion to exp(weight).

1. Tasks intern the n-grams of a slice of texts in an open-addressed table
   (``interning``: xxhash64 keys, bytes verified), whose slots hold bucket and
   count; counts are summed by bucket within the task, so a task sends at most
   ``buckets`` rows and a hot source or word costs nothing more.
2. The gains (``buckets`` numbers, the bound of what is broadcast) go to all tasks.
   A second pass interns again; every occurrence's slot gathers its gain.
3. Documents with at least ``least_words`` words are numbered by score with a
   distributed sort; the first ``share_pct`` percent are drawn.

Defined cases: a null, empty or word-less text has no features, weight 0 and is not
drawn; very long texts are taken whole, as a slice of their own; repeated rows
are documents of their own with equal scores (ties go to the smaller doc_id, then to
fewer features; equal rows share what ranks they get); a null doc_id counts as the
empty text in the hash and comes last among ties; an empty source gives no rows, an
empty target is all smoothing. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from . import textbytes as tb
from .cut import cut
from .interning import Interned


@dataclass(frozen=True)
class ResampleSpec:
    longest: int = 1
    buckets: int = 10_000
    share_pct: int = 10
    least_words: int = 20
    seed: int = 2024


def ngrams(data: np.ndarray, offs: np.ndarray, longest: int):
    """Words joined by single blanks, and the ranges and rows of their runs:
    (bytes, starts, ends, rows, words per row)."""
    low = tb.lower_ascii(data)
    starts, ends, rows = tb.word_bounds(low, offs, tb.ALNUM_WORD)
    size = ends - starts
    # each word keeps the byte behind it, which becomes the blank
    to = np.cumsum(size + 1) - size - 1
    take = np.repeat(starts - to, size + 1) + np.arange(int((size + 1).sum()))
    flat = np.append(low, np.uint8(0x20))[take]
    flat[to + size] = 0x20
    n = len(size)
    last = np.searchsorted(rows, rows, side="right")      # behind the row's last word
    parts = [(to, to + size, rows)]
    for k in range(1, longest):
        at = np.flatnonzero(np.arange(n) + k < last)
        parts.append((to[at], to[at + k] + size[at + k], rows[at]))
    a, b, r = (np.concatenate(x) for x in zip(*parts))
    return flat, a, b, r, np.bincount(rows, minlength=len(offs) - 1)


def bucket_counts(texts: DataFrame, spec: ResampleSpec = ResampleSpec()) -> DataFrame:
    """bucket, n over all features of ``text``."""
    def run(batches):
        total = np.zeros(spec.buckets, np.int64)
        for batch in batches:
            for _, _, data, offs in tb.column_slices(batch, 0):
                flat, a, b, _, _ = ngrams(data, offs, spec.longest)
                t = Interned(flat, a, b, spec.buckets)
                np.add.at(total, t.bucket[t.used], t.count[t.used])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, spec: ResampleSpec = ResampleSpec()) -> np.ndarray:
    """The gain of every bucket (``buckets`` longs)."""
    def held(frame):
        got = bucket_counts(frame, spec).toArrow()
        n = np.zeros(spec.buckets)
        n[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
        return n

    s, t, b = held(source), held(target), float(spec.buckets)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, spec: ResampleSpec = ResampleSpec()) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for lo, hi, data, offs in tb.column_slices(batch, 1):
                flat, a, b, rows, n_words[lo:hi] = ngrams(data, offs, spec.longest)
                t = Interned(flat, a, b, spec.buckets)
                gain = sent.value[t.bucket]                     # per slot
                held = np.bincount(rows, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, rows, gain[t.slot])            # per occurrence
                n_features[lo:hi] = held
                weight[lo:hi] = total // np.maximum(held, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, spec: ResampleSpec = ResampleSpec()) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every document.

    ``docs``: doc_id, text; ``target``: text."""
    weighed = weigh(docs, bucket_gains(docs, target, spec), spec)
    key = F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = cut(weighed.withColumn("score", F.col("weight") + gumbel))
    able = scored.filter(F.col("n_words") >= spec.least_words)
    k = spec.share_pct * able.count() // 100
    placed = global_row_number(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                                      F.col("n_features").asc()], "rank", base=1) \
        .withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    rest = scored.filter(F.col("n_words") < spec.least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


#: One row per document (DuckDB); crc32 by a table made from its polynomial.
ORACLE = r"""
with recursive bits(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
crc as (select list(c order by i) as t from bits where k = 8),
d as (select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
ds as (select row, unnest(w) as w from d), bs as (select unnest(w) as w from b),
voc as (select distinct w from (select w from ds union all select w from bs)),
v as (select w, xor(list_reduce(list_prepend(cast(4294967295 as bigint),
    list_transform(range(1, strlen(w) + 1), lambda i: cast('0x' || substr(hex(w), 2 * i - 1, 2) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from voc, crc),
s as (select bucket, count(*) as n from ds join v using (w) group by 1),
t as (select bucket, count(*) as n from bs join v using (w) group by 1),
g as (select r.range as bucket, cast(floor(1000 * ln((cast(coalesce(t.n, 0) + 1 as double)
    * (coalesce((select sum(n) from s), 0) + 10000)) / (cast(coalesce(s.n, 0) + 1 as double)
    * (coalesce((select sum(n) from t), 0) + 10000)))) as bigint) as gain
  from range(10000) r left join s on s.bucket = r.range left join t on t.bucket = r.range),
f as (select row, count(*) as n_features, sum(gain) as total from ds join v using (w) join g using (bucket) group by 1),
x as (select d.doc_id, coalesce(n_features, 0) as n_features,
    coalesce(cast(floor(cast(total as double) / n_features) as bigint), 0) as weight,
    cast('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) as bigint) as h from d left join f on f.row = d.row),
y as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from x),
z as (select doc_id, row_number() over (order by score desc, doc_id) as rank from y where n_features >= 20)
select y.doc_id, n_features, weight, score,
  case when rank <= 10 * (select count(*) from z) // 100 then rank end as rank
from y left join z on z.doc_id = y.doc_id"""
