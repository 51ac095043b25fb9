"""Mixing sources to target weights by blocks, multinomial draws and permutations.

1. Each source's words are packed, in a hash order of its documents, into
   blocks of ``block_words`` words (the last one may be shorter). Offsets come
   from a two-level prefix sum (chunks within a source, then rows within a
   chunk), so a source holding a third of all rows is spread over its chunks.
2. Targets: weights cycle over the sources by code point, null last, and share
   all words; a target stops at ``max_passes`` times its source, the excess goes
   to the others by weight until none is above (the water level has a closed
   form over the sources sorted by cap / weight).
3. The output is cut into shards of ``shard_slots`` block slots. Per shard the
   whole part of each source's expected slots is fixed and the remainder is one
   multinomial draw, seeded by the shard.
4. The k-th slot of a source is pass ``k // blocks`` and block
   ``perm(k % blocks)`` under a keyed permutation per source and pass, so a pass
   never repeats a block. Slots join blocks on (source, index).

Defined cases: null or empty text has size 0 and is never taken; null doc_id is
kept as a row; repeated rows each take their own place; an empty table gives an
empty result; columns beyond doc_id, text and source are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .cut import cut, free_prefix


@dataclass(frozen=True)
class MixSpec:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_passes: int = 3
    block_words: int = 32
    shard_slots: int = 1 << 20
    chunks: int = 4096
    seed: int = 7


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text) and a hash of the text."""
    def count(batches):
        ph = tb.PolyHash(61)
        for b in batches:
            size = np.zeros(b.num_rows, np.int64)
            digest = np.zeros(b.num_rows, np.int64)
            for lo, hi, data, offs in tb.column_slices(b, 2):
                _, _, rows = tb.word_bounds(data, offs, tb.SPACED_WORD)
                size[lo:hi] = np.bincount(rows, minlength=hi - lo)
                digest[lo:hi] = ph.ranges(ph.prefix(data), offs[:-1], offs[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size), pa.array(digest)],
                names=["doc_id", "source", "size", "digest"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       F.col("text").cast("string")) \
        .mapInArrow(count, "doc_id long, source string, size long, digest long")


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """One row per source: ``src`` (rank by code point, null last), weight, size, target."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # a window over one row per source, not over documents
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("src", F.row_number().over(everything) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in spec.weights]),
                          (F.col("src") % len(spec.weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight) \
        .withColumn("cap", F.col("source_size") * F.lit(float(spec.max_passes)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src")) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    lv = ranked.withColumn("level", level) \
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the level falls from the first source that stays below its cap on
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(whole)
    return lv.withColumn("target", F.when(F.col("capped"), F.col("cap"))
                         .otherwise(F.least("cap", F.col("weight") * final))) \
        .select("source", F.col("src").cast("long").alias("src"), "weight", "source_size", "target")


def place(sizes: DataFrame, targets: DataFrame, spec: MixSpec) -> DataFrame:
    """Each row's word offset within its source (``pos``)."""
    keyed = sizes.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(spec.chunks)))
    sums = keyed.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source", "chunk", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    named = targets.withColumnRenamed("source", "t_source")
    base = base.join(named, F.col("source").eqNullSafe(F.col("t_source"))) \
        .select(F.col("source").alias("b_source"), F.col("chunk").alias("b_chunk"), "base",
                "src", "source_size", "target")
    rows = Window.partitionBy("source", "chunk").orderBy("doc_id", "digest", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    inner = keyed.withColumn("within", F.coalesce(F.sum("size").over(rows), F.lit(0)))
    return inner.join(base, F.col("source").eqNullSafe(F.col("b_source"))
                      & (F.col("chunk") == F.col("b_chunk"))) \
        .select("doc_id", "digest", "source", "src", "size", "source_size", "target",
                (F.col("base") + F.col("within")).alias("pos"))


def draw_slots(targets: DataFrame, spec: MixSpec) -> DataFrame:
    """Block slots drawn per source: src, blocks, pass (``turn``) and block index."""
    wanted = targets.filter("source_size > 0 and target > 0") \
        .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(spec.block_words)).cast("long")) \
        .withColumn("want", F.col("target") * F.col("blocks") / F.col("source_size"))
    # one row: the sources (their number is the bound) and the total; shards follow from it
    whole = wanted.agg(F.sum("want").alias("total"), F.sort_array(F.collect_list(
        F.struct("src", "blocks", "want"))).alias("sources")).filter("total > 0")
    shards = whole.select("total", "sources", F.explode(F.sequence(
        F.lit(0).cast("long"), F.ceil(F.col("total") / spec.shard_slots).cast("long") - 1)).alias("shard"))
    seed = spec.seed

    def draw(frames):
        for pdf in frames:
            for shard, total, sources in zip(pdf["shard"], pdf["total"], pdf["sources"]):
                src, blocks, want = (np.array([x[k] for x in sources]) for k in ("src", "blocks", "want"))
                slots = min(float(spec.shard_slots), total - shard * float(spec.shard_slots))
                expected = slots * want / total
                base = np.floor(expected + 1e-9)
                frac = np.clip(expected - base, 0.0, None)
                rest = int(round(slots - base.sum()))
                extra = np.zeros(len(src), np.int64)
                if rest > 0 and frac.sum() > 0:
                    extra = np.random.default_rng([seed, int(shard)]).multinomial(rest, frac / frac.sum())
                yield pd.DataFrame({"src": src, "shard": shard, "blocks": blocks,
                                    "n": (base + extra).astype("int64")})

    counts = shards.mapInPandas(draw, "src long, shard long, blocks long, n long")
    ahead = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0))) \
        .withColumn("stop", F.least(F.col("first") + F.col("n"), F.col("blocks") * spec.max_passes)) \
        .filter("stop > first")
    step = 1 << 14
    pieces = spans.select("src", "blocks", "stop", F.explode(
        F.sequence("first", F.col("stop") - 1, F.lit(step).cast("long"))).alias("lo")) \
        .select("src", "blocks", "lo", F.least(F.col("lo") + step, "stop").alias("hi")) \
        .repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "src", "lo")
    slots = pieces.select("src", "blocks", F.explode(
        F.sequence("lo", F.col("hi") - 1)).alias("slot"))

    def permute(frames):
        for pdf in frames:
            n = pdf["blocks"].to_numpy()
            turn = pdf["slot"].to_numpy() // n
            idx = keyed_permutation(pdf["slot"].to_numpy() % n, n,
                                    pdf["src"].to_numpy() * np.int64(1009) + turn, seed)
            yield pd.DataFrame({"src": pdf["src"], "turn": turn, "idx": idx})

    return slots.mapInPandas(permute, "src long, turn long, idx long")


def keyed_permutation(x: np.ndarray, n: np.ndarray, key: np.ndarray, seed: int) -> np.ndarray:
    """Permutation of ``range(n)`` per key: four Feistel rounds on the next even
    power of two, walking the cycle until the value is below ``n``."""
    x, n = x.astype(np.uint64), n.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(2, n).astype(np.float64) + 0.5)).astype(np.uint64)
                          + np.uint64(1)) // np.uint64(2)).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    salt = tb.mix64(key.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        a, b = out[todo] >> half[todo], out[todo] & low[todo]
        for r in range(4):
            f = tb.mix64(b ^ tb.mix64(salt[todo] + np.uint64(r))) & low[todo]
            a, b = b, a ^ f
        out[todo] = (a << half[todo]) | b
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    placed, slots = _blocks_and_slots(docs, spec)
    times = slots.groupBy("src", "idx").agg(F.count("*").alias("times"))
    # the planner takes an exploded sequence for small; it is as large as the corpus has blocks
    hit = placed.join(times.hint("merge"), ["src", "idx"], "left")
    return hit.groupBy("src", "pos", "doc_id", "digest", "copy") \
        .agg(F.first("size").alias("size"), F.first("source_size").alias("source_size"),
             F.first("target").alias("target"),
             F.sum(F.coalesce(F.col("times"), F.lit(0)) * F.col("words")).alias("taken")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def _blocks_and_slots(docs: DataFrame, spec: MixSpec) -> tuple[DataFrame, DataFrame]:
    sizes = cut(word_sizes(docs))  # 32 bytes a row, read four times
    targets = cut(source_targets(sizes, spec))  # one row per source
    placed = place(sizes, targets, spec)
    b = F.lit(spec.block_words).cast("long")
    ids = F.when(F.col("size") > 0, F.sequence(
        F.floor(F.col("pos") / b), F.floor((F.col("pos") + F.col("size") - 1) / b)))
    # empty rows share a position: number them apart so that each stays a row
    parts = placed.withColumn("copy", F.when(F.col("size") > 0, F.lit(0))
                              .otherwise(F.monotonically_increasing_id())) \
        .withColumn("idx", F.explode_outer(ids))
    words = F.when(F.col("idx").isNull(), F.lit(0)).otherwise(
        F.least(F.col("pos") + F.col("size"), (F.col("idx") + 1) * b)
        - F.greatest(F.col("pos"), F.col("idx") * b))
    return parts.withColumn("words", words), draw_slots(targets, spec)


def mixed_texts(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per document and pass
    that takes any of its words. ``text`` holds the words taken: the whole text
    where all are, else the taken spans joined by spaces; ``n_chars``, if there,
    follows it. A document the mix takes nothing of has no row."""
    placed, slots = _blocks_and_slots(docs, spec)
    names = docs.columns
    own = free_prefix(names, "m_")
    b = F.lit(spec.block_words).cast("long")
    lo = F.greatest(F.col("pos"), F.col("idx") * b) - F.col("pos")
    taken = placed.filter("idx is not null").join(slots.hint("merge"), ["src", "idx"]) \
        .groupBy("doc_id", "digest", "source", "pos", "turn") \
        .agg(F.sort_array(F.collect_list(F.struct(lo.alias("lo"), (lo + F.col("words")).alias("hi")))).alias("s")) \
        .select(F.col("doc_id").alias(own + "id"), F.col("digest").alias(own + "digest"),
                F.col("source").alias(own + "source"), F.col("s.lo").alias(own + "lo"), F.col("s.hi").alias(own + "hi"))
    at = names.index("text")

    def with_digest(batches):
        ph = tb.PolyHash(61)
        for batch in batches:
            digest = np.zeros(batch.num_rows, np.int64)
            for first, last, data, offs in tb.column_slices(batch, at):
                digest[first:last] = ph.ranges(ph.prefix(data), offs[:-1], offs[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest)], names=[*names, own + "key"])

    def cut_texts(batches):
        for batch in batches:
            texts = []
            los, his = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            for first, last, data, offs in tb.column_slices(batch, at):
                raw = data.tobytes()
                starts, ends, rows = tb.word_bounds(data, offs, tb.SPACED_WORD)
                begin = tb.runs(rows, last - first)
                for r in range(last - first):
                    spans = []
                    for x, y in zip(los[first + r], his[first + r]):
                        if spans and spans[-1][1] == x:
                            spans[-1][1] = y
                        else:
                            spans.append([x, y])
                    if spans == [[0, begin[r + 1] - begin[r]]]:
                        texts.append(raw[offs[r]:offs[r + 1]].decode())
                    else:
                        k = begin[r]
                        texts.append(" ".join(raw[starts[k + x]:ends[k + y - 1]].decode() for x, y in spans))
            columns = [pa.array(texts, pa.string()) if n == "text"
                       else pa.array([len(t) for t in texts]).cast(batch.column(i).type) if n == "n_chars"
                       else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = docs.schema
    keyed = docs.mapInArrow(with_digest, _with(schema, own + "key long"))
    one = keyed.dropDuplicates(["doc_id", own + "key", "source"])
    joined = one.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col(own + "id"))
                      & (F.col(own + "key") == F.col(own + "digest"))
                      & F.col("source").eqNullSafe(F.col(own + "source")))
    return joined.select(*[f"`{c}`" for c in names], own + "lo", own + "hi").mapInArrow(cut_texts, schema)


def _with(schema, extra: str):
    from pyspark.sql.types import StructType
    return StructType([*schema.fields, *StructType.fromDDL(extra).fields])
