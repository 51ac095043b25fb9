"""Embedding near-dedup over small-world graphs per shard.

1. Equal vectors of a label form a class (smallest vec_id, number of rows): only
   classes are indexed, so copies cost no pairs.
2. A label's classes are dealt to shards of about ``shard_rows``; each shard's
   graph over unit vectors is one row of flat arrays in the checkpoint folder.
3. Every shard is searched with the vectors of every shard of its label (a pair
   of shards once). A query's beam doubles while all it holds is within the
   threshold; then ``audit`` queries per block, chosen by hash, are compared with
   the whole shard in double precision, and the block's beam doubles until none
   of them misses a link. A beam of a quarter of the shard gives way to comparing
   the block in full.
4. Links are cosines of at least ``threshold`` in double precision on the original
   vectors. A task returns each class's number of linked vectors and a spanning
   forest of its links; numbers are added up, forests united into components.

Defined cases: vectors null, empty, zero or with null or non-finite components,
rows without a label or a vec_id, and vectors of other dimensions link with
nothing (component_id = vec_id, n_links 0); equal rows link with each other;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import components, unite
from .cut import cut
from .hnsw import Graph, GraphSpec
from .vectors import INDEX_COLUMNS, index_row, matrix, packed, unit


@dataclass(frozen=True)
class EmbedSpec:
    threshold: float = 0.98
    shard_rows: int = 8192
    block: int = 512
    beam: int = 16
    audit: int = 16
    graph: GraphSpec = field(default_factory=GraphSpec)


class Shard:
    def __init__(self, r, prefix: str) -> None:
        get = lambda name: getattr(r, prefix + name)
        self.n = get("n")
        self.x = np.frombuffer(get("vectors"), "<f8").reshape(self.n, r.dim)
        self.ids = np.frombuffer(get("ids"), "<i8")
        self.sizes = np.frombuffer(get("sizes"), "<i8")
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.walk = unit(self.x).astype(np.float32)

    def graph(self, r, prefix: str) -> Graph:
        return Graph.from_flat(self.walk, getattr(r, prefix + "entry"), list(getattr(r, prefix + "widths")),
                               list(getattr(r, prefix + "levels")))


def _cosine(a: Shard, i: np.ndarray, b: Shard, j: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a.x[i], b.x[j]) / (a.norm[i] * b.norm[j])


def _whole(a: Shard, rows: np.ndarray, b: Shard, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All links of the rows with a shard, by comparing them in full."""
    near = (a.walk[rows] @ b.walk.T) >= threshold - 1e-4
    i, j = np.nonzero(near)
    ok = _cosine(a, rows[i], b, j) >= threshold
    return rows[i[ok]], j[ok]


def shard_links(a: Shard, b: Shard, graph: Graph, spec: EmbedSpec):
    """Blocks of links (rows of a, rows of b) found by searching b with all of a."""
    # squared distance of unit vectors at the threshold, with room for float32
    reach = 2 * (1 - spec.threshold) + 1e-4
    for lo in range(0, a.n, spec.block):
        rows = np.arange(lo, min(a.n, lo + spec.block))
        audited = rows[np.argsort(tb.mix64(a.ids[rows].view(np.uint64)), kind="stable")[:spec.audit]]
        want = set(zip(*(x.tolist() for x in _whole(a, audited, b, spec.threshold))))
        width = spec.beam
        todo, found = rows, []
        while True:
            if 4 * width >= b.n:
                found.append(_whole(a, todo, b, spec.threshold))
                break
            nodes, dist = graph.search(a.walk[todo], width)
            full = dist[:, -1] <= reach  # all it holds is near: there may be more
            i, k = np.nonzero((dist <= reach) & ~full[:, None])
            src, dst = todo[i], nodes[i, k]
            ok = _cosine(a, src, b, dst) >= spec.threshold
            found.append((src[ok], dst[ok]))
            todo = todo[full]
            width *= 2
            if not len(todo):
                seen = set(zip(np.concatenate([s for s, _ in found]).tolist(),
                               np.concatenate([d for _, d in found]).tolist()))
                if want <= seen:
                    break
                todo, found = rows, []  # the audit missed a link: the whole block again, wider
        yield (np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found]))


def _pair_frame(r, spec: EmbedSpec) -> pd.DataFrame:
    """Node sums and forest edges of one pair of shards."""
    a = Shard(r, "a_")
    same = r.shard_a == r.shard
    b = a if same else Shard(r, "b_")
    graph = b.graph(r, "b_")
    shift = 0 if same else a.n
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    linked = np.zeros(len(ids), np.int64)
    parent = np.arange(len(ids))
    seen = [np.zeros(0, np.int64)]
    for src, dst in shard_links(a, b, graph, spec):
        if same:
            keep = src != dst
            lo, hi = np.minimum(src, dst)[keep], np.maximum(src, dst)[keep]
            seen.append(np.unique(lo * np.int64(a.n) + hi))
            unite(parent, lo, hi)
        else:
            np.add.at(linked, src, b.sizes[dst])
            np.add.at(linked, dst + shift, a.sizes[src])
            unite(parent, src, dst + shift)
    if same:
        # a link may be found from either end: count it once
        pairs = np.unique(np.concatenate(seen))
        lo, hi = pairs // a.n, pairs % a.n
        np.add.at(linked, lo, a.sizes[hi])
        np.add.at(linked, hi, a.sizes[lo])
    out = np.flatnonzero(linked)
    return pd.DataFrame({"rep": ids[out], "linked": linked[out], "root": ids[parent[out]]})


def near_duplicates(df: DataFrame, spec: EmbedSpec = EmbedSpec()) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = packed(df, ["vec_id", "label"]) \
        .withColumn("d1", F.xxhash64("raw")).withColumn("d2", F.xxhash64("raw", F.lit(17)))
    rows = cut(rows)
    part = rows.filter("raw is not null and label is not null and vec_id is not null")
    classes = cut(part.groupBy("label", "dim", "d1", "d2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("raw").alias("raw")))
    counts = classes.groupBy("label", "dim").agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(spec.shard_rows))).cast("int").alias("shards"))
    dealt = classes.join(counts, ["label", "dim"]) \
        .withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    columns = [c.split()[0] for c in INDEX_COLUMNS.split(", ")]

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable")
        x = matrix(pdf["raw"].tolist(), int(key[1]))
        row = index_row(x, pdf["rep"].to_numpy(), pdf["size"].to_numpy(), spec.graph, unit(x))
        return pd.DataFrame([{"label": key[0], "dim": key[1], "shard": key[2],
                              "shards": int(pdf["shards"].iloc[0]), **row}],
                            columns=["label", "dim", "shard", "shards", *columns])

    index = cut(dealt.groupBy("label", "dim", "shard").applyInPandas(
        build, f"label int, dim int, shard int, shards int, {INDEX_COLUMNS}"))
    # a shard's vectors visit itself and the shards after it
    visits = index.select("label", "dim", F.col("shard").alias("shard_a"),
                          *[F.col(c).alias(f"a_{c}") for c in ("ids", "sizes", "n", "vectors")],
                          F.explode(F.sequence("shard", F.col("shards") - 1)).alias("shard"))
    homes = index.select("label", "dim", "shard", *[F.col(c).alias(f"b_{c}") for c in columns])
    met = visits.join(homes.hint("merge"), ["label", "dim", "shard"])

    def run(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                yield _pair_frame(r, spec)

    found = cut(met.mapInPandas(run, "rep long, linked long, root long"))
    links = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    comp = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), found.count())
    known = classes.select("label", "dim", "d1", "d2", "rep", "size") \
        .join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("label", "dim", "d1", "d2", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n"),
                F.coalesce("component", "rep").alias("c"))
    # rows that take no part must not meet a class whose digest they share
    own = rows.withColumn("label", F.when(F.col("vec_id").isNotNull() & F.col("raw").isNotNull(), F.col("label")))
    out = own.select("vec_id", "label", "dim", "d1", "d2").join(known, ["label", "dim", "d1", "d2"], "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


#: All pairs of a label, components by reachability (DuckDB; small tables).
ORACLE = """
with recursive e as (select vec_id, label, cast(embedding as double[]) as x from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0),
l as (select a.vec_id as u, b.vec_id as v from e a join e b on a.label = b.label and a.vec_id <> b.vec_id
      where len(a.x) = len(b.x) and list_cosine_similarity(a.x, b.x) >= 0.98),
n as (select u, count(*) as n from l group by u),
r as (select vec_id as a, vec_id as b from embeddings union select r.a, l.v from r join l on l.u = r.b),
c as (select a, min(b) as component_id from r group by a)
select vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
from embeddings join c on c.a = vec_id left join n on n.u = vec_id"""
