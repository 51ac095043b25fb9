"""Approximate nearest neighbours: a small-world graph per shard, results merged.

Every vector is indexed. Rows are dealt to shards of about ``shard_rows`` by a
hash of their id; a shard's index (ids, vectors, graph levels as flat neighbour
arrays) is one row of a table kept in the shared checkpoint folder. Equal
vectors of a shard are one node with all their ids. Queries travel in blocks:
each block meets each shard of its dimension, the shard's beam gives candidates,
distances are taken anew in double precision on the original vectors, and the
best k per shard are merged per query.

Defined cases: vectors null, empty, zero or with null or non-finite components
take no part (neither do null ids); a vector only meets those of its dimension;
rows that share the query's id are never its neighbours; equal query rows count
once; with fewer than k candidates all are returned (a shard no larger than the
beam is compared in full); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut
from .hnsw import Graph, GraphSpec
from .vectors import INDEX_COLUMNS, index_row, matrix, packed


@dataclass(frozen=True)
class AnnSpec:
    k: int = 10
    beam: int = 160
    shard_rows: int = 8192
    query_rows: int = 1024
    graph: GraphSpec = field(default_factory=GraphSpec)


def build_index(rows: DataFrame, spec: AnnSpec) -> DataFrame:
    """One row per (dim, shard): the flat index of its vectors."""
    total = rows.count()
    shards = max(1, -(-total // spec.shard_rows))
    names = ["dim", "shard", "shards", *(c.split()[0] for c in INDEX_COLUMNS.split(", "))]

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, shard = int(key[0]), int(key[1])
        pdf = pdf.sort_values(["raw", "vec_id"], kind="stable")
        raws, ids = pdf["raw"].tolist(), pdf["vec_id"].to_numpy()
        first = [i for i in range(len(raws)) if i == 0 or raws[i] != raws[i - 1]]
        sizes = np.diff([*first, len(raws)])
        row = index_row(matrix([raws[i] for i in first], dim), ids, sizes, spec.graph)
        return pd.DataFrame([{"dim": dim, "shard": shard, "shards": shards, **row}], columns=names)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return cut(dealt.groupBy("dim", "shard").applyInPandas(
        build, f"dim int, shard int, shards int, {INDEX_COLUMNS}"))


def search(rows: DataFrame, index: DataFrame, queries: DataFrame, spec: AnnSpec) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found per query row."""
    asked = queries.dropDuplicates(["vec_id", "raw"])
    blocks = max(1, -(-asked.count() // spec.query_rows))
    by_block = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "raw"), F.lit(blocks)).cast("int")) \
        .groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "raw")).alias("q"))
    # each block goes to each shard that exists: the stated queries against all rows
    homes = index.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("homes"))
    sent = by_block.join(homes, "dim").select("dim", "q", F.explode("homes").alias("shard"))
    met = sent.join(index.hint("merge"), ["dim", "shard"])
    k, beam = spec.k, spec.beam

    def run(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                qid = np.array([x["vec_id"] for x in r.q], np.int64)
                q = matrix([x["raw"] for x in r.q], r.dim)
                yield _nearest(qid, q, r, k, beam)

    per_shard = met.select("dim", "q", *(c.split()[0] for c in INDEX_COLUMNS.split(", "))) \
        .mapInPandas(run, "query_id long, variant long, vec_id long, score double")
    best = Window.partitionBy("query_id", "variant").orderBy("score", "vec_id")
    return per_shard.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _nearest(qid, q, r, k: int, beam: int) -> pd.DataFrame:
    x = np.frombuffer(r.vectors, "<f8").reshape(r.n, r.dim)
    ids, sizes = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.sizes, "<i8")
    first = np.concatenate([[0], np.cumsum(sizes)])
    if r.n <= beam:
        found = np.broadcast_to(np.arange(r.n), (len(q), r.n))
    else:
        found, _ = Graph.from_flat(x, r.entry, list(r.widths), list(r.levels)).search(q, beam)
    out = []
    for i in range(len(q)):
        nodes = found[i][found[i] >= 0]
        d = np.sqrt(((x[nodes] - q[i]) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")[:k + 1]
        # of a node's ids the k + 1 smallest are enough, the query's own being one of them
        near = [(d[o], ids[first[nodes[o]]:first[nodes[o]] + min(sizes[nodes[o]], k + 1)])
                for o in np.flatnonzero(d <= d[order[-1]])] if len(order) else []
        if not near:
            continue
        score = np.repeat([a for a, _ in near], [len(b) for _, b in near])
        vec = np.concatenate([b for _, b in near])
        other = vec != qid[i]
        score, vec = score[other], vec[other]
        pick = np.lexsort((vec, score))[:k]
        # rows of one id with different vectors are queries of their own
        variant = int.from_bytes(hashlib.blake2b(q[i].tobytes(), digest_size=8).digest(), "little", signed=True)
        out.append(pd.DataFrame({"query_id": qid[i], "variant": variant, "vec_id": vec[pick], "score": score[pick]}))
    return pd.concat(out) if out else pd.DataFrame(
        {"query_id": [], "variant": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "variant": "int64", "vec_id": "int64", "score": "float64"})


def nearest(df: DataFrame, is_query: Column, spec: AnnSpec = AnnSpec()) -> DataFrame:
    """The k nearest of every row of ``df`` (vec_id, embedding) that ``is_query`` marks."""
    rows = cut(packed(df, ["vec_id"]).filter("raw is not null and vec_id is not null"))
    return search(rows, build_index(rows, spec), rows.filter(is_query), spec)
