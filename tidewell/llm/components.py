"""Connected components of an edge table by alternating large and small stars.

Up to ``ONE_TASK`` edges (counted; 16 bytes each) are united in one task, which
spares a small graph the rounds; the result is the same.

Every round replaces edges by edges to smaller neighbours until the forest is a
set of stars around the smallest node. Minima are partial aggregates and the
join back to the edges is one that adaptive execution can split, so a node with
a third of all edges is not one task. Rounds are cut at the shared checkpoint
folder; nothing but two counters per round reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut, merged


ONE_TASK = 1_000_000


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites a[i] with b[i] in ``parent`` (smaller number on top), in place."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _in_one_task(batches):
    found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not found:
        return
    u, v = (np.concatenate(x) for x in zip(*found))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = np.arange(len(nodes))
    unite(parent, at[:len(u)], at[len(u):])
    below = np.flatnonzero(parent != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[parent[below]])],
                                     names=["node", "component"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").filter("v != m") \
        .select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, most_rows: int | None = None, one_task: int = ONE_TASK) -> DataFrame:
    """``node, component`` for every node that is not the smallest of its component.

    ``edges``: longs ``u`` and ``v``; loops, nulls and repeats are allowed.
    ``most_rows``, where known, bounds their number (tasks follow it).
    """
    now = cut(edges.select("u", "v").filter("u != v")
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), most_rows)
    state = _state(now)
    if state[0] <= one_task:
        return cut(now.coalesce(1).mapInArrow(_in_one_task, "node long, component long"))
    while state[0]:
        # a star turn makes at most one edge per edge and direction
        stars = merged(_large_star(now), 2 * state[0])
        now = cut(_small_star(stars).distinct(), 2 * state[0])
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
