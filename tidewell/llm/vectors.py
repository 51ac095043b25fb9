"""Packing vectors and indexing shards of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hnsw import Graph, GraphSpec


def packed(df: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """``keys``, ``dim`` and ``raw`` (little-endian doubles); raw is null for vectors
    that are null, empty, zero or hold null or non-finite components."""
    names = [*keys, "dim", "raw"]

    def run(batches):
        for batch in batches:
            lists = batch.column(len(keys))
            n = batch.num_rows
            offs = lists.offsets.to_numpy().astype(np.int64)
            # the buffer may hold more than this batch's rows: slice by the offsets
            child = lists.values.slice(offs[0], offs[-1] - offs[0])
            values = child.to_numpy(zero_copy_only=False).astype("<f8")
            if child.null_count:
                values = np.where(child.is_null().to_numpy(zero_copy_only=False), np.nan, values)
            offs = offs - offs[0]
            given = lists.is_valid().to_numpy(zero_copy_only=False)
            buf = values.tobytes()
            raw, dim = [], []
            for i in range(n):
                v = values[offs[i]:offs[i + 1]]
                ok = given[i] and len(v) and np.isfinite(v).all() and v.any()
                raw.append(buf[8 * offs[i]:8 * offs[i + 1]] if ok else None)
                dim.append(len(v))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keys))), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())],
                names=names)

    schema = ", ".join(f"{k} {'int' if k == 'label' else 'long'}" for k in keys) + ", dim int, raw binary"
    picked = df.select(*[F.col(k).cast("int" if k == "label" else "long").alias(k) for k in keys],
                       F.col(vector).cast("array<double>").alias("v"))
    return picked.mapInArrow(run, schema)


INDEX_COLUMNS = "ids binary, sizes binary, n int, vectors binary, entry int, widths array<int>, levels array<binary>"


def index_row(vectors: np.ndarray, ids: np.ndarray, sizes: np.ndarray, spec: GraphSpec,
              walk: np.ndarray | None = None) -> dict:
    """A shard's index as one row: its graph is built over ``walk`` (or the vectors)."""
    entry, widths, levels = Graph(vectors if walk is None else walk, spec).build().flat()
    return {"ids": ids.astype("<i8").tobytes(), "sizes": sizes.astype("<i8").tobytes(), "n": len(vectors),
            "vectors": vectors.astype("<f8").tobytes(), "entry": entry, "widths": widths, "levels": levels}


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(raws, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), "<f8").reshape(-1, dim)
