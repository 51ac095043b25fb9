"""Neighbour search and embedding near-dedup against brute force."""
import math

import numpy as np

from tidewell.llm import ann, embed_dedup
from tidewell.llm.hnsw import Graph
from tidewell.llm.vectors import unit

SCHEMA = "vec_id long, embedding array<double>, label int, dim int, raw string, shard int, ids string, n int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, "x", 2, "y", 3) for i, v, l in rows], SCHEMA)


AWKWARD = [(None, [1.0, 2.0], 1), (900, None, 1), (901, [], 1), (902, [0.0, 0.0], 1), (903, [float("nan"), 1.0], 1),
           (904, [1.0, None], 1), (905, [float("inf"), 1.0], 1), (906, [1.0, 2.0, 3.0], 1)]


def _clusters(n, d, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 10, d))
    return centres[r.integers(0, len(centres), n)] + r.normal(size=(n, d)) * 0.15


def test_graph_recall_and_flat_round_trip():
    x = _clusters(3000, 32).astype(np.float32)
    g = Graph(x).build()
    q = x[::30]
    true = np.argsort(((q[:, None] - x[None]) ** 2).sum(2), axis=1, kind="stable")[:, :10]
    found, dist = g.search(q, 64)
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(found, true)]) > 0.95
    assert (np.diff(dist, axis=1) >= 0).all()
    assert (Graph.from_flat(x, *g.flat()).search(q, 64)[0] == found).all()
    one = Graph(x[:1]).build()
    assert one.search(q, 5)[0][0].tolist() == [0]


def _nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v, _ in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in ok if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def test_neighbours_of_shards_merge(spark):
    x = _clusters(1500, 16, 1)
    rows = [(i, x[i].tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, x[100].tolist(), 0) for i in range(40)] + AWKWARD     # ties with a query
    spec = ann.AnnSpec(shard_rows=400, beam=64, query_rows=7)
    got = ann.nearest(_frame(spark, rows), (lambda c: c % 100 == 0)(__import__("pyspark").sql.functions.col("vec_id")),
                      spec).collect()
    want = _nearest(rows, 10)
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    assert set(by) == {q for q in want if want[q]}
    hit = 0
    for q, near in by.items():
        assert sorted(near) == list(range(1, len(near) + 1)) and len(near) == len(want[q])
        listed = [near[i] for i in sorted(near)]
        assert listed == sorted(listed)
        hit += len({v for _, v in listed} & {v for _, v in want[q]})
    assert hit / sum(len(want[q]) for q in by) > 0.95
    assert [v for _, v in sorted(by[100].values())] == list(range(2000, 2010))     # ties go to smaller ids


def test_neighbours_of_few_and_no_rows(spark):
    from pyspark.sql import functions as F
    q = F.col("vec_id") % 100 == 0
    few = ann.nearest(_frame(spark, [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (200, [1.0, 0.0], None)] + AWKWARD), q)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few.collect()) == \
        [(0, 1, 200), (0, 2, 1), (200, 1, 0), (200, 2, 1)]
    assert ann.nearest(_frame(spark, []), q).count() == 0


def _groups(rows, threshold):
    ok = lambda i, v, l: i is not None and l is not None and v and all(
        c is not None and math.isfinite(c) for c in v) and any(v)
    n, parent = {}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    use = [(k, r) for k, r in enumerate(rows) if ok(*r)]
    for a, (k, (i, v, l)) in enumerate(use):
        find(i)
        for k2, (j, w, m) in use[:a]:
            if l == m and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    n[k] = n.get(k, 0) + 1
                    n[k2] = n.get(k2, 0) + 1
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
    return sorted(((i if i is not None else -1), n.get(k, 0), find(i) if ok(i, v, l) else (i if i is not None else -1))
                  for k, (i, v, l) in enumerate(rows))


def test_embedding_groups_match_brute_force(spark):
    r = np.random.default_rng(5)
    x = _clusters(500, 12, 2)
    near = x[:60] + r.normal(size=(60, 12)) * 0.03
    rows = [(i, x[i].tolist(), int(i % 3) if i % 17 else None) for i in range(500)]
    rows += [(1000 + i, near[i].tolist(), int(i % 3)) for i in range(60)]
    rows += [(2000 + i, x[7].tolist(), 1) for i in range(25)] + AWKWARD          # many copies
    rows += [(3000 + i, (x[8] + r.normal(size=12) * 0.01).tolist(), 2) for i in range(120)]   # a crowded place
    spec = embed_dedup.EmbedSpec(shard_rows=100, block=32, beam=4, audit=4)
    got = embed_dedup.near_duplicates(_frame(spark, rows), spec).collect()
    fix = lambda v: -1 if v is None else v
    assert sorted((fix(r.vec_id), r.n_links, fix(r.component_id)) for r in got) == _groups(rows, 0.98)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert embed_dedup.near_duplicates(_frame(spark, [])).count() == 0


def test_unit_handles_extreme_lengths():
    x = unit(np.array([[1e-300, 0.0], [1e300, 1e300], [3.0, 4.0]]))
    assert np.allclose((x ** 2).sum(1), 1)
