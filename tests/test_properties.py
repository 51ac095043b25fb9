"""Randomised checks against plain-Python oracles (few examples: each is a Spark job)."""
import math

from hypothesis import HealthCheck, given, settings, strategies as st

from tidewell.functions.columns import clamp_index
from tidewell.operators import envelope, merge
from tidewell.schemas import struct

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.integers(min_value=0, max_value=6)
vals = st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False))


def _py_merge(batch, hist, absent):
    """The original rule spelled out: batch max per key, stored row (nulls ->
    absent) if present, absent value for features a side lacks, then max."""
    out = {}
    hist_by = {}
    for k, h in hist:
        hist_by.setdefault(k, []).append(h)
    for k in {k for k, _ in batch}:
        a_vals = [a for kk, a in batch if kk == k]
        cands_a = [a for a in a_vals if a is not None]
        cands_h = [absent] if absent is not None else []
        for h in hist_by.get(k, []):
            cands_a += [absent] if absent is not None else []
            hv = h if h is not None else absent
            if hv is not None:
                cands_h.append(hv)
        out[k] = (max(cands_a) if cands_a else None, max(cands_h) if cands_h else None)
    return out


@settings(**SETTINGS)
@given(batch=st.lists(st.tuples(keys, vals), min_size=1, max_size=12),
       hist=st.lists(st.tuples(keys, vals), max_size=8, unique_by=lambda t: t[0]),
       parity=st.booleans())
def test_merge_matches_python_rule(spark, batch, hist, parity):
    absent = 0.0 if parity else None
    b = spark.createDataFrame(batch, "id int, a double")
    h = spark.createDataFrame(hist, "id int, h double")
    got = {r.id: (r.a, r.h) for r in
           merge.merge_max(b, h, "id", ["a"], ["h"], absent=absent).collect()}
    assert got == _py_merge(batch, hist, absent)


texts = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.integers(-10**12, 10**12), st.one_of(st.none(), texts)),
                     min_size=1, max_size=10))
def test_json_envelope_round_trip(spark, rows):
    rows = [(i, k, t) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "off long, k long, t string")
    back = envelope.decode(envelope.encode(df, ["k", "t"], offset="off"),
                           struct("k bigint, t string"))
    assert sorted((r.offset, r.k, r.t) for r in back.collect()) == sorted(rows)


@settings(**SETTINGS)
@given(preds=st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True,
                                                     width=64)), min_size=1, max_size=10),
       n=st.integers(min_value=1, max_value=7))
def test_clamp_index_rule(spark, preds, n):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(preds)], "i int, p double")
    got = {r.i: r.x for r in df.select("i", clamp_index("p", n).alias("x")).collect()}
    for i, p in enumerate(preds):
        if p is None or math.isnan(p):
            assert got[i] is None
        else:
            assert got[i] == int(max(0.0, min(float(n - 1), p)))


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)),
                               st.one_of(st.none(), st.floats(allow_nan=False,
                                                              allow_infinity=False))),
                     min_size=1, max_size=10))
def test_text_envelope_round_trip_numbers(spark, rows):
    rows = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, "off long, a int, b double")
    back = envelope.decode(envelope.encode(df, ["a", "b"], fmt="text", offset="off"),
                           struct("a int, b double"), fmt="text")
    assert sorted((r.offset, r.a, r.b) for r in back.collect()) == sorted(rows)
