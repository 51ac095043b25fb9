"""Every catalogue query against its SQL oracle (DuckDB) on the smallest scale."""
import math

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tidewell.plans.catalogue import load_all
from tidewell.sources.tables import TABLES

REG = load_all()
NO_ORACLE = {"gbt_many_features"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_oracle_coverage():
    assert {n for n, e in REG.items() if e.sql is None} == NO_ORACLE
    assert len(REG) >= 40


@pytest.mark.parametrize("name", sorted(n for n in REG if n not in NO_ORACLE))
def test_query_matches_oracle(spark, con, name):
    e = REG[name]
    df = e.run(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(e.sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, rows) == _digest(ocols, res.fetchall())


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_query_without_oracle_runs(spark, name):
    assert REG[name].run(spark, SF_SMALL).count() > 0
