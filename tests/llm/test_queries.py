"""The registered queries on the smallest tables: against SQL where there is some,
else their rows and columns."""
import duckdb
import pytest

from tests.conftest import SF_SMALL
from tidewell.llm.queries import ORACLES, QUERIES
from tidewell.sources.tables import TABLES, table

COLUMNS = {
    "op1_suffix_dedup": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "op2_nearest_neighbours": (None, ["query_id", "rank", "vec_id", "score"]),
    "op5_toxicity": ("documents", ["doc_id", "held_out", "score", "predicted"]),
    "op6_mix_sources": ("documents", ["doc_id", "size", "source_size", "target", "taken"]),
    "op7_pii_pseudonyms": ("documents", ["doc_id", "text", "n_replaced"]),
    "op8_sentencepiece_samples": (None, ["doc_id", "sample", "n_pieces", "log_prob", "gumbel", "inclusion",
                                         "ids_sha256", "decoded"]),
}


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(COLUMNS) | set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    row = lambda d: str([round(d[c], 9) if isinstance(d[c], float) else d[c] for c in sorted(d)])
    assert sorted(row(r.asDict()) for r in df.collect()) == sorted(row(dict(zip(names, r))) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_table(spark, name):
    source, columns = COLUMNS[name]
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns == columns
    n = df.count()
    assert n == table(spark, SF_SMALL, source).count() if source else n > 0
    if name.startswith("op8"):
        assert df.filter("sample = 1").count() == table(spark, SF_SMALL, "documents").count()
        assert df.filter("not decoded").count() == 0
