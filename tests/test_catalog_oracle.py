"""Every registered query against its DuckDB SQL on the smallest driver tables."""


import duckdb
import pytest

from check import TABLES, _rows
from termite.plans.catalog import REGISTRY
from termite.plans.oracle import ORACLE as ORACLE_TEXTS

SF = "/root/testdata/sf0.001"
QUERIES = dict(REGISTRY)
ORACLE = dict(ORACLE_TEXTS)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_survey_operator_is_registered():
    assert len(QUERIES) == 95
    assert set(QUERIES) - set(ORACLE) == {"stem_vocabulary", "porter_search"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(df.columns) > 0
        return
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, rows) == _rows(dcols, res.fetchall())
