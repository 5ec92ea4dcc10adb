"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check import TABLES, _rows
from termite.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    df = REGISTRY[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLE:
        res = con.execute(ORACLE[name])
        names = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(names)
        assert _rows(df.columns, rows) == _rows(names, res.fetchall())
    else:
        table = "pages" if "page_id" in df.columns else "documents"
        assert len(rows) == con.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
