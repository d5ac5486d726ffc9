"""Every registered query of the engine's own operators against DuckDB."""

import duckdb
import pytest

from folioflow import catalog, catalog_desks, catalog_paper

QUERIES, ORACLES = catalog.QUERIES | catalog_desks.QUERIES | catalog_paper.QUERIES, catalog.ORACLES | catalog_desks.ORACLES | catalog_paper.ORACLES
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def canon(rows):
    return sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    run = duck.execute(ORACLES[name])
    there = [d[0] for d in run.description]
    assert sorted(there) == cols
    expected = [tuple(r[there.index(c)] for c in cols) for r in run.fetchall()]
    assert canon(df.select(*cols).collect()) == canon(expected)
