"""Each query of the engine against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from swident.plans.catalogue import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def cells(rows):
    return sorted(tuple("~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    order = sorted(df.columns)
    r = duck.execute(ORACLE_SQL[name])
    have = [d[0] for d in r.description]
    assert sorted(have) == order
    assert cells(df.select(*order).collect()) == cells([tuple(x[have.index(c)] for c in order) for x in r.fetchall()])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
