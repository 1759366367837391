"""Each query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from lawloom.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    r = db.execute(ORACLES[name])
    at = {d[0]: k for k, d in enumerate(r.description)}
    assert sorted(at) == columns
    want = sorted(repr(tuple(x[at[c]] for c in columns)) for x in r.fetchall())
    assert sorted(repr(tuple(x[c] for c in columns)) for x in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
