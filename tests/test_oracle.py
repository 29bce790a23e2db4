"""The correctness gate in pytest form: every registered query against its
DuckDB oracle on the smallest tables (the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from stationqc.plans import catalog
from tests.oracle_check import TABLES, norm

SF = "/root/testdata/sf0.001"
ORACLE = catalog.ORACLE
QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(sdf) >= 0
        return
    ddf = con.execute(ORACLE[name]).df()
    assert norm(sdf) == norm(ddf)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["sid", "n_cells", "n_filled", "n_seasonal_bad", "n_days_bad", "n_valid"]
