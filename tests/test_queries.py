"""Every registered network query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from fluviant.plans import oracle, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    c = duckdb.connect()
    for f in os.listdir(SF_DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{f}'")
    return c


def test_every_sql_has_a_query():
    assert set(oracle.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, database, name):
    found = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert len(found)
    if name in oracle.ORACLE_SQL:
        columns = sorted(found.columns)
        expected = database.execute(oracle.ORACLE_SQL[name]).df()
        assert sorted(expected.columns) == columns
        a, b = (df[columns].sort_values(columns).reset_index(drop=True) for df in (found, expected))
        pd.testing.assert_frame_equal(a, b, check_dtype=False, check_exact=True)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    known = entry.queries()
    assert set(queries.QUERIES) <= set(known) and set(entry.oracle_sql()) <= set(known)
