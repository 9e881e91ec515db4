"""Every catalogue query against its SQL in DuckDB."""

import datetime
import glob
import os

import duckdb
import pytest

from gleaner.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, sf_dir, name):
    df = catalogue.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    out = duck.execute(SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in out.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_runs(spark, sf_dir, name):
    # The smallest tables hold no two parts of one brand, type and size.
    assert catalogue.queries()[name](spark, sf_dir).count() >= (name != "fuzzy_pairs")
