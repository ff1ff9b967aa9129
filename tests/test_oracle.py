"""Every query with a SQL twin gives the twin's rows on tables of every kind of line."""

import glob
import os

import duckdb
import pytest

from strandwise.queries import oracle_sql, queries


def canonical(rows):
    def one(x):
        if x is None or isinstance(x, str):
            return x
        if isinstance(x, bool):
            return x
        return round(float(x), 6) if isinstance(x, float) else int(x)

    return sorted((tuple(one(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sf_dir():
    """Large enough for every reference name, also those that are not wanted."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no driver tables here")
    return folder


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    rel = duck.sql(oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"select {quoted} from ({oracle_sql()[name]}) q").fetchall()
    assert canonical(df.select(*columns).collect()) == canonical(want)
