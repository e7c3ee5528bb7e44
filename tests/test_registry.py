"""Every registered core query against its SQL on the smallest test tables."""

import importlib.util
import os

import pytest

from readloom.plans import registry

_path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts", "compare.py")
_spec = importlib.util.spec_from_file_location("compare", _path)
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    result = duck.execute(registry.oracle_sql()[name])
    theirs, columns = result.fetchall(), [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert compare.rows_of([tuple(r) for r in df.collect()], df.columns) == compare.rows_of(theirs, columns)


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_every_core_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
