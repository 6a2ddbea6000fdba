"""Every query of the library against its DuckDB oracle on sf0.001."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from spindex import catalog
from conftest import SF_SMOKE

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


def check_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMOKE)
    cols = sorted(df.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[key])
    dcols = rel.columns
    assert sorted(dcols) == cols
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == dtypes
    drows = Counter(tuple(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall())
    assert srows == drows


@pytest.mark.parametrize("key", sorted(catalog.SQL))
def test_matches_oracle(spark, con, key):
    check_oracle(spark, con, key)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "name", "score"]
    assert df.count() >= 0


def test_every_library_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.SQL) and set(E.oracle_sql()) <= set(E.queries())
