"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL
from pickwise.plans.catalog import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = sorted(n for n in E.oracle_sql() if n in REGISTRY)  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(cols), sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = _rows([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = df.collect()
    assert df.columns == ["bundle", "service_date", "daytype"]
    assert len(got) == 6
