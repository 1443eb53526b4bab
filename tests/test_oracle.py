"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from support import SF_SMALL
from docloom.plans.registry import QUERIES, oracle
from docloom.sources.tables import TABLES

# the document queries; optional parts that the entry adds have tests of their own
NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else f"{round(float(v), 6):.6f}")
    return (3, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle()) == set(QUERIES)
    assert set(QUERIES) <= set(se.queries()) and set(oracle()) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    orows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert len(rows) == len(orows)
    assert sorted(tuple(_norm(v) for v in r) for r in rows) == \
        sorted(tuple(_norm(v) for v in r) for r in orows)


def test_entry_runs(spark):
    assert se.entry(spark).count() > 0
