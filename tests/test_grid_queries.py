"""Every registered grid query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from geogrid.plans.queries import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in sorted(os.listdir(DATA)):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{DATA}/{name}'")
    return con


def _rows(df):
    columns = sorted(df.columns)

    def one(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, bool):
            return str(v)
        try:
            return repr(float(v) + 0.0)
        except (TypeError, ValueError):
            return str(v)

    return columns, sorted(tuple(one(v) for v in r) for r in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, DATA).toPandas()
    assert len(got) or name == "k5_a15_tiles"
    if name in ORACLES:
        assert _rows(got) == _rows(db.execute(ORACLES[name]).df())
