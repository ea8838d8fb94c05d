"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quireflow.plans.bindings import BASE
from quireflow.plans.registry import ORACLES, QUERIES

SF = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return None if v != v else round(v, 4)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return round(float(v), 4) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(map(norm, r)) for r in df.select(*columns).collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cur = duck.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[k]) for k in at) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
