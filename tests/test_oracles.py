"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import math
import os
from decimal import Decimal
from pathlib import Path

import pytest

from tessera.plans import registry

FOLDER = Path(os.environ.get("TESSERA_TEST_TABLES", "/root/testdata/sf0.001"))
SLOW = {"graph_quality", "components"}


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not FOLDER.exists():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(registry.ORACLES) - SLOW))
def test_query(spark, duck, name):
    made = registry.QUERIES[name](spark, str(FOLDER))
    columns = sorted(made.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in made.collect()), key=str)
    told = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in told.fetchall()), key=str)
    assert got == want
