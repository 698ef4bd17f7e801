"""Every query of the engine beside its SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from cardloom.plans import registry
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, str):
        return v
    return f"{float(v):.6f}" if math.isfinite(float(v)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    rel = con.sql(registry.oracle_sql()[name])
    assert columns == sorted(rel.columns)
    assert got == sorted(tuple(map(plain, r)) for r in rel.select(", ".join(f'"{c}"' for c in columns)).fetchall())
