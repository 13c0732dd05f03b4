"""Every registered query against its SQL equivalent on the given tables."""

import math
import os
from pathlib import Path

import pytest

from equifacts.bindings import QUERIES, SQL

FOLDER = os.environ.get("EQUIFACTS_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(rows):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.6f}"
        return f"{type(v).__name__}:{v}"
    return sorted(tuple(map(cell, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = canonical(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in SQL:
        assert got
        return
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    want = canonical(duck.sql(f"SELECT {picked} FROM ({SQL[name]})").fetchall())
    assert len(got) == len(want)
    assert [p for p in zip(got, want) if p[0] != p[1]][:3] == []
    assert want
