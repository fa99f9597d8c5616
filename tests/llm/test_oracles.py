import math

import duckdb
import pytest

import __spark_entry__ as driver
from tapekeeper.llm.oracles import ORACLES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def cell(x):
    return f"{x:.6f}" if isinstance(x, float) and not math.isnan(x) else str(x)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = driver.queries()[name](spark, sf)
    expected = con.execute(driver.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(found.columns)
    rows = sorted(tuple(map(cell, r)) for r in expected.fetchall())
    assert rows and sorted(tuple(map(cell, r)) for r in found.select(*names).collect()) == rows
