"""Every registered query against its SQL on the same tables, values and all."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

from catalog.oracles import ORACLES
from catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return value.normalize() if isinstance(value, Decimal) else value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    got = bag(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = bag(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want) > 0
    assert got == want
