"""Compares a query with its DuckDB SQL on a data directory."""

import math
from pathlib import Path

import duckdb
import pytest

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no test data here")


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    return value


def compare(spark, query, sql):
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    df = query(spark, str(DATA))
    columns = sorted(df.columns)
    relation = connection.sql(sql)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(canonical(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    found = sorted((tuple(canonical(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert found == expected
