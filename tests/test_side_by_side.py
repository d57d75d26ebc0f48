"""Every registered query against its DuckDB text, on whole tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = os.environ.get("SIDE_BY_SIDE_SF_DIR", "/root/testdata/sf0.01")


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


LLM = set(registry.llm_registry.QUERIES) if registry.llm_registry else set()


def test_every_query_has_a_text():
    assert set(registry.queries()) - LLM == set(registry.oracle_sql()) - LLM


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in LLM])
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    found = _rows(df.columns, df.collect())
    duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in duck.description]
    expected = _rows(columns, duck.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(found) == len(expected) > 0
    assert found == expected
    types = dict(zip(columns, [str(d[1]) for d in duck.description]))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    same = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}
    assert {c: same.get(t, t) for c, t in types.items()} == spark_types


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["state", "total_entities"]
    assert df.count() > 0
