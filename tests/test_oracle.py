"""Every registered query against its SQL on the test tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from reelrank.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (bool, int, float, Decimal)):
        return float(value) + 0.0
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    want = duck.sql(driver.oracle_sql()[name])
    expected = table(want.columns, want.fetchall())
    assert expected[1], "the check needs rows"
    assert table(got.columns, got.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_queries(spark, name):
    params = {r["idx"]: r["coefficient"] for r in driver.queries()[name](spark, SF_DIR).collect()}
    assert sorted(params) == list(range(-1, 10))
    assert all(math.isfinite(value) for value in params.values())


def test_entry_has_ten_titles_per_user(spark):
    result = driver.entry(spark)
    assert result.columns == ["userId", "rank", "movieId", "title", "score"]
    counts = result.groupBy("userId").count().collect()
    assert counts and all(r["count"] == 10 for r in counts)
