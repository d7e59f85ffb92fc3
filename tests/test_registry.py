"""Registered queries against their SQL in DuckDB. Set TIDEMARK_ALL_QUERIES=1 to check every one."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.registry import REGISTRY

SOME = (
    "monthly_gmv_orders",
    "dim_date",
    "dim_product",
    "fact_order_items",
    "silver_order_items",
    "quarantine_orders",
    "quarantine_payments_parity",
    "change_feed",
    "propagate_changes",
    "commit_timestamp",
    "chunk_rows",
    "delivery_vs_review",
    "state_drillthrough",
    "true_carts",
    "describe",
    "read_changes",
    "scd1_out_of_order",
    "funnel_join",
)
NAMES = tuple(REGISTRY) if os.environ.get("TIDEMARK_ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def duck(request):
    connection = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, sf, name):
    df = queries()[name](spark, sf)
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_flagship_totals(spark):
    rows = entry(spark).collect()
    assert len(rows) == 80
    assert round(sum(r.total_gmv for r in rows), 2) == 201_376_208.16
    assert sum(r.total_orders for r in rows) == 1431
    assert (rows[0].year_month, rows[0].total_gmv, rows[0].total_orders) == ("1995-01", 1_887_199.0, 16)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())
