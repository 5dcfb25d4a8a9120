"""The driver contract, and a few registered queries against DuckDB at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import compare
import oracle
from larder.plans import reports

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_only_clustering_has_no_sql():
    assert set(reports.queries()) - set(oracle.sql_queries()) == {"cluster_buyer_outlets", "cluster_sizes"}
    assert set(reports.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["buyer_department_outlet", "order_line_stage", "document_header", "daily_supplier",
                                  "daily_buyer", "non_active_buyers", "latest_scores", "events"])
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns, rows = [d[0] for d in cursor.description], cursor.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert compare.canonical(result.columns, result.collect()) == compare.canonical(columns, rows)
