"""The driver contract: every query builds, and its columns match the SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from trackline.plans.catalogue import catalogue

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LIBRARY = catalogue()
SQL = contract.oracle_sql()
# Each of these runs the whole stream monitor; one of them is enough here, tools/check_queries.py compares them all.
SLOW = ("stream_incomplete", "stream_alerts", "stream_dead_letters", "stream_late", "outgoing_messages", "stream_control",
        "stream_control_letters", "stream_cold_start", "stream_commits", "metric_stream_latest30", "document_changes_stream")


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_all_queries_are_registered():
    assert set(LIBRARY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(LIBRARY) - set(SLOW)))
def test_rows_match(spark, con, sf_dir, name):
    if name not in SQL:
        pytest.skip("no SQL counterpart")
    frame = contract.queries()[name](spark, sf_dir)
    order = sorted(frame.columns)
    ours = sorted(repr(tuple(r)) for r in frame.select(*order).collect())
    found = con.execute(SQL[name])
    assert sorted(d[0] for d in found.description) == order
    quoted = ", ".join(f'"{c}"' for c in order)
    theirs = sorted(repr(r) for r in con.execute(f"SELECT {quoted} FROM ({SQL[name]}) AS q").fetchall())
    assert ours == theirs
