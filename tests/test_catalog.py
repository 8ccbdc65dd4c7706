"""Every query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

from check import TABLES, compare
from docgraph.catalog import ORACLES, QUERIES

PATH = "/root/testdata/sf0.001"
# On so little data a query may rightly find nothing.
MAY_BE_EMPTY = {"cover_gaps", "rank_frequent_approx"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{PATH}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, n, verdict = compare(spark, con, PATH, name)
    assert verdict in ("equal", "rows only", "EMPTY (equal)")
    assert n > 0 or name in MAY_BE_EMPTY


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["metric", "value"]
    assert e.queries().keys() >= QUERIES.keys()
    assert e.queries().keys() >= e.oracle_sql().keys()
