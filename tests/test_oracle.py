"""Every registered query against its DuckDB oracle (sf0.001), plus the
driver entry point."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from stratum.workload.feeds import BASE_TABLES  # noqa: E402
from stratum.workload.oracle import ORACLE_SQL  # noqa: E402
from stratum.workload.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert r["cols"] and r["count"] and r["values"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_number", "product_sk", "customer_sk", "order_date", "ship_date",
                          "due_date", "sales", "quantity", "price"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["fact_sales", "star_build_stored"])
def test_flagship_matches_oracle_at_gate_scale(spark, name):
    from conftest import SF_ORACLE
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    r = compare(spark, c, name, entry.queries()[name], entry.oracle_sql()[name], SF_ORACLE)
    assert r["cols"] and r["count"] and r["values"] and r["rows"] > 100_000, r
