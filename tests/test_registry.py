"""The driver contract: flagship query and a sample of queries against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from tradeledger.sources.commerce import SCHEMAS

SAMPLE = [
    "executive_kpis",
    "executive_kpis_with_ticket",
    "top_10_categories_by_revenue",
    "cohort_retention",
    "revenue_pareto",
    "default_fill_checks",
    "readiness_gate_per_seller",
    "iqr_outliers",
]


def test_every_statement_belongs_to_a_query():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 170


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("key", SAMPLE)
def test_query_equals_its_statement(spark, root, key):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    want = con.execute(entry.oracle_sql()[key])
    names = [c[0] for c in want.description]
    rows = [dict(zip(names, r)) for r in want.fetchall()]
    got = [r.asDict() for r in entry.queries()[key](spark, root).collect()]

    def order(r):
        return [(r[n] is not None, str(r[n])) for n in sorted(names)]

    assert sorted(got, key=order) == sorted(rows, key=order)
