"""The registry runs on the given tables and agrees with its DuckDB statements."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as spec
import check
from helpers import SF
from tracewright.plans.oracle import oracle_queries
from tracewright.plans.queries import registry

WITHOUT_SQL = {
    "sla_metrics", "risk_scores", "risk_bands", "drivers", "review_queue", "subgroup_errors",
    "risk_measures", "high_risk_transitions", "report_json", "report_sections",
}


def test_every_query_has_a_statement_or_a_reason():
    assert set(registry()) - set(oracle_queries()) == WITHOUT_SQL
    assert set(oracle_queries()) <= set(registry())


def test_entry(spark):
    assert spec.entry(spark).columns == [
        "variant_rank", "variant", "activity_count", "case_count", "case_share"]


@pytest.mark.parametrize("name", sorted(set(oracle_queries())))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registry()[name](spark, SF)
    result = con.execute(oracle_queries()[name])
    names = [d[0] for d in result.description]
    mine = check.canonical([tuple(r) for r in df.collect()], df.columns)
    assert mine == check.canonical(result.fetchall(), names)
