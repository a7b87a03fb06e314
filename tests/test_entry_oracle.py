"""Registered queries against their DuckDB SQL twins on sf0.001 (a fast subset)."""

import duckdb
import pytest

import __spark_entry__ as E
from adlens.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "part", "orders", "lineitem", "conversations"]
SUBSET = ["contract_defects", "request_validity", "request_run_analysis", "request_run_creative", "dataset_summary", "segments_all", "trend_direction", "quality_issues", "date_failures",
          "best_worst_segments", "campaign_modes", "ctr_p75", "request_period", "hypotheses_numeric",
          "validation_scores", "creative_variations"]


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dimension", "value", "spend", "revenue", "roas", "impressions", "clicks", "ctr"]
    assert df.count() == 112


def test_every_query_has_a_sql_twin():
    assert set(REGISTRY) - set(E.oracle_sql()) == set()
    assert set(REGISTRY) <= set(E.queries())


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_sql_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(got, df.columns) == _rows(exp, ocols)
