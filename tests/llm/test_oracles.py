"""Corpus queries that SQL can express, against DuckDB on the given small tables; the others run whole."""

import duckdb
import pytest

import __spark_entry__ as E
from adlens.llm.oracles import ORACLES
from adlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_all_operators_and_the_pipeline_are_registered():
    names = set(QUERIES)
    assert names <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in res.fetchall())
    assert sorted(names) == columns
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", ["op2_source_mixing", "op6_language_id", "op7_benchmark_decontamination", "op10_toxicity", "op13_lm_scoring"])
def test_query_returns_every_row(spark, name):
    df = QUERIES[name](spark, SF)
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    if name == "op6_language_id":
        rows += spark.read.parquet(f"{SF}/pages.parquet").count()
    assert df.count() == rows


def test_decontamination_equals_plain_search(spark):
    """Whole tables: every item that a document holds word for word is found."""
    from adlens.llm.decontaminate import normalised
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r["item_id"], normalised(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {d["doc_id"]: {k for k, t in items if t in normalised(d["text"])} for d in docs}
    got = {r["doc_id"]: set(r["item_ids"]) for r in QUERIES["op7_benchmark_decontamination"](spark, SF).collect()}
    assert all(want[d] <= got[d] for d in want) and sum(map(len, want.values())) > 0
