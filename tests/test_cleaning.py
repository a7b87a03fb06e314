import os
import tempfile

import pytest

from adlens.operators import cleaning as Q
from adlens.params import Params
from adlens.sources import readers

HEADER = "campaign_name,date,spend,impressions,clicks,revenue,creative_type,purchases\n"
LINES = [
    "A,2024-01-01,10.5,100,5,20,image,1",
    "A,2024-01-02,,100,5,20,image,1",          # missing spend -> excluded
    "B,invalid-date,3,100,5,NA,video,0",       # missing revenue (NA marker) -> excluded first
    "B,2024-13-01,3,100,5,9,video,0",          # invalid date -> excluded
    "C,2024-01-03,not-a-number,100,5,9,video,2",  # non-numeric spend -> kept as NULL
    "C,2024-01-04,7,1e3,x,9,carousel,abc",     # non-numeric clicks and purchases
    "D,2024/01/05,1,1,1,1,image,1",            # wrong format -> invalid date
    "D,2024-01-06,1,1,1,1,image,1",
]


@pytest.fixture(scope="module")
def csv_path():
    d = tempfile.mkdtemp(prefix="adlens-test-")
    p = os.path.join(d, "ads.csv")
    with open(p, "w") as f:
        f.write(HEADER + "\n".join(LINES) + "\n")
    return p


def test_strict_load_rules(spark, csv_path):
    c = readers.load_strict(spark, csv_path)
    prof = c.profile.collect()[0]
    assert prof.raw_rows == 8
    assert prof.missing_spend == 1 and prof.missing_revenue == 1
    assert prof.date_failures == 2
    assert prof.nonnum_spend == 1 and prof.nonnum_clicks == 1 and prof.nonnum_purchases == 1
    assert prof.clean_rows == 4
    issues = c.issues.orderBy("ord").collect()
    assert [(r.issue_type, r.field, r["count"]) for r in issues] == [
        ("missing_values", "spend", 1), ("missing_values", "revenue", 1),
        ("invalid_dates", None, 2),
        ("non_numeric_values", "spend", 1), ("non_numeric_values", "clicks", 1),
        ("non_numeric_values", "purchases", 1)]
    dates = [r for r in issues if r.issue_type == "invalid_dates"][0]
    # rows are positions after the missing-value drop: 0 A, 1 B(13-01), 2 C, 3 C, 4 D(2024/01/05)
    assert [(e.row, e.value) for e in dates.examples] == [(1, "2024-13-01"), (4, "2024/01/05")]
    nn = {r.field: [e.value for e in r.examples] for r in issues if r.issue_type == "non_numeric_values"}
    assert nn == {"spend": ["not-a-number"], "clicks": ["x"], "purchases": ["abc"]}
    clean = {(r.campaign_name, str(r.date)): r for r in c.clean.collect()}
    assert len(clean) == 4
    assert clean[("C", "2024-01-03")].spend is None
    assert clean[("C", "2024-01-04")].impressions == 1000.0
    inv = Q.invalid_rows(c.profile, c.numeric_fields, c.required).collect()[0]
    assert inv.invalid_rows == 7 and inv.rows_removed == 4


def test_required_columns_listed(spark):
    df = spark.createDataFrame([("a", "2024-01-01")], "campaign_name string, date string")
    with pytest.raises(Q.MissingColumnsError) as e:
        Q.clean(df, Params())
    assert e.value.missing_fields == ["spend", "impressions", "clicks", "revenue"]


def test_missing_and_empty_files(spark):
    with pytest.raises(readers.DatasetError):
        readers.read_raw_csv(spark, "/nonexistent/path/ads.csv")
    d = tempfile.mkdtemp(prefix="adlens-test-")
    p = os.path.join(d, "empty.csv")
    open(p, "w").close()
    with pytest.raises((readers.DatasetError, Q.MissingColumnsError)):
        readers.load_strict(spark, p)


def test_lenient_keeps_every_row(spark, csv_path):
    df = readers.load_lenient(spark, csv_path)
    assert df.count() == 8
    assert dict(df.dtypes)["spend"] == "double"


def test_custom_date_format(spark):
    rows = [("A", "05/01/2024", "1", "1", "1", "1"), ("A", "2024-01-05", "1", "1", "1", "1")]
    raw = spark.createDataFrame(rows, "campaign_name string, date string, spend string, impressions string, "
                                      "clicks string, revenue string")
    c = Q.clean(raw, Params(date_format="%d/%m/%Y"))
    got = [str(r.date) for r in c.clean.collect()]
    assert got == ["2024-01-05"]


def test_dirty_fixture_counts(spark):
    from adlens.sources.facts import raw_ad_rows
    c = Q.clean(raw_ad_rows(spark, "/root/testdata/sf0.001"))
    p = c.profile.collect()[0]
    assert p.raw_rows == 6000
    assert p.raw_rows - p.clean_rows == p.missing_revenue + p.date_failures


def test_only_decimal_numbers_are_numbers(spark):
    bad = ["12d", "12f", "0x1p3", "1_000", "1e", ".", "+", "١٢", "1,5", "--1", "abc"]
    good = {"12": 12.0, " 1.5 ": 1.5, "+.5": 0.5, "-2.": -2.0, "1E3": 1000.0, "1e-2": 0.01}
    rows = [("A", "2024-01-01", v, "1", "1", "1") for v in [*bad, *good]]
    raw = spark.createDataFrame(rows, "campaign_name string, date string, spend string, impressions string, "
                                      "clicks string, revenue string")
    c = Q.clean(raw)
    assert c.profile.first().nonnum_spend == len(bad)
    assert sorted(r.spend for r in c.clean.where("spend is not null").collect()) == sorted(good.values())


def test_examples_follow_file_order(spark):
    """A small first file and a large second one, which Spark reads first."""
    d = tempfile.mkdtemp(prefix="adlens-test-")
    head = "campaign_name,date,spend,impressions,clicks,revenue\n"
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(head + "A,from-a,1,1,1,1\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write(head + "".join(f"B,from-b{i},x{i},1,1,1\n" for i in range(2000)))
    c = readers.load_strict(spark, d)
    dates = c.issues.where("issue_type = 'invalid_dates'").first().examples
    assert [(e.row, e.value) for e in dates] == [(0, "from-a")] + [(i + 1, f"from-b{i}") for i in range(4)]


def test_appended_files_are_seen(spark):
    from adlens.sources.facts import table
    d = tempfile.mkdtemp(prefix="adlens-test-")
    spark.range(5).write.parquet(f"{d}/t.parquet")
    assert table(spark, d, "t").count() == 5
    spark.range(7).write.mode("append").parquet(f"{d}/t.parquet")
    assert table(spark, d, "t").count() == 12


TWIN_TABLES = {
    "nation": (["(0, 'N0')"], "n_nationkey bigint, n_name string"),
    "customer": (["(1, 0, 'BUILDING')"], "c_custkey bigint, c_nationkey bigint, c_mktsegment string"),
    "part": (["(1, 'p1', 'Brand#1', 4)", "(2, 'p2', 'Brand#2', 5)", "(1048577, 'p3', 'Brand#3', 6)"],
             "p_partkey bigint, p_name string, p_brand string, p_size bigint"),
    "orders": (["(5, 1)", "(89, 1)"], "o_orderkey bigint, o_custkey bigint"),
    "lineitem": ([f"({o}, {p}, 3, 1, 2.0D, 10.0D, 0.5D, {t}D, 'A', 'O', timestamp'1996-01-0{d} 00:00:00')"
                  for o, p, t, d in [(5, 1, 0.1, 2), (5, 1, 0.1, 2), (5, 1048577, 0.1, 1), (5, 2, 0.2, 3), (89, 1, 0.1, 1), (89, 1, 0.1, 1)]],
                 "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
}


@pytest.fixture(scope="module")
def repeated_lines(spark, tmp_path_factory):
    """Tables in which lines share their order, number, part and supplier (or parts that are 2 ** 20 apart)."""
    folder = str(tmp_path_factory.mktemp("lines"))
    for name, (rows, schema) in TWIN_TABLES.items():
        names = [c.split()[0] for c in schema.split(", ")]
        spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(names)})").write.parquet(f"{folder}/{name}.parquet")
    return folder


def _as_sql_says(spark, folder, name):
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in TWIN_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    df = E.queries()[name](spark, folder)
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want.fetchall()))
    return got, cols.index("row_ord")


def test_scan_clean_numbers_lines_that_share_everything(spark, repeated_lines):
    got, at = _as_sql_says(spark, repeated_lines, "scan_clean")
    assert sorted(r[at] for r in got) == [41001, 41002, 41003, 41004]


def test_lenient_scan_numbers_lines_that_share_everything(spark, repeated_lines):
    got, at = _as_sql_says(spark, repeated_lines, "lenient_scan")
    assert sorted(r[at] for r in got) == [41001, 41002, 41003, 41004, 713001, 713002]
