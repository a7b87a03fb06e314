"""Views, commits and CSV details over small files."""

import os

import pytest

from adlens.operators import cleaning as Q
from adlens.sources import readers, views
from adlens.sources.commits import Commits

HEAD = "campaign_name,date,spend,impressions,clicks,revenue\n"


def put(folder, name, lines, head=HEAD):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(head + "".join(x + "\n" for x in lines))


def rows(df):
    return sorted(tuple(r) for r in df.select("campaign_name", "spend").collect())


def test_second_load_reads_no_raw_file_and_an_appended_file_is_seen(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "view")
    put(raw, "a.csv", ["A,2024-01-01,1,1,1,1", "B,nonsense,2,1,1,1", "C,2024-01-02,x,1,1,1", "D,2024-01-02,,1,1,1"])
    first = views.load(spark, raw, root)
    assert not first.reused and rows(first.clean) == [("A", 1.0), ("C", None)]
    again = views.load(spark, raw, root)
    assert again.reused and again.folder == first.folder
    assert all(f.startswith(f"file://{root}") for df in (again.clean, again.issues, again.counts) for f in df.inputFiles())
    issues = [(r["issue_type"], r["field"], r["count"], [(e["row"], e["value"]) for e in r["examples"]])
              for r in again.issues.orderBy("ord").collect()]
    assert issues == [("missing_values", "spend", 1, []), ("invalid_dates", None, 1, [(1, "nonsense")]),
                      ("non_numeric_values", "spend", 1, [(None, "x")])]
    assert again.counts.first().asDict()["clean_rows"] == 2
    put(raw, "b.csv", ["E,2024-01-03,5,1,1,1"])
    third = views.load(spark, raw, root)
    assert not third.reused and rows(third.clean) == [("A", 1.0), ("C", None), ("E", 5.0)]
    assert rows(first.clean) == [("A", 1.0), ("C", None)]                       # a reader of the former view goes on
    os.utime(os.path.join(raw, "a.csv"), (1, 1))
    assert not views.load(spark, raw, root).reused                              # replaced, same length
    assert views.load(spark, raw, root).reused


def test_parameters_are_part_of_the_key(spark, tmp_path):
    from adlens.params import Params
    raw, root = str(tmp_path / "raw"), str(tmp_path / "view")
    put(raw, "a.csv", ["A,2024-01-01,1,1,1,1", "B,03/01/2024,1,1,1,1"])
    assert rows(views.load(spark, raw, root).clean) == [("A", 1.0)]
    other = views.load(spark, raw, root, Params(date_format="%d/%m/%Y"))
    assert not other.reused and rows(other.clean) == [("B", 1.0)]


def test_a_missing_share_above_the_limit_stops_before_the_commit(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "view")
    put(raw, "a.csv", [f"A,2024-01-01,{i},1,1,1" for i in range(9)] + ["B,2024-01-01,,1,1,1"])
    assert not views.load(spark, raw, root, max_missing=0.10).reused            # a tenth is not above a tenth
    put(raw, "b.csv", ["B,2024-01-01,,1,1,1"])
    with pytest.raises(Q.MissingShareError) as e:
        views.load(spark, raw, root, max_missing=0.10)
    assert set(e.value.shares) == {"spend"} and abs(e.value.shares["spend"] - 2 / 11) < 1e-12
    assert len(rows(spark.read.parquet(Commits(spark, root).latest()[0] + "/clean"))) == 9
    assert len(rows(views.load(spark, raw, root).clean)) == 9


def test_a_file_that_changes_while_it_is_read_is_loaded_again(spark, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "view")
    put(raw, "a.csv", ["A,2024-01-01,1,1,1,1"])
    issues = Q.quality_issues
    appended = []

    def slow(*a, **k):
        if not appended:
            appended.append(put(raw, "b.csv", ["B,2024-01-01,2,1,1,1"]))
        return issues(*a, **k)

    monkeypatch.setattr(Q, "quality_issues", slow)
    assert rows(views.load(spark, raw, root).clean) == [("A", 1.0), ("B", 2.0)]


def test_missing_files(spark, tmp_path):
    with pytest.raises(readers.DatasetError):
        views.load(spark, str(tmp_path / "none"), str(tmp_path / "view"))


def test_a_failed_write_leaves_the_former_commit(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "out"))
    assert commits.latest() is None and commits.drop_older() == 0

    def good(folder):
        spark.range(3).write.parquet(f"{folder}/t")
        return {"rows": 3}

    def bad(folder):
        spark.range(5).write.parquet(f"{folder}/t")
        raise RuntimeError("lost")

    folder, _ = commits.write("k", good)
    with pytest.raises(RuntimeError):
        commits.write("k", bad)
    assert commits.latest("k") == (folder, {"rows": 3}) and commits.latest("other") is None
    second, _ = commits.write("k", good)
    third, _ = commits.write("j", good)
    assert commits.latest()[0] == third and commits.latest("k")[0] == second
    assert commits.drop_older(keep=2) == 1 and spark.read.parquet(f"{second}/t").count() == 3
    assert not os.path.exists(folder)


def test_quotes_and_line_breaks(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "a.csv", ['"say ""hi"", twice",2024-01-01,1,1,1,1', '"two\nlines, one row",2024-01-01,2,1,1,1'])
    got = rows(readers.load_strict(spark, raw, multi_line=True).clean)
    assert got == [('say "hi", twice', 1.0), ("two\nlines, one row", 2.0)]


def test_short_and_long_lines(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "a.csv", ["A,2024-01-01,1,1,1,1", "short,2024-01-01,1", "long,2024-01-01,2,1,1,1,extra", "empty,2024-01-01,3,1,1,1,"])
    assert rows(readers.load_lenient(spark, raw)) == [("A", 1.0), ("empty", 3.0), ("long", 2.0), ("short", 1.0)]
    assert rows(readers.load_lenient(spark, raw, too_long="drop")) == [("A", 1.0), ("short", 1.0)]
    with pytest.raises(Exception, match="more than 6 fields: long"):
        readers.load_lenient(spark, raw, too_long="fail").collect()
    put(str(tmp_path / "fine"), "a.csv", ["A,2024-01-01,1,1,1,1", "short,2024-01-01,1"])
    assert len(rows(readers.load_lenient(spark, str(tmp_path / "fine"), too_long="fail"))) == 2


def test_issues_of_an_empty_table(spark):
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("campaign_name", "date", "spend", "impressions", "clicks", "revenue")))
    c = Q.clean(raw)
    assert c.issues.collect() == []
    clean, counts = Q.load_clean(c.flags, c.numeric_fields, c.required, max_missing=0.1)
    assert clean.count() == 0 and counts.first().raw_rows == 0


def test_a_third_of_all_rows_failing(spark):
    n = 30_000
    raw = spark.range(n).selectExpr("'A' AS campaign_name", "IF(id % 3 = 0, concat('d', id), '2024-01-01') AS date",
                                    "IF(id % 3 = 1, concat('s', id), '1') AS spend", "'1' AS impressions", "'1' AS clicks",
                                    "IF(id % 10 = 9, NULL, '1') AS revenue", "id AS row_ord").repartition(7)
    issues = {(r["issue_type"], r["field"]): r for r in Q.clean(raw).issues.collect()}
    kept = [i for i in range(n) if i % 10 != 9]
    dates = issues["invalid_dates", None]
    assert dates["count"] == sum(i % 3 == 0 for i in kept)
    assert [(e["row"], e["value"]) for e in dates["examples"]] == [(kept.index(i), f"d{i}") for i in kept if i % 3 == 0][:5]
    assert [e["value"] for e in issues["non_numeric_values", "spend"]["examples"]] == ["s1", "s4", "s7", "s10", "s13"]


def test_a_number_is_matched_once(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(raw, "a.csv", ["A,2024-01-01,1,1,1,1", "long,2024-01-01,2,1,1,1,extra", "inf,2024-01-01,-Inf,nan,1e1,0x1p3"])
    found = readers.load_lenient(spark, raw, too_long="drop")
    assert found._jdf.queryExecution().executedPlan().toString().count("RLIKE") == 4
    got = [tuple(r) for r in found.select("spend", "impressions", "clicks", "revenue").orderBy("spend").collect()]
    assert got == [(float("-inf"), None, 10.0, None), (1.0, 1.0, 1.0, 1.0)]
