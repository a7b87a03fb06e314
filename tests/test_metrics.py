import math

import pytest
from pyspark.sql import functions as F

from adlens.operators import metrics as M
from adlens.operators import segments as S
from adlens.params import Params
from tests.conftest import fact_frame

ROWS = [
    # campaign, date, spend, impr, clicks, revenue, purchases, type, audience, platform
    ("A", "2024-01-01", 100.0, 1000, 10, 300.0, 1, "image", "a1", "Facebook"),
    ("A", "2024-01-02", 50.0, 500, 5, 50.0, 0, "video", "a1", "Instagram"),
    ("B", "2024-01-08", 0.0, 0, 0, 10.0, 0, "image", "a2", "Facebook"),
    ("B", "2024-01-09", 200.0, 2000, 40, 200.0, 2, "carousel", None, "Facebook"),
    ("C", "2024-02-05", 100.0, 1000, 30, 500.0, 3, "video", "a2", "Instagram"),
    ("C", "2024-02-06", 50.0, 1000, 10, 100.0, 1, "image", "a1", "Instagram"),
]


@pytest.fixture(scope="module")
def small(spark):
    return fact_frame(spark, ROWS)


def test_summary_and_overall(small):
    s = M.dataset_summary(small).collect()[0]
    assert s.total_rows == 6 and s.campaigns_count == 3
    assert str(s.start_date) == "2024-01-01" and str(s.end_date) == "2024-02-06"
    assert s.total_spend == pytest.approx(500.0) and s.total_revenue == pytest.approx(1160.0)
    m = M.overall_metrics(small).collect()[0]
    assert m.overall_roas == pytest.approx(1160 / 500)
    assert m.overall_ctr == pytest.approx(95 / 5500)
    assert m.avg_cpc == pytest.approx(500 / 95)
    assert m.conversion_rate == pytest.approx(7 / 95)


def test_guarded_ratio_zero_denominator(spark):
    df = fact_frame(spark, [("Z", "2024-01-01", 0.0, 0, 0, 5.0, 0, "image", "x", "Facebook")])
    m = M.overall_metrics(df).collect()[0]
    assert (m.overall_roas, m.overall_ctr, m.avg_cpc, m.conversion_rate) == (0.0, 0.0, 0.0, 0.0)
    seg = S.segment_by(df, "campaign_name").collect()[0]
    assert seg.roas == 0.0 and seg.ctr == 0.0


def test_weeks_start_monday_and_period_ratio_null(small):
    wk = {str(r.period): r for r in M.period_metrics(small, "week").collect()}
    # 2024-01-01 is a Monday; 2024-01-08/09 are the next week; 2024-02-05 is a Monday
    assert sorted(wk) == ["2024-01-01", "2024-01-08", "2024-02-05"]
    assert wk["2024-01-01"].spend == pytest.approx(150.0)
    mo = {str(r.period): r for r in M.period_metrics(small, "month").collect()}
    assert sorted(mo) == ["2024-01-01", "2024-02-01"]


def test_trend_changes_last_two_observed_periods(small):
    t = M.trend_changes(small).collect()[0]
    # weeks: 2024-01-08 (spend 200, revenue 210) then 2024-02-05 (spend 150, revenue 600): gap not filled
    prev, last = 210 / 200, 600 / 150
    assert t.roas_wow == pytest.approx((last - prev) / prev * 100)
    # months: Jan (350 spend, 560 rev) -> Feb (150, 600)
    assert t.roas_mom == pytest.approx((600 / 150 - 560 / 350) / (560 / 350) * 100)
    rows = {r.metric: r for r in M.trends(small).collect()}
    assert rows["roas"].direction == "increasing"


def test_trend_single_period_and_empty(spark):
    one = fact_frame(spark, [("A", "2024-01-03", 10.0, 100, 1, 20.0, 0, "image", "x", "Facebook")])
    rows = M.trends(one).collect()
    assert {r.metric: (r.week_over_week_change, r.month_over_month_change, r.direction) for r in rows} == {
        "roas": (0.0, 0.0, "stable"), "ctr": (0.0, 0.0, "stable")}
    assert M.trends(one.where("false")).collect() == []


def test_direction_mixed_signs_is_increasing(spark):
    from adlens.functions.ratios import trend_direction
    df = spark.createDataFrame([(-40.0, 1.0), (-10.0, -2.0), (1.0, 2.0), (None, 20.0)], "w double, m double")
    got = [r.d for r in df.select(trend_direction(F.col("w"), F.col("m"), 0.05).alias("d")).collect()]
    assert got == ["increasing", "decreasing", "stable", "stable"]


def test_segments_one_pass_matches_per_dimension(small):
    long = S.segments(small).collect()
    by_dim = {}
    for r in long:
        by_dim.setdefault(r.dimension, []).append(r)
    assert set(by_dim) == {"campaign_name", "creative_type", "audience_type", "platform"}
    # NULL audience value is skipped
    assert {r.value for r in by_dim["audience_type"]} == {"a1", "a2"}
    for dim, rows in by_dim.items():
        single = S.segment_by(small, dim).collect()
        assert [(r[dim], r.spend, r.clicks) for r in single] == [(r.value, r.spend, r.clicks) for r in rows]
        # sorted by spend descending
        assert [r.spend for r in rows] == sorted((r.spend for r in rows), reverse=True)


def test_best_worst_ties_follow_spend_then_value(spark):
    rows = [("X", "2024-01-01", 100.0, 100, 1, 100.0, 0, "image", "p", "F"),
            ("Y", "2024-01-01", 200.0, 100, 1, 200.0, 0, "image", "p", "F"),
            ("Z", "2024-01-01", 100.0, 100, 1, 300.0, 0, "image", "p", "F")]
    seg = S.segment_aggregates(fact_frame(spark, rows), dims=("campaign_name",), moments=False)
    bw = S.best_worst(seg).collect()[0]
    # X and Y tie on roas 1.0: worst is the higher-spend one (Y); best is Z
    assert bw.worst_value == "Y" and bw.best_value == "Z" and bw.n_segments == 3


def test_missing_by_column(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, y string, z string")
    got = {r.field: r.missing for r in M.missing_by_column(df).collect()}
    assert got == {"x": 1, "y": 2}


def test_exact_cents_match_double_path(facts):
    a = M.dataset_summary(facts).collect()[0]
    b = M.dataset_summary(facts.drop("spend_cents", "revenue_cents")).collect()[0]
    assert math.isclose(a.total_spend, b.total_spend, rel_tol=1e-12)
    assert a.total_rows == b.total_rows == 6000
    assert Params().spark_date_format == "yyyy-MM-dd"


def test_period_mean_of_raw_column(small):
    got = {str(r.period): r.mean_ctr for r in M.period_mean(small, "week", "ctr").collect()}
    assert got["2024-01-01"] == pytest.approx((10 / 1000 + 5 / 500) / 2)
    assert got["2024-01-08"] == pytest.approx(40 / 2000)      # zero-impression row has NULL ctr
