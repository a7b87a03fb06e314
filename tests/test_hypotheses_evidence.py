import pytest
from pyspark.sql import functions as F

from adlens.operators import evidence as E
from adlens.operators import hypotheses as H
from adlens.params import Params

SEG_SCHEMA = ("dimension string, value string, spend double, revenue double, roas double, impressions bigint, "
              "clicks bigint, ctr double, ctr_n bigint, ctr_mean double, ctr_var double, roas_n bigint, "
              "roas_mean double, roas_var double")


def seg_frame(spark, rows):
    return spark.createDataFrame(rows, SEG_SCHEMA)


def metrics_frame(spark, roas, ctr):
    return spark.createDataFrame([(roas, ctr, 1.0, 0.1)], "overall_roas double, overall_ctr double, "
                                                          "avg_cpc double, conversion_rate double")


def trends_frame(spark, roas=(0.0, 0.0), ctr=(0.0, 0.0)):
    return spark.createDataFrame(
        [("roas", "stable", *roas), ("ctr", "stable", *ctr)],
        "metric string, direction string, week_over_week_change double, month_over_month_change double")


SEG = [
    ("campaign_name", "C1", 100.0, 100.0, 1.0, 1000, 10, 0.01, 20, 0.01, 1e-5, 20, 1.0, 0.04),
    ("campaign_name", "C2", 300.0, 900.0, 3.0, 1000, 10, 0.01, 20, 0.01, 1e-5, 20, 3.0, 0.04),
    ("creative_type", "image", 200.0, 500.0, 2.5, 10000, 50, 0.005, 30, 0.005, 1e-6, 30, 2.5, 0.2),
    ("creative_type", "video", 200.0, 500.0, 2.5, 10000, 200, 0.02, 30, 0.02, 1e-6, 30, 2.5, 0.2),
    ("audience_type", "old", 200.0, 200.0, 1.0, 1000, 10, 0.01, 25, 0.01, 1e-5, 25, 1.0, 0.3),
    ("audience_type", "young", 200.0, 800.0, 4.0, 1000, 10, 0.01, 25, 0.01, 1e-5, 25, 4.0, 0.3),
    ("platform", "Facebook", 200.0, 600.0, 3.0, 1000, 10, 0.01, 5, 0.01, 1e-5, 5, 3.0, 0.1),
    ("platform", "Instagram", 200.0, 400.0, 2.0, 1000, 10, 0.01, 5, 0.01, 1e-5, 5, 2.0, 0.1),
]


@pytest.fixture(scope="module")
def inputs(spark):
    return metrics_frame(spark, 2.5, 0.0125), trends_frame(spark, (-20.0, 4.0), (3.0, -1.0)), seg_frame(spark, SEG)


def test_generators_order_texts_and_scores(inputs):
    m, t, s = inputs
    rows = H.hypotheses(m, t, s).orderBy("ord").collect()
    assert [(r.ord, r.category, r.subject) for r in rows] == [
        (1, "seasonality", "roas"), (3, "budget", "C1"), (4, "creative", "image"), (5, "audience", "old"),
        (6, "platform", "Instagram")]
    assert rows[0].hypothesis_text == "ROAS declined due to trend (WoW: -20.0%, MoM: 4.0%)"
    assert rows[0].confidence_score == pytest.approx(0.3 + min(24 / 20, 1) * 0.5)
    assert rows[1].hypothesis_text == "Campaign 'C1' underperformance (ROAS: 1.00) is dragging down overall ROAS"
    assert rows[1].confidence_score == pytest.approx(0.3 + min(1.5 / 2.5 * 100 / 50, 1) * 0.5)
    assert rows[1].supporting_observations[1] == "Number of underperforming campaigns: 1"
    assert rows[2].hypothesis_text == "'image' creative type underperforming with CTR of 0.0050 vs overall 0.0125"
    # platform gap 3.0 vs 2.0 is > 20 %; it is the 5th generated row, within max_hypotheses=5
    assert len({r.hypothesis_id for r in rows}) == len(rows)


def test_platform_and_limit_and_padding(spark, inputs):
    m, t, s = inputs
    allh = H.hypotheses(m, t, s, Params(max_hypotheses=4)).orderBy("ord").collect()
    assert [r.ord for r in allh] == [1, 3, 4, 5]
    allh = H.hypotheses(m, t, s, Params(max_hypotheses=10)).orderBy("ord").collect()
    assert [r.ord for r in allh] == [1, 3, 4, 5, 6]
    assert allh[-1].hypothesis_text == "Platform 'Instagram' (ROAS: 2.00) underperforming compared to 'Facebook' (ROAS: 3.00)"
    two = H.hypotheses(m, t, s, Params(max_hypotheses=2)).orderBy("ord").collect()
    assert [(r.ord, r.category) for r in two] == [(1, "seasonality"), (3, "budget"), (102, "budget")]
    empty = H.hypotheses(m, trends_frame(spark), s.where("false")).orderBy("ord").collect()
    assert [r.hypothesis_text for r in empty] == [
        "Seasonal factors may be influencing ROAS performance",
        "Ad fatigue may be contributing to ROAS changes",
        "Market competition changes may be affecting ROAS"]
    assert [r.confidence_score for r in empty] == [0.4, 0.35, 0.3]


def test_evidence_statuses_tests_and_scores(inputs):
    m, t, s = inputs
    ev = {r.category: r for r in E.evidence_by_category(s, m, t).collect()}
    assert ev["creative"].validation_status == "confirmed"          # 0.015 > 0.002
    assert ev["audience"].validation_status == "confirmed"          # 3.0 > 0.5
    assert ev["platform"].validation_status == "confirmed"          # 1.0 > 0.3
    assert ev["budget"].validation_status == "confirmed"
    assert ev["seasonality"].validation_status == "confirmed"       # (20 + 4) / 2 > 10
    assert ev["generic"].validation_status == "inconclusive"
    assert ev["creative"].has_test and ev["audience"].has_test
    assert not ev["platform"].has_test                              # 5 < min_data_points
    assert not ev["budget"].has_test
    assert [x.metric_name for x in ev["budget"].metrics] == [
        "worst_campaign_roas", "best_campaign_roas", "worst_campaign_spend"]
    assert ev["budget"].metrics[2].comparison == "Spend on worst campaign: $100.00"
    assert 0 <= ev["creative"].p_value < 0.05


def test_validation_invariants(inputs):
    m, t, s = inputs
    h = H.hypotheses(m, t, s)
    v = E.validate(h, E.evidence_by_category(s, m, t)).orderBy("rank").collect()
    scores = [r.adjusted_confidence_score for r in v]
    assert scores == sorted(scores, reverse=True)
    assert [r.rank for r in v] == list(range(1, len(v) + 1))
    for r in v:
        assert 0.0 <= r.adjusted_confidence_score <= 1.0
        assert len(r.evidence_metrics) >= 2
        if r.validation_status == "rejected":
            assert r.adjusted_confidence_score < 0.6
        if r.validation_status == "confirmed":
            assert r.adjusted_confidence_score >= 0.3
        exp = 0.4 * r.initial_confidence + 0.4 * r.validation_strength + 0.2 * r.segmentation_evidence
        assert r.adjusted_confidence_score == pytest.approx(exp)
    creative = [r for r in v if r.category == "creative"][0]
    assert creative.validation_strength == pytest.approx(0.9)       # confirmed + p < 0.05
    assert creative.validation_reasoning.startswith("Hypothesis validation: confirmed. Analyzed 2 metrics. "
                                                    "Worst performing creative type: image. ")
    top = E.top_insights(E.validate(h, E.evidence_by_category(s, m, t))).collect()
    assert len(top) == 3


def test_unknown_category_gets_generic_evidence(spark, inputs):
    m, t, s = inputs
    h = spark.createDataFrame([("x", 1, "odd one", "weather", 0.5)],
                              "hypothesis_id string, ord int, hypothesis_text string, category string, "
                              "confidence_score double")
    v = E.validate(h, E.evidence_by_category(s, m, t)).collect()[0]
    assert v.validation_status == "inconclusive"
    assert [x.metric_name for x in v.evidence_metrics] == ["overall_roas", "overall_ctr"]


def test_single_segment_is_inconclusive(spark):
    s = seg_frame(spark, [SEG[2]])
    ev = {r.category: r for r in E.evidence_by_category(s, metrics_frame(spark, 2.0, 0.01),
                                                          trends_frame(spark)).collect()}
    c = ev["creative"]
    assert c.validation_status == "inconclusive" and not c.has_test
    assert [(x.metric_name, x.value) for x in c.metrics] == [("creative_segments_count", 1.0), ("overall_ctr", 0.01)]
    assert ev["seasonality"].validation_status == "rejected"


def test_status_counts(inputs):
    m, t, s = inputs
    v = E.validate(H.hypotheses(m, t, s), E.evidence_by_category(s, m, t))
    c = E.status_counts(v).collect()[0]
    assert c.validated == c.confirmed + c.rejected + c.inconclusive
    assert c.validated == c.high_confidence + c.medium_confidence + c.low_confidence
