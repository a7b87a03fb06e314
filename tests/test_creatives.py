import pytest
from pyspark.sql import functions as F

from adlens.operators import creatives as C
from adlens.operators import segments as S
from adlens.params import Params
from tests.conftest import fact_frame


def test_modes_ties_smallest(spark):
    rows = [("K", "2024-01-01", 1.0, 100, 1, 1.0, 0, t, a, "F") for t, a in
            [("video", "x"), ("image", "y"), ("video", "y"), ("image", "x"), ("carousel", None)]]
    modes = C.campaign_modes(fact_frame(spark, rows)).collect()[0]
    assert modes.mode_creative_type == "image"       # image and video tie at 2 -> smallest
    assert modes.mode_audience_type == "x"           # x and y tie, NULL ignored
    assert modes.mode_creative_message == "msg image"


def test_audience_tag_rules(spark):
    df = spark.createDataFrame(
        [("Summer_Female_18-30", None), ("Brand_Female_25-34", None), ("Men_Male_18-24", None),
         ("Male_25-40", None), ("Promo", "seniors"), ("Promo", None), ("Female_31-45", None)],
        "name string, mode string")
    got = [r.t for r in df.select(C.audience_tag(F.col("name"), F.col("mode")).alias("t")).collect()]
    # "female" contains "male": Female_25-34 falls through to the male 25 rule (substring semantics)
    assert got == ["female_18_30", "male_25_40", "male_18_24", "male_25_40", "seniors", "default", "female_31_45"]
    strict = [r.t for r in df.select(C.audience_tag(F.col("name"), F.col("mode"), False).alias("t")).collect()]
    assert strict[1] == "default"


def test_variations_for_low_ctr_campaigns(spark):
    rows = []
    for i in range(12):
        rows.append(("Low_Female_18-30", f"2024-01-{i + 1:02d}", 10.0, 1000, 5, 20.0, 0, "image", "aud", "F"))
        rows.append(("High", f"2024-01-{i + 1:02d}", 10.0, 1000, 30, 50.0, 1, "video", "aud", "F"))
        rows.append(("High", f"2024-01-{i + 1:02d}", 10.0, 1000, 20, 50.0, 1, "carousel", "aud", "F"))
    df = fact_frame(spark, rows)
    seg = S.segment_aggregates(df, moments=False)
    pipe = C.creative_pipeline(seg, df, Params())
    low = pipe["low_ctr"].collect()
    assert [(r.campaign, r.current_creative_type) for r in low] == [("Low_Female_18-30", "image")]
    cands = pipe["candidates"].collect()[0]
    assert cands.best_types == ["video", "carousel"]
    assert cands.candidate_types == ["video", "carousel", "collection"]
    assert cands.n_variations == 3 and cands.audience_type == "female_18_30"
    var = pipe["variations"].orderBy("i").collect()
    assert [v.creative_type for v in var] == ["video", "carousel", "collection"]
    assert [v.creative_message for v in var] == [
        "Trendy comfort meets style - 20% off", "Feel confident all day - Buy 1 Get 1",
        "Your perfect fit awaits - 30% off first order"]
    assert var[0].confidence_score == pytest.approx(0.9)          # rank 1 + history > 1.5x
    assert var[1].confidence_score == pytest.approx(0.8)
    assert var[2].confidence_score == pytest.approx(0.6)          # no history, not among best
    assert var[2].expected_ctr_improvement == pytest.approx(50.0)  # default 1.5 x current
    assert var[0].expected_ctr_improvement == 100.0               # clamped
    assert var[0].rationale == ("Switching from image to video format, video is among top-performing "
                                "creative types, tailored for female_18_30 audience, expected to improve CTR by 100%.")
    assert len({v.creative_id for v in var}) == 3
    rec = C.recommendations(pipe["variations"]).collect()[0]
    assert len(rec.new_creatives) == 3 and rec.new_creatives[0].creative_type == "video"


def test_high_ctr_messages_and_p75(spark, facts):
    import numpy as np
    p = C.ctr_p75(facts).collect()[0]
    ctr = np.array([r.ctr for r in facts.select("ctr").collect() if r.ctr is not None])
    assert p.ctr_p75 == pytest.approx(float(np.quantile(ctr, 0.75)), rel=1e-12)
    top = C.high_ctr_messages(facts).collect()
    assert [r.rank for r in top] == [1, 2, 3]
    assert [r.rows for r in top] == sorted((r.rows for r in top), reverse=True)


def test_a_message_for_every_row_leaves_the_cube_small(facts):
    own = facts.withColumn("creative_message", F.concat(F.lit("m"), F.col("row_ord").cast("string"), F.monotonically_increasing_id()))
    assert S.fact_cube(own, include_daily=True).count() == S.fact_cube(facts, include_daily=True).count()
    modes = {r.campaign_name: r.mode_creative_message for r in C.campaign_modes(own).collect()}
    first = {r.campaign_name: r.m for r in own.groupBy("campaign_name").agg(F.min("creative_message").alias("m")).collect()}
    assert len(modes) == 101 and set(modes) == set(first)
    assert all(m.startswith("m") for m in modes.values())
