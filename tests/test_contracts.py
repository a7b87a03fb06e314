"""Every contract rule on the side where it fails."""

import pytest

from adlens.operators import contracts as K

SUMMARY = "total_rows bigint, start_date string, end_date string, campaigns_count bigint, invalid_rows bigint"
HYP = "hypothesis_id string, hypothesis_text string, category string, confidence_score double"
VAL = ("hypothesis_id string, hypothesis_text string, validation_status string, "
       "evidence_metrics array<struct<metric_name:string,value:double,comparison:string>>, adjusted_confidence_score double, "
       "p_value double, has_test boolean, ci_lower double, ci_upper double")
RECS = ("campaign string, current_ctr double, new_creatives array<struct<creative_message:string,creative_type:string,"
        "audience_type:string,rationale:string,confidence_score:double>>")
M2 = [("a", 1.0, "c"), ("b", 2.0, "c")]
GOOD = ("m", "video", "Broad", "r", 0.5)


def found(df):
    return {r.rule: r.violations for r in df.collect() if r.violations}


@pytest.mark.parametrize("row, rules", [
    ((1, "a", "b", 1, 0), {}), ((None, "a", "b", 1, 0), {"required_fields"}), ((1, None, "b", 1, 0), {"required_fields"}),
    ((1, "a", "b", -1, 0), {"non_negative_counts"}), ((-1, "a", "b", None, 0), {"required_fields", "non_negative_counts"})])
def test_summary(spark, row, rules):
    assert set(found(K.check_summary(spark.createDataFrame([row], SUMMARY)))) == set(rules)


@pytest.mark.parametrize("row, rules", [
    (("h", "t", "budget", 0.5), {}), ((None, "t", "budget", 0.5), {"required_fields"}), (("h", "t", "luck", 0.5), {"category_enum"}),
    (("h", "t", "budget", 1.1), {"confidence_range"}), (("h", "t", "budget", None), {"required_fields", "confidence_range"})])
def test_hypotheses(spark, row, rules):
    good = ("h", "t", "budget", 0.5)
    assert set(found(K.check_hypotheses(spark.createDataFrame([row, good, good], HYP)))) == set(rules)
    assert "min_count" in found(K.check_hypotheses(spark.createDataFrame([row, good], HYP)))


@pytest.mark.parametrize("change, rules", [
    ({}, {}), ({3: None}, {"required_fields", "min_metrics"}), ({3: M2[:1]}, {"min_metrics"}),
    ({3: [(None, 1.0, "c"), M2[0]]}, {"metric_fields"}), ({3: [("a", float("nan"), "c"), M2[0]]}, {"finite_statistics"}),
    ({2: "maybe"}, {"status_enum"}), ({4: -0.1}, {"confidence_range"}), ({5: 1.5}, {"p_value_range"}),
    ({7: None}, {"interval_pair"}), ({8: float("inf")}, {"finite_statistics"})])
def test_validated(spark, change, rules):
    row = ["h", "t", "confirmed", M2, 0.5, 0.05, True, 0.1, 0.2]
    for k, v in change.items():
        row[k] = v
    assert set(found(K.check_validated(spark.createDataFrame([tuple(row)], VAL)))) == set(rules)


@pytest.mark.parametrize("creatives, rules", [
    ([GOOD] * 3, {}), (None, {"required_fields", "min_variations"}), ([GOOD] * 2, {"min_variations"}),
    ([GOOD] * 2 + [("", *GOOD[1:])], {"non_empty_fields"}), ([GOOD] * 2 + [("m", None, *GOOD[2:])], {"non_empty_fields"}),
    ([GOOD] * 2 + [("m", "video", None, "r", 0.5)], {"non_empty_fields"}), ([GOOD] * 2 + [(*GOOD[:4], 3.0)], {"confidence_range"})])
def test_recommendations(spark, creatives, rules):
    assert set(found(K.check_recommendations(spark.createDataFrame([("c", 0.1, creatives)], RECS)))) == set(rules)


def test_absent_columns_are_one_violation_even_on_empty_tables(spark):
    empty = spark.createDataFrame([], "hypothesis_id string, category string")
    got = found(K.check_hypotheses(empty))
    assert got["required_fields"] == 1 and got["confidence_range"] == 1 and got["min_count"] == 1
    assert found(K.check_recommendations(spark.createDataFrame([], "campaign string")))["required_fields"] == 1


def test_timestamps_and_metrics(spark):
    stamps = spark.createDataFrame([(x,) for x in ("2025-01-01T00:00:00Z", "2025-01-01", "2025-01-01T00:00:00+02:00", "soon",
                                                   "2025-13-01T00:00:00Z", None)], "timestamp string")
    assert found(K.check_timestamp(stamps, "timestamp", "x")) == {"iso_timestamp": 3}
    metrics = spark.createDataFrame([(1.0, float("inf"), 1.0, None)],
                                    "overall_roas double, overall_ctr double, avg_cpc double, conversion_rate double")
    assert set(found(K.check_metrics(metrics))) == {"required_fields", "finite_metrics"}
