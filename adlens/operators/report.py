"""Report tables: executive summary, key insights, supporting metrics,
recommendation rows, and the per-step narrative texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.ratios import fmt, stripped

# non-printable characters: control/format/unassigned/surrogate/private,
# line and paragraph separators, and spaces other than the plain space
NON_PRINTABLE = r"[\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]"


def printable(c: Column) -> Column:
    """Ends stripped of white space first, then non-printable characters taken out."""
    return F.regexp_replace(stripped(c), NON_PRINTABLE, "")


def executive_summary(summary: DataFrame, validated: DataFrame, recs: DataFrame,
                      request_text: str | None = None) -> DataFrame:
    """One row: period, rows, spend, revenue, counts and the top insight.

    The validated table is reduced once to a struct scalar (count + first
    ranked hypothesis), the recommendations to a count.
    """
    v = validated.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("hypothesis_text", "adjusted_confidence_score"), F.col("rank")).alias("top"))
    ).scalar()
    n_recs = recs.select(F.count(F.lit(1))).scalar()
    return summary.select(
        F.lit(request_text).cast("string").alias("request"),
        "start_date", "end_date", "total_rows", "total_spend", "total_revenue",
        v.getField("n").alias("validated_hypotheses"),
        n_recs.alias("recommendation_sets"),
        v.getField("top").getField("hypothesis_text").alias("top_insight"),
        v.getField("top").getField("adjusted_confidence_score").alias("top_confidence"))


def confidence_labels(score: Column) -> tuple[Column, Column]:
    """(evaluation wording at 0.7/0.5, report wording at 0.8/0.6)."""
    evaluation = (F.when(score >= 0.7, F.lit("high")).when(score >= 0.5, F.lit("moderate"))
                  .otherwise(F.lit("low")))
    report = (F.when(score >= 0.8, F.lit("highly likely and actionable"))
              .when(score >= 0.6, F.lit("moderately valid, requires monitoring"))
              .otherwise(F.lit("low confidence insight")))
    return evaluation, report


def key_insights(validated: DataFrame, k: int = 3) -> DataFrame:
    ev, rp = confidence_labels(F.col("adjusted_confidence_score"))
    return validated.where(F.col("rank") <= k).select(
        "rank", "hypothesis_text", "adjusted_confidence_score", "validation_status",
        F.when(F.col("has_test"), F.col("p_value")).alias("p_value"),
        "validation_reasoning", ev.alias("evaluation_band"), rp.alias("report_band"))


def supporting_metrics(validated: DataFrame, k: int = 3) -> DataFrame:
    """Evidence rows of the top-k with cleaned, non-empty name and comparison."""
    ex = validated.where(F.col("rank") <= k).select(
        "rank", F.posexplode("evidence_metrics").alias("pos", "m"))
    return ex.select(
        "rank", "pos", printable(F.col("m.metric_name")).alias("metric_name"),
        F.col("m.value").alias("value"), printable(F.col("m.comparison")).alias("comparison")
    ).where((F.col("metric_name") != "") & (F.col("comparison") != ""))


def recommendation_rows(recs: DataFrame) -> DataFrame:
    ex = recs.select("campaign", "current_ctr", "current_creative_type",
                     F.posexplode("new_creatives").alias("pos", "c"))
    return ex.select("campaign", "current_ctr", "current_creative_type", (F.col("pos") + 1).alias("variation"),
                     F.col("c.creative_type").alias("creative_type"),
                     F.col("c.creative_message").alias("creative_message"),
                     F.col("c.audience_type").alias("audience_type"),
                     F.col("c.expected_ctr_improvement").alias("expected_ctr_improvement"),
                     F.col("c.confidence_score").alias("confidence_score"),
                     F.col("c.rationale").alias("rationale"))


def report_counts(validated: DataFrame, recs: DataFrame) -> DataFrame:
    """One row: validated hypotheses, recommendation sets, first-ranked hypothesis."""
    return validated.agg(
        F.count(F.lit(1)).alias("validated_hypotheses"),
        F.min_by("hypothesis_text", "rank").alias("top_hypothesis"),
    ).select("validated_hypotheses", recs.select(F.count(F.lit(1))).scalar().alias("recommendation_sets"),
             "top_hypothesis")


def segment_dimension_counts(seg: DataFrame) -> DataFrame:
    """Segments per dimension (A20)."""
    return seg.groupBy("dimension").agg(F.count(F.lit(1)).alias("segments"))


def hypothesis_categories(hyp: DataFrame) -> DataFrame:
    """Distinct hypothesis categories (A21), one row each."""
    return hyp.select("category").distinct()


def top_hypothesis(hyp: DataFrame) -> DataFrame:
    """Highest-confidence hypothesis, first in generator order on ties (W10)."""
    return hyp.agg(F.max_by(F.struct("hypothesis_text", "confidence_score"),
                            F.struct(F.col("confidence_score"), (-F.col("ord")).alias("o"))).alias("t")) \
        .where(F.col("t").isNotNull()).select("t.*")


def validated_with_input(validated: DataFrame, hyp: DataFrame) -> DataFrame:
    """Validated hypotheses joined back to their input hypotheses by id (J8)."""
    v = validated.select("hypothesis_id", "adjusted_confidence_score", "validation_status", "rank")
    return v.join(hyp.select("hypothesis_id", "ord", "category", "confidence_score"), "hypothesis_id", "inner")


def insight_narrative(metrics: DataFrame, trends: DataFrame, seg: DataFrame, hyp: DataFrame,
                      focus: str = "roas") -> DataFrame:
    """think / analyze / conclude texts of the hypothesis step (one row)."""
    FM = focus.upper()
    o = metrics.select("overall_roas" if focus == "roas" else "overall_ctr").scalar()
    current = (fmt(f"Current overall {FM}: %.2f. ", o) if focus == "roas"
               else fmt(f"Current overall {FM}: %.4f. ", o) if focus == "ctr" else F.lit(""))
    n_dims = seg.select(F.countDistinct("dimension")).scalar()
    has_tr = trends.exists()
    think = F.concat(F.lit(f"Analyzing data to understand {FM} performance changes. "), current,
                     F.when(has_tr, F.lit("Trend data available for analysis. ")).otherwise(F.lit("")),
                     fmt("Segmentation data available across %d dimensions. ", n_dims))
    tr_lines = trends.agg(F.concat_ws("", F.sort_array(F.collect_list(F.struct(
        F.when(F.col("metric") == "roas", 0).otherwise(1).alias("o"),
        fmt("- %s trend: %s (WoW: %.1f%%, MoM: %.1f%%)\n", F.upper("metric"), F.col("direction"),
            F.col("week_over_week_change"), F.col("month_over_month_change")).alias("s")))).getField("s"))).scalar()
    names = {"campaign_name": "by_campaign", "creative_type": "by_creative_type",
             "audience_type": "by_audience_type", "platform": "by_platform"}
    dim_name = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    seg_lines = seg.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"), F.min("dim_ord").alias("o")) \
        .agg(F.concat_ws("", F.sort_array(F.collect_list(F.struct(
            "o", fmt("- %s: %d segments identified\n", dim_name[F.col("dimension")], F.col("n")).alias("s"))))
            .getField("s"))).scalar()
    cats = hyp.agg(F.concat_ws(", ", F.sort_array(F.collect_set("category")))).scalar()
    n_h = hyp.select(F.count(F.lit(1))).scalar()
    top = hyp.agg(F.max_by(F.struct("confidence_score", "hypothesis_text"),
                           F.struct(F.col("confidence_score"), (-F.col("ord")).alias("o"))).alias("t")).scalar()
    analyze = F.concat(F.lit("Data pattern analysis:\n"), F.coalesce(tr_lines, F.lit("")),
                       F.coalesce(seg_lines, F.lit("")), fmt("\nGenerated %d hypotheses across categories: ", n_h),
                       F.coalesce(cats, F.lit("")))
    conclude = F.concat(
        fmt(f"Generated %d testable hypotheses to explain {FM} performance. ", n_h),
        F.when(top.isNotNull(), F.concat(fmt("Top hypothesis (confidence: %.2f): ", top.getField("confidence_score")),
                                         top.getField("hypothesis_text"), F.lit(". "))).otherwise(F.lit("")),
        F.lit("These hypotheses require validation through the Evaluator Agent using quantitative metrics. "
              "Each hypothesis includes a validation approach for testing."))
    return metrics.select(F.lit("insight").alias("step"), think.alias("think"), analyze.alias("analyze"),
                          conclude.alias("conclude"))


def evaluation_narrative(hyp: DataFrame, validated: DataFrame, counts: DataFrame) -> DataFrame:
    n_in = hyp.select(F.count(F.lit(1))).scalar()
    top = validated.where(F.col("rank") == 1).select(F.struct(
        "adjusted_confidence_score", "hypothesis_text", "validation_status").alias("t")).select(F.first("t")).scalar()
    think = fmt("Validating %d hypotheses using quantitative metrics and statistical analysis. "
                "Each hypothesis will be tested against dataset segments and compared for statistical significance. "
                "Confidence scores will be adjusted based on validation strength and segmentation evidence.", n_in)
    analyze = fmt("Validation analysis:\n- Confirmed hypotheses: %d\n- Rejected hypotheses: %d\n"
                  "- Inconclusive hypotheses: %d\n- Hypotheses with statistical significance tests: %d\n"
                  "- High confidence (≥0.7): %d\n- Medium confidence (0.5-0.7): %d\n- Low confidence (<0.5): %d",
                  F.col("confirmed"), F.col("rejected"), F.col("inconclusive"), F.col("with_statistical_test"),
                  F.col("high_confidence"), F.col("medium_confidence"), F.col("low_confidence"))
    conclude = F.concat(
        fmt("Validation complete for %d hypotheses. ", F.col("validated")),
        F.when(top.isNotNull(), F.concat(
            fmt("Top hypothesis (confidence: %.2f): ", top.getField("adjusted_confidence_score")),
            top.getField("hypothesis_text"), F.lit(". Status: "), top.getField("validation_status"), F.lit(". ")))
        .otherwise(F.lit("")),
        fmt("Generated %d top insights for reporting. ", F.least(F.col("validated"), F.lit(3))),
        F.lit("Hypotheses ranked by adjusted confidence score using weighted formula: "
              "(InsightConfidence * 0.4) + (ValidationStrength * 0.4) + (SegmentationEvidence * 0.2)."))
    return counts.select(F.lit("evaluation").alias("step"), think.alias("think"), analyze.alias("analyze"),
                         conclude.alias("conclude"))


def creative_narrative(low: DataFrame, variations: DataFrame, summary: DataFrame, threshold: float) -> DataFrame:
    first3 = (low.orderBy(F.col("spend").desc(), F.col("campaign").asc()).limit(3)
              .agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct(
                  (-F.col("spend")).alias("s"), F.col("campaign").alias("c"),
                  fmt("  * %s: CTR %.4f\n", F.col("campaign"), F.col("current_ctr")).alias("t")))),
                  lambda e: e["t"]))).scalar())
    n = F.col("low_ctr_campaigns")
    think = F.concat(fmt("Analyzing campaigns to identify those with CTR below %.4f. ", F.lit(float(threshold))),
                     fmt("Found %d campaigns requiring creative optimization. ", n),
                     F.lit("Will generate creative variations based on high-performing creative attributes "
                           "and audience targeting."))
    body = F.when(n > 0, F.concat(
        fmt("- Average CTR of low-performing campaigns: %.4f\n", F.col("avg_low_ctr")),
        fmt("- Campaigns identified: %d\n", n), F.coalesce(first3, F.lit("")),
        F.when(n > 3, fmt("  * ... and %d more\n", n - 3)).otherwise(F.lit(""))
    )).otherwise(F.lit("- No campaigns found below CTR threshold\n"))
    tv = F.coalesce(F.col("total_variations"), F.lit(0))
    analyze = F.concat(F.lit("Creative performance analysis:\n"), body,
                       fmt("\nGenerated %d creative variations ", tv),
                       fmt("across %d campaigns.", n))
    conclude = F.concat(
        fmt("Generated creative recommendations for %d low-CTR campaigns. ", n),
        F.when(n > 0, F.concat(
            fmt("Each campaign received %.1f creative variations on average. ", F.col("avg_variations_per_campaign")),
            fmt("Average confidence score: %.2f. ", F.col("avg_confidence")))).otherwise(F.lit("")),
        F.lit("Recommendations include creative type, message, audience targeting, and expected CTR improvement."))
    return summary.select(F.lit("creative").alias("step"), think.alias("think"), analyze.alias("analyze"),
                          conclude.alias("conclude"))
