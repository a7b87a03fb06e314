"""Evidence for hypotheses: best/worst segments, t-tests, scores, ranking.

Evidence depends only on a hypothesis' category and the data, so it is
computed once per category (six rows: creative, audience, platform, budget,
seasonality and a generic fallback) and joined to the hypotheses by
category.  The t-test uses the per-segment sufficient statistics gathered
by the segmentation pass (no rescan of the facts); the p-value finisher
(regularised incomplete beta) runs JVM-side on at most three rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.ratios import clamp01, fmt
from adlens.functions.stats import p_value
from adlens.operators.hypotheses import metrics_struct, sql_str, trend_struct
from adlens.operators.segments import best_worst
from adlens.params import Params

# category -> (dimension, metric, label used in names, label used in texts, threshold, t-test)
SEGMENT_CATEGORIES = {
    "creative": ("creative_type", "ctr", "creative", "creative type", 0.002, True),
    "audience": ("audience_type", "roas", "audience", "audience", 0.5, True),
    "platform": ("platform", "roas", "platform", "platform", 0.3, True),
    "budget": ("campaign_name", "roas", "campaign", "campaign", 0.5, False),
}
KNOWN_CATEGORIES = ("creative", "audience", "platform", "budget", "seasonality")


def _ev_sql(category: str, metrics_arr: str, status: str, has_test: str = "false", t: str = "NULL",
            dof: str = "NULL", lo: str = "NULL", hi: str = "NULL") -> str:
    return (f"named_struct('category', {sql_str(category)}, 'metrics', {metrics_arr}, "
            f"'validation_status', {status}, 'has_test', {has_test}, "
            f"'t_stat', CAST({t} AS DOUBLE), 'dof', CAST({dof} AS DOUBLE), "
            f"'ci_lower', CAST({lo} AS DOUBLE), 'ci_upper', CAST({hi} AS DOUBLE))")


def _m_sql(name: str, value: str, comparison: str) -> str:
    return (f"named_struct('metric_name', {sql_str(name)}, 'value', CAST({value} AS DOUBLE), "
            f"'comparison', {comparison})")


def _status_sql(diff: str, confirm: float) -> str:
    return (f"CASE WHEN {diff} > {confirm}D THEN 'confirmed' WHEN {diff} < 0 THEN 'rejected' "
            f"ELSE 'inconclusive' END")


def _segment_evidence_sql(category: str, params: Params) -> str:
    """Evidence struct of one segment category as SQL over the context row."""
    dim, metric, label, text_label, confirm, with_test = SEGMENT_CATEGORIES[category]
    overall_name = "overall_ctr" if metric == "ctr" else "overall_roas"
    overall = f"m.{overall_name}"
    n = f"coalesce({dim}_n, 0)"
    w, b = f"{dim}_w", f"{dim}_b"
    enough = [_m_sql(f"worst_{label}_{metric}", f"{w}.metric",
                     f"concat({sql_str(f'Worst performing {text_label}: ')}, coalesce({w}.value, 'unknown'))"),
              _m_sql(f"best_{label}_{metric}", f"{b}.metric",
                     f"concat({sql_str(f'Best performing {text_label}: ')}, coalesce({b}.value, 'unknown'))")]
    if category == "budget":
        enough.append(_m_sql("worst_campaign_spend", f"{w}.spend",
                             f"format_string('Spend on worst campaign: $%.2f', {w}.spend)"))
    plural = {"creative": "creative type segments", "audience": "audience segments",
              "platform": "platform segments", "budget": "campaign segments"}[category]
    baseline = "Overall CTR baseline" if metric == "ctr" else "Overall ROAS baseline"
    scarce = [_m_sql(f"{label}_segments_count", n, sql_str(f"Insufficient {plural} for comparison")),
              _m_sql(overall_name, overall, sql_str(baseline))]
    pair = f"({n} >= 2)"
    arr = f"CASE WHEN {pair} THEN array({', '.join(enough)}) ELSE array({', '.join(scarce)}) END"
    status = (f"CASE WHEN {pair} THEN {_status_sql(f'({b}.metric - {w}.metric)', confirm)} "
              f"ELSE 'inconclusive' END")
    if not with_test:
        return _ev_sql(category, arr, status)
    n1, m1, v1 = f"CAST({w}.{metric}_n AS DOUBLE)", f"{w}.{metric}_mean", f"{w}.{metric}_var"
    n2, m2, v2 = f"CAST({b}.{metric}_n AS DOUBLE)", f"{b}.{metric}_mean", f"{b}.{metric}_var"
    k = int(params.min_data_points)
    tested = f"coalesce({pair} AND {n1} >= {k} AND {n2} >= {k}, false)"
    dof = f"({n1} + {n2} - 2)"
    se = f"sqrt(((({n1} - 1) * {v1} + ({n2} - 1) * {v2}) / {dof}) * (1.0D / {n1} + 1.0D / {n2}))"
    diff = f"({m1} - {m2})"
    t = (f"CASE WHEN {dof} <= 0 THEN NULL WHEN {se} = 0 THEN CASE WHEN {diff} = 0 THEN NULL "
         f"WHEN {diff} > 0 THEN double('inf') ELSE double('-inf') END ELSE {diff} / {se} END")
    se2 = f"sqrt({v1} / {n1} + {v2} / {n2})"
    lo, hi = f"(({m2} - {m1}) - 1.96D * {se2})", f"(({m2} - {m1}) + 1.96D * {se2})"
    return _ev_sql(category, arr, status, tested, f"CASE WHEN {tested} THEN {t} END",
                   f"CASE WHEN {tested} THEN {dof} END", f"CASE WHEN {tested} THEN {lo} END",
                   f"CASE WHEN {tested} THEN {hi} END")


def _seasonality_evidence_sql() -> str:
    rw, rm, cw = "coalesce(t.roas_wow, 0.0D)", "coalesce(t.roas_mom, 0.0D)", "coalesce(t.ctr_wow, 0.0D)"
    avg_change = f"((abs({rw}) + abs({rm})) / 2)"
    arr = (f"array({_m_sql('roas_wow_change', rw, f'format_string({chr(39)}ROAS week-over-week change: %.1f%%{chr(39)}, {rw})')}, "
           f"{_m_sql('roas_mom_change', rm, f'format_string({chr(39)}ROAS month-over-month change: %.1f%%{chr(39)}, {rm})')}, "
           f"{_m_sql('ctr_wow_change', cw, f'format_string({chr(39)}CTR week-over-week change: %.1f%%{chr(39)}, {cw})')})")
    status = (f"CASE WHEN {avg_change} > 10 THEN 'confirmed' WHEN {avg_change} < 3 THEN 'rejected' "
              f"ELSE 'inconclusive' END")
    return _ev_sql("seasonality", arr, status)


def _generic_evidence_sql() -> str:
    arr = (f"array({_m_sql('overall_roas', 'm.overall_roas', sql_str('Overall ROAS'))}, "
           f"{_m_sql('overall_ctr', 'm.overall_ctr', sql_str('Overall CTR'))})")
    return _ev_sql("generic", arr, "'inconclusive'")


def evidence_context(seg: DataFrame) -> DataFrame:
    """One row: per dimension the segment count and the worst/best segment structs."""
    bw = best_worst(seg)
    dims = [v[0] for v in SEGMENT_CATEGORIES.values()]
    aggs = []
    for d in dims:
        is_d = F.col("dimension") == d
        aggs += [F.max(F.when(is_d, F.col("n_segments"))).alias(f"{d}_n"),
                 F.first(F.when(is_d, F.col("worst")), ignorenulls=True).alias(f"{d}_w"),
                 F.first(F.when(is_d, F.col("best")), ignorenulls=True).alias(f"{d}_b")]
    return bw.agg(*aggs)


def evidence_by_category(seg: DataFrame, metrics: DataFrame, trends: DataFrame,
                         params: Params = Params()) -> DataFrame:
    """Six rows: evidence metrics, status and test statistics per category.

    One context row (per-dimension worst/best structs + the metrics and trend
    structs as scalar subqueries) and one SQL projection exploding the six
    category structs.
    """
    ctx = evidence_context(seg).select("*", metrics_struct(metrics).alias("m"),
                                       trend_struct(trends).alias("t"))
    rows = [_segment_evidence_sql(c, params) for c in SEGMENT_CATEGORIES]
    rows += [_seasonality_evidence_sql(), _generic_evidence_sql()]
    ev = ctx.selectExpr(f"explode(array({', '.join(rows)})) AS e").select("e.*")
    p = p_value(F.col("t_stat"), F.col("dof"))
    return ev.select("*", F.when(F.col("has_test"), p).alias("p_value"))


def validation_strength(status: Column, p: Column, has_test: Column, n_metrics: Column) -> Column:
    base = (F.when(status == "confirmed", F.lit(0.7)).when(status == "rejected", F.lit(0.2))
            .otherwise(F.lit(0.4)))
    bonus = (F.when(has_test & (p < 0.05), F.least(F.lit(1.0), base + 0.2))
             .when(has_test & (p < 0.1), F.least(F.lit(1.0), base + 0.1)).otherwise(base))
    penal = F.when(n_metrics < 2, F.greatest(F.lit(0.0), bonus - 0.2)).otherwise(bonus)
    return clamp01(penal)


def segmentation_evidence(metrics_arr: Column) -> Column:
    n = F.size(metrics_arr)
    vs = F.exists(metrics_arr, lambda m: F.coalesce(F.lower(m["comparison"]).contains("vs"), F.lit(False)))
    return (F.when((n >= 2) & vs, F.lit(0.8)).when(n >= 2, F.lit(0.6)).when(n >= 1, F.lit(0.4))
            .otherwise(F.lit(0.2)))


def _reasoning(status: Column, metrics_arr: Column, has_test: Column, p: Column, adj: Column) -> Column:
    n = F.size(metrics_arr)
    first2 = F.concat_ws("", F.transform(F.slice(metrics_arr, 1, 2),
                                         lambda m: F.concat(F.coalesce(m["comparison"], F.lit("")), F.lit(". "))))
    analysed = F.when(n > 0, F.concat(fmt("Analyzed %d metrics. ", n), first2)).otherwise(F.lit(""))
    p_txt = F.coalesce(fmt("%.4f", p), F.lit("nan"))
    test = F.when(has_test, F.concat(
        F.lit("Statistical test p-value: "), p_txt, F.lit(". "),
        F.when(p < 0.05, F.lit("Result is statistically significant. "))
         .otherwise(F.lit("Result is not statistically significant. ")))).otherwise(F.lit(""))
    band = (F.when(adj >= 0.7, F.lit("High confidence in this hypothesis."))
            .when(adj >= 0.5, F.lit("Moderate confidence in this hypothesis."))
            .otherwise(F.lit("Low confidence - requires further investigation.")))
    return F.concat(F.lit("Hypothesis validation: "), status, F.lit(". "), analysed, test,
                    fmt("Adjusted confidence score: %.2f. ", adj), band)


def validate(hyp: DataFrame, evidence: DataFrame, params: Params = Params()) -> DataFrame:
    """Validated, ranked hypotheses (one row per input hypothesis)."""
    h = hyp.withColumn("ev_category", F.when(F.col("category").isin(*KNOWN_CATEGORIES), F.col("category"))
                       .otherwise(F.lit("generic")))
    ev = evidence.withColumnRenamed("category", "ev_category")
    j = h.join(ev, "ev_category", "left")
    n_metrics = F.size("metrics")
    init = F.coalesce(F.col("confidence_score"), F.lit(0.5))
    strength = validation_strength(F.col("validation_status"), F.col("p_value"), F.col("has_test"), n_metrics)
    seg_ev = segmentation_evidence(F.col("metrics"))
    scored = j.select(
        "hypothesis_id", "ord", "hypothesis_text", "category", "validation_status",
        F.col("metrics").alias("evidence_metrics"), "has_test", "p_value", "ci_lower", "ci_upper",
        "t_stat", "dof", init.alias("initial_confidence"),
        strength.alias("validation_strength"), seg_ev.alias("segmentation_evidence"))
    adj = clamp01(F.col("initial_confidence") * params.weight_insight
                  + F.col("validation_strength") * params.weight_validation
                  + F.col("segmentation_evidence") * params.weight_segmentation)
    scored = scored.withColumn("adjusted_confidence_score", adj)
    scored = scored.withColumn("validation_reasoning", _reasoning(
        F.col("validation_status"), F.col("evidence_metrics"), F.col("has_test"), F.col("p_value"),
        F.col("adjusted_confidence_score")))
    # at most max_hypotheses + 3 rows: a single ordered window is bounded
    w = Window.orderBy(F.col("adjusted_confidence_score").desc(), F.col("ord").asc())
    return scored.withColumn("rank", F.row_number().over(w))


def top_insights(validated: DataFrame, k: int = 3) -> DataFrame:
    return (validated.where(F.col("rank") <= k)
            .select("rank", F.col("hypothesis_text").alias("hypothesis"),
                    F.col("adjusted_confidence_score").alias("validated_confidence")))


def status_counts(validated: DataFrame) -> DataFrame:
    a = F.col("adjusted_confidence_score")
    return validated.agg(
        F.count(F.lit(1)).alias("validated"),
        F.count_if(F.col("validation_status") == "confirmed").alias("confirmed"),
        F.count_if(F.col("validation_status") == "rejected").alias("rejected"),
        F.count_if(F.col("validation_status") == "inconclusive").alias("inconclusive"),
        F.count_if(F.col("has_test")).alias("with_statistical_test"),
        F.count_if(a >= 0.7).alias("high_confidence"),
        F.count_if((a >= 0.5) & (a < 0.7)).alias("medium_confidence"),
        F.count_if(a < 0.5).alias("low_confidence"))
