"""Rule-based hypotheses from the aggregated tables (metrics, trends, segments).

All inputs are small aggregates.  They are combined into a one-row context
(struct scalar subqueries, no joins).  Every generator and every default
row is one ``named_struct`` candidate built from that row by a single SQL
projection; the array of candidates is exploded once, the generated rows
are cut to ``max_hypotheses`` in their fixed order and padded to three with
the default rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.ratios import fmt, initial_confidence
from adlens.params import Params

HYPOTHESIS_COLUMNS = [
    "hypothesis_id", "ord", "hypothesis_text", "category", "subject",
    "supporting_observations", "evidence_used", "confidence_score", "testable",
    "validation_approach",
]

# Default hypotheses used for padding (text template with
# {FOCUS}, category, observation, evidence item, confidence, approach).
DEFAULT_HYPOTHESES = [
    ("Seasonal factors may be influencing {FOCUS} performance", "seasonality",
     "Limited historical data available for trend analysis", "time_period", 0.4,
     "Collect more historical data to identify seasonal patterns"),
    ("Ad fatigue may be contributing to {FOCUS} changes", "creative",
     "Creative performance may degrade over time", "creative_age", 0.35,
     "Analyze creative performance over time and test refresh impact"),
    ("Market competition changes may be affecting {FOCUS}", "budget",
     "External market factors can impact performance", "market_conditions", 0.3,
     "Monitor competitive landscape and correlate with performance changes"),
]


def _key(metric: Column) -> Column:
    # order of "first minimum" over spend-descending, value-ascending input
    return F.struct(metric.alias("m"), (-F.col("spend")).alias("s"), F.col("value").alias("v"))


def trend_struct(trends: DataFrame) -> Column:
    """The trend table as one struct scalar (roas/ctr wow, mom, direction, presence)."""
    fields = [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{a}")
              for m in ("roas", "ctr")
              for c, a in (("week_over_week_change", "wow"), ("month_over_month_change", "mom"),
                           ("direction", "dir"))]
    fields += [(F.count_if(F.col("metric") == m) > 0).alias(f"has_{m}") for m in ("roas", "ctr")]
    return trends.agg(F.struct(*fields).alias("t")).scalar()


def metrics_struct(metrics: DataFrame) -> Column:
    return metrics.select(F.struct("overall_roas", "overall_ctr").alias("m")).scalar()


def hypothesis_context(metrics: DataFrame, trends: DataFrame, seg: DataFrame) -> DataFrame:
    """One row with overall ratios, trend changes and the picked segments.

    Overall metrics and trends enter as two struct scalar subqueries (each
    one small job); the segment picks are one global aggregate.
    """
    m = metrics_struct(metrics)
    s = seg.select("dimension", "value", "spend", "roas", "ctr",
                   m.getField("overall_roas").alias("o_roas"), m.getField("overall_ctr").alias("o_ctr"))
    is_c, is_t = F.col("dimension") == "campaign_name", F.col("dimension") == "creative_type"
    is_a, is_p = F.col("dimension") == "audience_type", F.col("dimension") == "platform"
    under_c = is_c & (F.col("roas") < F.col("o_roas") * 0.8)
    under_t = is_t & (F.col("ctr") < F.col("o_ctr") * 0.8)
    under_a = is_a & (F.col("roas") < F.col("o_roas") * 0.7)
    pick = F.struct("value", "roas", "ctr", "spend")
    ctx = s.agg(
        F.count_if(under_c).alias("budget_n"),
        F.min_by(pick, F.when(under_c, _key(F.col("roas")))).alias("budget_pick"),
        F.min_by(pick, F.when(under_t, _key(F.col("ctr")))).alias("creative_pick"),
        F.min_by(pick, F.when(under_a, _key(F.col("roas")))).alias("audience_pick"),
        F.count_if(is_p).alias("platform_n"),
        F.min_by(pick, F.when(is_p, _key(F.col("roas")))).alias("platform_worst"),
        F.max_by(pick, F.when(is_p, _key(F.col("roas")))).alias("platform_best"),
    )
    t = trend_struct(trends)
    return ctx.select(
        m.getField("overall_roas").alias("overall_roas"), m.getField("overall_ctr").alias("overall_ctr"),
        "*", t.alias("t")).select(
        "*", *[F.col("t").getField(f).alias(f) for f in
               ("roas_wow", "roas_mom", "roas_dir", "ctr_wow", "ctr_mom", "ctr_dir", "has_roas", "has_ctr")]
    ).drop("t")


def sql_str(text: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def conf_sql(magnitude: str, max_magnitude: float) -> str:
    """``initial_confidence`` as a SQL expression (missing magnitude counts as 0)."""
    return (f"greatest(0.0D, least(1.0D, 0.3D + least(coalesce({magnitude}, 0.0D) / {float(max_magnitude)}D, "
            f"1.0D) * 0.5D))")


def _fmt(pattern: str, *args: str) -> str:
    return f"format_string({sql_str(pattern)}, {', '.join(args)})"


def _generators_sql(focus: str) -> list[dict]:
    """The six generators as SQL expressions over the context row."""
    FM = focus.upper()
    rw, rm = "coalesce(roas_wow, 0.0D)", "coalesce(roas_mom, 0.0D)"
    cw, cm = "coalesce(ctr_wow, 0.0D)", "coalesce(ctr_mom, 0.0D)"
    gap_t = "(overall_ctr - creative_pick.ctr) / greatest(overall_ctr, 0.0001D) * 100"
    gap_a = "(overall_roas - audience_pick.roas) / greatest(overall_roas, 0.01D) * 100"
    gap_p = "(platform_best.roas - platform_worst.roas) / greatest(platform_worst.roas, 0.01D) * 100"
    return [
        dict(ord=1, category="seasonality", subject="'roas'",
             cond=f"has_roas AND (abs({rw}) > 5 OR abs({rm}) > 5)",
             text=(f"CASE WHEN {rw} < -5 OR {rm} < -5 "
                   f"THEN {_fmt('ROAS declined due to trend (WoW: %.1f%%, MoM: %.1f%%)', rw, rm)} "
                   f"ELSE {_fmt('ROAS improved due to trend (WoW: %.1f%%, MoM: %.1f%%)', rw, rm)} END"),
             obs=[_fmt("Week-over-week ROAS change: %.1f%%", rw), _fmt("Month-over-month ROAS change: %.1f%%", rm),
                  "concat('Trend direction: ', coalesce(roas_dir, 'stable'))"],
             evidence=["roas_trend", "week_over_week_change", "month_over_month_change"],
             conf=conf_sql(f"abs({rw}) + abs({rm})", 20),
             approach="Compare ROAS across time periods and validate trend direction"),
        dict(ord=2, category="creative", subject="'ctr'",
             cond=f"has_ctr AND (abs({cw}) > 5 OR abs({cm}) > 5)",
             text=(f"CASE WHEN {cw} < 0 OR {cm} < 0 "
                   f"THEN {_fmt(f'CTR decline (WoW: %.1f%%, MoM: %.1f%%) negatively impacted {FM}', cw, cm)} "
                   f"ELSE {_fmt(f'CTR improvement (WoW: %.1f%%, MoM: %.1f%%) positively impacted {FM}', cw, cm)} END"),
             obs=[_fmt("Week-over-week CTR change: %.1f%%", cw), _fmt("Month-over-month CTR change: %.1f%%", cm),
                  "concat('CTR trend direction: ', coalesce(ctr_dir, 'stable'))"],
             evidence=["ctr_trend", "week_over_week_change", "month_over_month_change"],
             conf=conf_sql(f"abs({cw}) + abs({cm})", 20),
             approach="Correlate CTR changes with ROAS changes across segments"),
        dict(ord=3, category="budget", subject="budget_pick.value",
             cond="budget_pick IS NOT NULL",
             text=_fmt(f"Campaign '%s' underperformance (ROAS: %.2f) is dragging down overall {FM}",
                       "budget_pick.value", "budget_pick.roas"),
             obs=[_fmt("Campaign ROAS: %.2f vs Overall: %.2f", "budget_pick.roas", "overall_roas"),
                  _fmt("Number of underperforming campaigns: %d", "budget_n"),
                  _fmt("Campaign spend: $%.2f", "budget_pick.spend")],
             evidence=["campaign_segmentation", "roas_by_campaign"],
             conf=conf_sql("abs(overall_roas - budget_pick.roas) / greatest(overall_roas, 0.01D) * 100", 50),
             approach="Compare campaign performance metrics and validate impact on overall ROAS"),
        dict(ord=4, category="creative", subject="creative_pick.value",
             cond="creative_pick IS NOT NULL",
             text=_fmt("'%s' creative type underperforming with CTR of %.4f vs overall %.4f",
                       "creative_pick.value", "creative_pick.ctr", "overall_ctr"),
             obs=[_fmt("Creative type CTR: %.4f", "creative_pick.ctr"), _fmt("Overall CTR: %.4f", "overall_ctr"),
                  _fmt("CTR gap: %.1f%%", gap_t)],
             evidence=["creative_type_segmentation", "ctr_by_creative_type"],
             conf=conf_sql("abs(overall_ctr - creative_pick.ctr) / greatest(overall_ctr, 0.0001D) * 100", 50),
             approach="Compare creative type performance and test correlation with overall metrics"),
        dict(ord=5, category="audience", subject="audience_pick.value",
             cond="audience_pick IS NOT NULL",
             text=_fmt("Audience segment '%s' showing poor ROAS of %.2f compared to overall %.2f",
                       "audience_pick.value", "audience_pick.roas", "overall_roas"),
             obs=[_fmt("Audience ROAS: %.2f", "audience_pick.roas"), _fmt("Overall ROAS: %.2f", "overall_roas"),
                  _fmt("Performance gap: %.1f%%", gap_a)],
             evidence=["audience_segmentation", "roas_by_audience"],
             conf=conf_sql("abs(overall_roas - audience_pick.roas) / greatest(overall_roas, 0.01D) * 100", 50),
             approach="Compare audience segment performance and validate impact on overall ROAS"),
        dict(ord=6, category="platform", subject="platform_worst.value",
             cond="platform_n >= 2 AND platform_best.roas > platform_worst.roas * 1.2D",
             text=_fmt("Platform '%s' (ROAS: %.2f) underperforming compared to '%s' (ROAS: %.2f)",
                       "platform_worst.value", "platform_worst.roas", "platform_best.value", "platform_best.roas"),
             obs=[_fmt("%s ROAS: %.2f", "platform_worst.value", "platform_worst.roas"),
                  _fmt("%s ROAS: %.2f", "platform_best.value", "platform_best.roas"),
                  _fmt("Performance gap: %.1f%%", gap_p)],
             evidence=["platform_segmentation", "roas_by_platform"],
             conf=conf_sql("abs(platform_best.roas - platform_worst.roas) / greatest(platform_worst.roas, 0.01D) * 100",
                           50),
             approach="Compare platform performance metrics and validate statistical significance"),
    ]


def _hid(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("~", *[p.cast("string") for p in parts]), 256)


def _candidate(keep: str, ord_: int, text: str, category: str, subject: str, obs: list[str],
               evidence: list[str], conf: str, approach: str) -> str:
    return (f"named_struct('keep', {keep}, 'ord', {ord_}, 'hypothesis_text', {text}, "
            f"'category', {sql_str(category)}, 'subject', CAST({subject} AS STRING), "
            f"'supporting_observations', array({', '.join(obs)}), "
            f"'evidence_used', array({', '.join(sql_str(e) for e in evidence)}), "
            f"'confidence_score', CAST({conf} AS DOUBLE), 'testable', true, "
            f"'validation_approach', {sql_str(approach)})")


def generate(ctx: DataFrame, params: Params = Params()) -> DataFrame:
    """Hypothesis rows: generators in order, cut to ``max_hypotheses``, padded to 3.

    All candidate rows are one array of structs built from the context row
    by a single SQL projection and exploded once (no union of branches).
    """
    gens = _generators_sql(params.focus_metric)
    flags = [f"CAST(coalesce({g['cond']}, false) AS INT)" for g in gens]
    cands = []
    for i, g in enumerate(gens):
        earlier = " + ".join(flags[:i]) or "0"
        keep = f"(coalesce({g['cond']}, false) AND ({earlier}) < {int(params.max_hypotheses)})"
        cands.append(_candidate(keep, g["ord"], g["text"], g["category"], g["subject"], g["obs"],
                                g["evidence"], g["conf"], g["approach"]))
    n_kept = f"least({' + '.join(flags)}, {int(params.max_hypotheses)})"
    FM = params.focus_metric.upper()
    for idx, (text, cat, obs, ev, conf, appr) in enumerate(DEFAULT_HYPOTHESES):
        cands.append(_candidate(f"({n_kept} <= {idx})", 100 + idx, sql_str(text.replace("{FOCUS}", FM)),
                                cat, "NULL", [sql_str(obs)], [ev], f"{conf}D", appr))
    allh = (ctx.selectExpr(f"explode(array({', '.join(cands)})) AS h")
            .select("h.*").where("keep").drop("keep"))
    return allh.select(_hid(F.col("ord"), F.col("category"), F.col("hypothesis_text")).alias("hypothesis_id"),
                       *[c for c in HYPOTHESIS_COLUMNS if c != "hypothesis_id"])


def hypotheses(metrics: DataFrame, trends: DataFrame, seg: DataFrame,
               params: Params = Params()) -> DataFrame:
    return generate(hypothesis_context(metrics, trends, seg), params)


def underperformers(seg: DataFrame, metrics: DataFrame, dimension: str, metric: str,
                    factor: float) -> DataFrame:
    """Segments of one dimension whose metric is below ``factor`` x the overall value."""
    overall = metrics.select(f"overall_{metric}").scalar()
    return (seg.where(F.col("dimension") == dimension)
            .where(F.col(metric) < overall * factor)
            .select("value", "spend", F.col(metric).alias(metric), overall.alias(f"overall_{metric}")))


def platform_gap(seg: DataFrame) -> DataFrame:
    """Worst/best platform pair and whether best > 1.2 x worst (needs >= 2 platforms)."""
    p = seg.where(F.col("dimension") == "platform")
    key = _key(F.col("roas"))
    pick = F.struct("value", "roas")
    agg = p.agg(F.count(F.lit(1)).alias("n_platforms"), F.min_by(pick, key).alias("w"),
                F.max_by(pick, key).alias("b"))
    return agg.where(F.col("n_platforms") >= 1).select(
        "n_platforms", F.col("w.value").alias("worst_platform"), F.col("w.roas").alias("worst_roas"),
        F.col("b.value").alias("best_platform"), F.col("b.roas").alias("best_roas"),
        ((F.col("n_platforms") >= 2) & (F.col("b.roas") > F.col("w.roas") * 1.2)).alias("gap_flag"))
