"""Output-contract checks as data-quality aggregates.

Each check gives rows (table_name, rule, violations) from one aggregate per
result table; zero violations means the table satisfies its contract.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed enumerations and minimum sizes of the result documents.
CATEGORIES = ["creative", "audience", "platform", "budget", "seasonality"]
STATUSES = ["confirmed", "rejected", "inconclusive"]
DIRECTIONS = ["increasing", "decreasing", "stable"]
MIN_HYPOTHESES = 3
MIN_EVIDENCE_METRICS = 2
MIN_VARIATIONS = 3
VARIATION_FIELDS = ["creative_message", "creative_type", "audience_type", "rationale"]


def _nonfinite(c: Column) -> Column:
    return F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))


def _rows(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    wide = df.agg(*[(F.lit(1) if cond is ABSENT else F.count_if(cond)).cast("bigint").alias(name)
                    for name, cond in rules.items()])
    return wide.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", F.col("violations").cast("bigint"))


#: A rule on columns the table does not have: one violation, whatever its rows.
ABSENT = object()


def _required(df: DataFrame, cols):
    """Rows with a NULL in a required column; ``ABSENT`` if the table lacks one."""
    if any(c not in df.columns for c in cols):
        return ABSENT
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def _on(df: DataFrame, cols, rule):
    """``rule`` (a function without arguments), if the table has its columns."""
    return rule() if all(c in df.columns for c in cols) else ABSENT


def _outside(name: str, low: float, high: float) -> Column:
    return ~F.coalesce(F.col(name).between(low, high), F.lit(False))


def check_summary(summary: DataFrame) -> DataFrame:
    return _rows(summary, "summary", {
        "required_fields": _required(summary, ["total_rows", "start_date", "end_date", "campaigns_count"]),
        "non_negative_counts": _on(summary, ["total_rows", "campaigns_count", "invalid_rows"], lambda: reduce(
            lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in ("total_rows", "campaigns_count", "invalid_rows")])),
    })


def check_metrics(metrics: DataFrame) -> DataFrame:
    """The overall ratios are there and finite."""
    names = ["overall_roas", "overall_ctr", "avg_cpc", "conversion_rate"]
    return _rows(metrics, "metrics", {
        "required_fields": _required(metrics, names),
        "finite_metrics": _on(metrics, names, lambda: reduce(lambda a, b: a | b, [_nonfinite(F.col(c)) for c in names])),
    })


def check_trends(trends: DataFrame) -> DataFrame:
    return _rows(trends, "trends", {
        "direction_enum": _on(trends, ["direction"], lambda: ~F.coalesce(F.col("direction").isin(*DIRECTIONS), F.lit(False))),
        "finite_changes": _on(trends, ["week_over_week_change", "month_over_month_change"], lambda: (
            _nonfinite(F.col("week_over_week_change")) | _nonfinite(F.col("month_over_month_change")))),
    })


def check_hypotheses(hyp: DataFrame) -> DataFrame:
    n = hyp.select(F.count(F.lit(1))).scalar()
    rules = {
        "required_fields": _required(hyp, ["hypothesis_id", "hypothesis_text", "category", "confidence_score"]),
        "category_enum": _on(hyp, ["category"], lambda: ~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False))),
        "confidence_range": _on(hyp, ["confidence_score"], lambda: _outside("confidence_score", 0, 1)),
    }
    out = _rows(hyp, "hypotheses", rules)
    size_rule = hyp.sparkSession.range(1).select(
        F.lit("hypotheses").alias("table_name"), F.lit("min_count").alias("rule"),
        F.when(n < MIN_HYPOTHESES, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("violations"))
    return out.unionByName(size_rule)


def check_validated(v: DataFrame) -> DataFrame:
    return _rows(v, "validated", {
        "required_fields": _required(v, ["hypothesis_id", "hypothesis_text", "validation_status", "evidence_metrics",
                                         "adjusted_confidence_score"]),
        "status_enum": _on(v, ["validation_status"],
                           lambda: ~F.coalesce(F.col("validation_status").isin(*STATUSES), F.lit(False))),
        "confidence_range": _on(v, ["adjusted_confidence_score"], lambda: _outside("adjusted_confidence_score", 0, 1)),
        "min_metrics": _on(v, ["evidence_metrics"],
                           lambda: F.coalesce(F.size("evidence_metrics"), F.lit(0)) < MIN_EVIDENCE_METRICS),
        "metric_fields": _on(v, ["evidence_metrics"], lambda: F.coalesce(F.exists("evidence_metrics", lambda m: (
            m.isNull() | m["metric_name"].isNull() | m["value"].isNull())), F.lit(False))),
        "p_value_range": _on(v, ["p_value"], lambda: F.col("p_value").isNotNull() & _outside("p_value", 0, 1)),
        "finite_statistics": _on(v, ["p_value", "ci_lower", "ci_upper", "evidence_metrics"], lambda: (
            _nonfinite(F.col("p_value")) | _nonfinite(F.col("ci_lower")) | _nonfinite(F.col("ci_upper"))
            | F.coalesce(F.exists("evidence_metrics", lambda m: _nonfinite(m["value"])), F.lit(False)))),
        "interval_pair": _on(v, ["has_test", "ci_lower", "ci_upper"], lambda: (
            F.coalesce(F.col("has_test"), F.lit(False)) & (F.col("ci_lower").isNull() | F.col("ci_upper").isNull()))),
    })


def check_recommendations(recs: DataFrame) -> DataFrame:
    nc = F.col("new_creatives")
    return _rows(recs, "recommendations", {
        "required_fields": _required(recs, ["campaign", "current_ctr", "new_creatives"]),
        "min_variations": _on(recs, ["new_creatives"], lambda: F.coalesce(F.size(nc), F.lit(0)) < MIN_VARIATIONS),
        "confidence_range": _on(recs, ["new_creatives"], lambda: F.coalesce(F.exists(
            nc, lambda c: ~F.coalesce(c["confidence_score"].between(0, 1), F.lit(False))), F.lit(False))),
        "non_empty_fields": _on(recs, ["new_creatives"], lambda: F.coalesce(F.exists(nc, lambda c: reduce(
            lambda a, b: a | b, [F.coalesce(F.length(c[f]) == 0, F.lit(True)) for f in VARIATION_FIELDS])), F.lit(False))),
    })


def check_timestamp(df: DataFrame, column: str, table: str) -> DataFrame:
    """ISO-8601 text (``Z`` suffix allowed)."""
    iso = F.col(column).rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    ts = F.try_to_timestamp(F.regexp_replace(F.col(column), "Z$", "+00:00"))
    return _rows(df, table, {"iso_timestamp": _on(df, [column], lambda: ~F.coalesce(iso, F.lit(False)) | ts.isNull())})


def contract_violations(summary: DataFrame, trends: DataFrame, hyp: DataFrame, validated: DataFrame,
                        recs: DataFrame, metrics: DataFrame | None = None, outputs: DataFrame | None = None) -> DataFrame:
    """Violations of every rule; ``outputs`` has a ``timestamp`` text per written result document."""
    checks = [check_summary(summary), check_trends(trends), check_hypotheses(hyp),
              check_validated(validated), check_recommendations(recs)]
    if metrics is not None:
        checks.append(check_metrics(metrics))
    if outputs is not None:
        checks.append(check_timestamp(outputs, "timestamp", "outputs"))
    return reduce(DataFrame.unionByName, checks)
