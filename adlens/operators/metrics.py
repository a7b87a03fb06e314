"""Dataset summary, overall ratio metrics, period sums and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.ratios import (
    count_sum, guarded_ratio, money_sum, pct_change, period_ratio, trend_direction,
)
from adlens.params import Params

# metric -> (numerator, denominator) of its ratio of sums
RATIO_PARTS = {"roas": ("revenue", "spend"), "ctr": ("clicks", "impressions")}
PERIOD_UNITS = {"week": "week", "month": "month"}


def dataset_summary(df: DataFrame, issues: DataFrame | None = None,
                    approx_distinct: bool = False) -> DataFrame:
    """One row: rows, first/last date, spend and revenue totals, distinct campaigns,
    and ``invalid_rows`` (sum of quality-issue counts, 0 without issues)."""
    distinct = (F.approx_count_distinct("campaign_name") if approx_distinct
                else F.countDistinct("campaign_name"))
    summary = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        money_sum(df, "spend").alias("total_spend"),
        money_sum(df, "revenue").alias("total_revenue"),
        distinct.cast("bigint").alias("campaigns_count"),
    )
    if issues is None:
        return summary.withColumn("invalid_rows", F.lit(0).cast("bigint"))
    invalid = issues.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint")).scalar()
    return summary.withColumn("invalid_rows", invalid)


def totals(df: DataFrame) -> DataFrame:
    """One row of the four additive totals (+ purchases when present)."""
    cols = [money_sum(df, "spend").alias("spend"), money_sum(df, "revenue").alias("revenue"),
            count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks")]
    if "purchases" in df.columns:
        cols.append(count_sum("purchases").alias("purchases"))
    return df.agg(*cols)


def overall_metrics(df: DataFrame) -> DataFrame:
    """One row: overall_roas, overall_ctr, avg_cpc, conversion_rate (guarded ratios)."""
    t = totals(df)
    conv = (guarded_ratio("purchases", "clicks") if "purchases" in df.columns
            else F.lit(0.0))
    return t.select(
        guarded_ratio("revenue", "spend").alias("overall_roas"),
        guarded_ratio("clicks", "impressions").alias("overall_ctr"),
        guarded_ratio("spend", "clicks").alias("avg_cpc"),
        conv.alias("conversion_rate"),
    )


def additive_sums(df: DataFrame, *keys) -> DataFrame:
    """Re-aggregable sums per key: money (as cents when carried), impressions, clicks.

    The output can be aggregated again with the same functions (sums of
    sums), which lets week and month totals share one daily pre-aggregate.
    """
    cols = []
    for m in ("spend", "revenue"):
        if f"{m}_cents" in df.columns:
            cols.append(F.sum(f"{m}_cents").alias(f"{m}_cents"))
        else:
            cols.append(F.sum(F.col(m).cast("double")).alias(m))
    cols += [F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
             F.count(F.lit(1)).alias("rows")]
    if "purchases" in df.columns:
        cols.append(F.sum("purchases").alias("purchases"))
    return df.groupBy(*keys).agg(*cols)


def daily_sums(df: DataFrame) -> DataFrame:
    return additive_sums(df, "date")


def period_metrics(df: DataFrame, unit: str) -> DataFrame:
    """Sums per calendar week (Monday start) or month, with NULL-on-zero ratios.

    ``df`` may be fact rows or their ``daily_sums``.
    """
    period = F.date_trunc(PERIOD_UNITS[unit], F.col("date")).cast("date").alias("period")
    agg = df.groupBy(period).agg(
        money_sum(df, "spend").alias("spend"), money_sum(df, "revenue").alias("revenue"),
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"))
    return agg.select(
        "period", "spend", "revenue", "impressions", "clicks",
        period_ratio("revenue", "spend").alias("roas"),
        period_ratio("clicks", "impressions").alias("ctr"),
    )


def period_mean(df: DataFrame, unit: str, column: str) -> DataFrame:
    """Per-period mean of a raw row-level column (the generic metric branch of the trend rules)."""
    period = F.date_trunc(PERIOD_UNITS[unit], F.col("date")).cast("date").alias("period")
    return df.groupBy(period).agg(F.avg(F.col(column).cast("double")).alias(f"mean_{column}"))


def trend_changes(df: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """One row: n_periods, roas_wow, ctr_wow, roas_mom, ctr_mom (percent).

    Week and month totals come from the daily pre-aggregate; the last two
    observed periods of each unit are picked with a window partitioned by
    unit (at most #weeks + #months rows, bounded by the calendar), then one
    global aggregate pivots the changes into a single row.
    """
    daily = daily_sums(df) if daily is None else daily
    # week and month totals in one GROUPING SETS aggregate over the daily sums:
    # a single branch, so the input is read once
    dated = daily.select(
        F.date_trunc("week", F.col("date")).cast("date").alias("wk"),
        F.date_trunc("month", F.col("date")).cast("date").alias("mo"),
        *[c for c in daily.columns if c != "date"])
    sums = dated.groupingSets([["wk"], ["mo"]], "wk", "mo").agg(
        money_sum(dated, "spend").alias("spend"), money_sum(dated, "revenue").alias("revenue"),
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
        F.grouping("wk").alias("_g_wk"))
    periods = sums.select(
        F.when(F.col("_g_wk") == 0, F.lit("wow")).otherwise(F.lit("mom")).alias("unit"),
        F.coalesce("wk", "mo").alias("period"),
        period_ratio("revenue", "spend").alias("roas"),
        period_ratio("clicks", "impressions").alias("ctr"))
    w = Window.partitionBy("unit").orderBy(F.col("period").desc())
    last2 = periods.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= 2)
    per_unit = last2.groupBy("unit").agg(
        F.count(F.lit(1)).alias("k"),
        *[F.max(F.when(F.col("rk") == 1, F.col(m))).alias(f"{m}_last") for m in RATIO_PARTS],
        *[F.max(F.when(F.col("rk") == 2, F.col(m))).alias(f"{m}_prev") for m in RATIO_PARTS])
    changes = per_unit.select(
        "unit", *[F.when(F.col("k") < 2, F.lit(0.0)).otherwise(pct_change(f"{m}_last", f"{m}_prev")).alias(m)
                  for m in RATIO_PARTS])
    return changes.agg(
        F.count(F.lit(1)).alias("n_units"),
        *[F.max(F.when(F.col("unit") == u, F.col(m))).alias(f"{m}_{u}")
          for u in ("wow", "mom") for m in RATIO_PARTS])


def trends(df: DataFrame, params: Params = Params(), daily: DataFrame | None = None) -> DataFrame:
    """One row per metric (roas, ctr): direction and week/month-over-month change.

    No rows for an empty input.  With ``params.trend_requires_metric_column``
    a metric whose row-level column is absent reports stable/0.
    """
    ch = trend_changes(df, daily).where(F.col("n_units") > 0)
    packed = []
    for m in RATIO_PARTS:
        gate = params.trend_requires_metric_column and m not in df.columns
        wow = F.lit(0.0) if gate else F.col(f"{m}_wow")
        mom = F.lit(0.0) if gate else F.col(f"{m}_mom")
        packed.append(F.struct(
            F.lit(m).alias("metric"),
            trend_direction(wow, mom, params.trend_stable_threshold).alias("direction"),
            wow.alias("week_over_week_change"),
            mom.alias("month_over_month_change")))
    return ch.select(F.explode(F.array(*packed)).alias("t")).select("t.*")


def summary_from_daily(daily: DataFrame, seg: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """``dataset_summary`` from daily sums plus the campaign segments (distinct campaigns)."""
    s = daily.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        money_sum(daily, "spend").alias("total_spend"),
        money_sum(daily, "revenue").alias("total_revenue"))
    n_camp = seg.where(F.col("dimension") == "campaign_name").select(F.count(F.lit(1))).scalar()
    invalid = (F.lit(0).cast("bigint") if issues is None
               else issues.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint")).scalar())
    return s.select("*", n_camp.cast("bigint").alias("campaigns_count"), invalid.alias("invalid_rows"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Rows (field, missing) for every column with at least one NULL."""
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    stacked = wide.unpivot([], [F.col(f"`{c}`") for c in df.columns], "field", "missing")
    return stacked.where(F.col("missing") > 0)
