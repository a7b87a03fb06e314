"""Segmentation: per-value totals of the four dimensions in one pass.

``fact_cube`` runs a single GROUPING SETS aggregate (Expand feeding a partial
hash aggregate, one shuffle) over the four dimensions and optionally the
date.  It also collects the two-sample sufficient statistics (n, mean, sample variance) of the
row-level ``ctr`` and ``roas`` columns, so the t-tests need no second scan.
Hot keys are harmless: the partial aggregate collapses them map-side before
the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.ratios import count_sum, guarded_ratio, money_sum
from adlens.params import DIMENSIONS

# metric used to call a segment best/worst, per dimension
DIMENSION_METRIC = {"campaign_name": "roas", "creative_type": "ctr",
                    "audience_type": "roas", "platform": "roas"}
SEGMENT_COLUMNS = ["dimension", "value", "spend", "revenue", "roas", "impressions", "clicks", "ctr"]


def present_dimensions(df: DataFrame, dims=DIMENSIONS) -> list[str]:
    return [d for d in dims if d in df.columns]


def _moment_aggs(df: DataFrame) -> list[Column]:
    out = []
    for m in ("ctr", "roas"):
        if m in df.columns:
            x = F.col(m).cast("double")
            out += [F.count(x).alias(f"{m}_n"), F.avg(x).alias(f"{m}_mean"),
                    F.var_samp(x).alias(f"{m}_var")]
        else:
            out += [F.lit(0).cast("bigint").alias(f"{m}_n"),
                    F.lit(None).cast("double").alias(f"{m}_mean"),
                    F.lit(None).cast("double").alias(f"{m}_var")]
    return out


def fact_cube(df: DataFrame, dims=DIMENSIONS, moments: bool = True, include_daily: bool = False) -> DataFrame:
    """One GROUPING SETS pass over the facts.

    The plan is linear (scan -> Expand -> partial/final aggregate); the facts are read once.

    Columns: dimension, dim_ord, value, date (daily rows only), re-aggregable
    sums (money as cents when carried), rows, guarded spend/revenue/roas/ctr,
    and with ``moments`` n/mean/var of row-level ctr and roas.
    """
    dims = present_dimensions(df, dims)
    keys = list(dims) + (["date"] if include_daily else [])
    if not keys:
        raise ValueError("no segmentation dimension present")
    sets = [[d] for d in dims] + ([["date"]] if include_daily else [])
    cents = "spend_cents" in df.columns and "revenue_cents" in df.columns
    sums = ([F.sum("spend_cents").alias("spend_cents"), F.sum("revenue_cents").alias("revenue_cents")]
            if cents else [F.coalesce(F.sum(F.col("spend").cast("double")), F.lit(0.0)).alias("spend"),
                           F.coalesce(F.sum(F.col("revenue").cast("double")), F.lit(0.0)).alias("revenue")])
    sums += [count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
             F.count(F.lit(1)).alias("rows")]
    if "purchases" in df.columns:
        sums.append(count_sum("purchases").alias("purchases"))
    aggs = list(sums) + (_moment_aggs(df) if moments else [])
    if len(sets) == 1:
        grouped = df.groupBy(*sets[0]).agg(*aggs, F.lit(0).alias("_gid"))
        gid_of = {0: sets[0]}
    else:
        grouped = df.groupingSets(sets, *keys).agg(*aggs, F.grouping_id(*keys).alias("_gid"))
        n = len(keys)
        gid_of = {sum(1 << (n - 1 - i) for i, k in enumerate(keys) if k not in st): st for st in sets}
    order = {d: i for i, d in enumerate(DIMENSIONS)}
    order["date"] = len(DIMENSIONS)

    def case(fn):
        items = list(gid_of.items())
        expr = F.when(F.col("_gid") == items[0][0], fn(items[0][1]))
        for g, st in items[1:]:
            expr = expr.when(F.col("_gid") == g, fn(st))
        return expr

    dim_name = case(lambda st: F.lit(st[0]))
    dim_ord = case(lambda st: F.lit(order[st[0]]))
    dim_value = case(lambda st: F.col(st[0]).cast("string"))
    money = ([(F.coalesce(F.col("spend_cents"), F.lit(0)) / 100.0).alias("spend"),
              (F.coalesce(F.col("revenue_cents"), F.lit(0)) / 100.0).alias("revenue"),
              "spend_cents", "revenue_cents"] if cents else ["spend", "revenue"])
    extra = ([c for m in ("ctr", "roas") for c in (f"{m}_n", f"{m}_mean", f"{m}_var")]
             if moments else [])
    extra += ["purchases"] if "purchases" in df.columns else []
    out = grouped.select(
        dim_name.alias("dimension"), dim_ord.alias("dim_ord"), dim_value.alias("value"),
        (F.when(F.col("_gid") == [g for g, st in gid_of.items() if st == ["date"]][0], F.col("date"))
         if include_daily else F.lit(None).cast("date")).alias("date"),
        *money, F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"), "rows", *extra)
    out = out.select("*", guarded_ratio("revenue", "spend").alias("roas"),
                     guarded_ratio("clicks", "impressions").alias("ctr"))
    return out.where(F.col("value").isNotNull())


def segment_aggregates(df: DataFrame, dims=DIMENSIONS, moments: bool = True) -> DataFrame:
    """Long-form per (dimension, value): totals, guarded ratios and, optionally,
    n/mean/var of row-level ctr and roas.  NULL values are dropped."""
    return fact_cube(df, dims, moments)


def segments_of_cube(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("dimension").isin(*DIMENSIONS))


def daily_of_cube(cube: DataFrame) -> DataFrame:
    """Daily re-aggregable sums (same shape as ``metrics.daily_sums``) from a cube."""
    keep = [c for c in ("spend_cents", "revenue_cents") if c in cube.columns] or ["spend", "revenue"]
    keep += ["impressions", "clicks", "rows"] + (["purchases"] if "purchases" in cube.columns else [])
    return cube.where(F.col("dimension") == "date").select("date", *keep)


def segments(df: DataFrame, dims=DIMENSIONS) -> DataFrame:
    """Public long-form segmentation, highest spend first within a dimension."""
    return (segment_aggregates(df, dims, moments=False)
            .orderBy("dim_ord", F.col("spend").desc(), F.col("value").asc())
            .select(*SEGMENT_COLUMNS))


def segment_by(df: DataFrame, field: str) -> DataFrame:
    """Totals for one dimension: ``field`` value, spend, revenue, roas, impressions, clicks, ctr."""
    agg = df.groupBy(field).agg(
        money_sum(df, "spend").alias("spend"), money_sum(df, "revenue").alias("revenue"),
        count_sum("impressions").cast("bigint").alias("impressions"),
        count_sum("clicks").cast("bigint").alias("clicks"))
    return (agg.where(F.col(field).isNotNull())
            .select(F.col(field).cast("string").alias(field), "spend", "revenue",
                    guarded_ratio("revenue", "spend").alias("roas"), "impressions", "clicks",
                    guarded_ratio("clicks", "impressions").alias("ctr"))
            .orderBy(F.col("spend").desc(), F.col(field).asc()))


def _metric_of(dimension: Column) -> Column:
    return F.when(dimension == "creative_type", F.col("ctr")).otherwise(F.col("roas"))


def best_worst(seg: DataFrame) -> DataFrame:
    """Per dimension: number of segments and the worst / best segment.

    Order key (metric asc, spend desc, value asc): worst is the first and
    best the last element, i.e. a stable ascending sort by the metric over
    spend-descending input.  Two aggregates per dimension, no self-join.
    """
    metric = _metric_of(F.col("dimension"))
    key = F.struct(metric.alias("m"), (-F.col("spend")).alias("s"), F.col("value").alias("v"))
    row = F.struct(F.col("value"), metric.alias("metric"), F.col("spend"),
                   *[F.col(c) for c in seg.columns if c.endswith(("_n", "_mean", "_var"))])
    agg = seg.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.min_by(row, key).alias("worst"),
        F.max_by(row, key).alias("best"))
    return agg.select(
        "dimension",
        F.when(F.col("dimension") == "creative_type", F.lit("ctr")).otherwise(F.lit("roas")).alias("metric"),
        "n_segments",
        F.col("worst.value").alias("worst_value"), F.col("worst.metric").alias("worst_metric"),
        F.col("worst.spend").alias("worst_spend"),
        F.col("best.value").alias("best_value"), F.col("best.metric").alias("best_metric"),
        F.col("best.spend").alias("best_spend"),
        "worst", "best",
    )
