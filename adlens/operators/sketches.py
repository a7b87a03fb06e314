"""Distinct counts and quantiles of any period from one small sketch per day.

``daily_sketches`` reads the facts once and keeps, for every date, a
HyperLogLog sketch of the campaigns and a KLL sketch of the row-level ctr.
Sketches merge, so the distinct campaigns and the ctr quantiles of any span
of dates come from that table alone; exact counting would need the rows
again for every span, since neither is additive.

Error bounds (relative standard error of the count, error in rank of a
quantile): 1.04 / sqrt(2 ** HLL_LG_K), about 1.6 %, and about 1.65 % for
KLL_K = 200.  Below some hundred distinct values the count is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_LG_K, KLL_K = 12, 200
COUNT_ERROR, RANK_ERROR = 1.04 / 2 ** (HLL_LG_K / 2), 0.0165


def daily_sketches(df: DataFrame, distinct: str = "campaign_name", value: str = "ctr") -> DataFrame:
    """(date, rows, distinct_sketch, value_sketch), one row per date; null and NaN values are left out."""
    x = F.col(value).cast("double")
    return df.where("date IS NOT NULL").groupBy("date").agg(
        F.count("*").alias("rows"),
        F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(HLL_LG_K)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(KLL_K)).alias("value_sketch"))


def merged(daily: DataFrame, *period: Column, quantiles: tuple = (0.75,)) -> DataFrame:
    """One row per period (all dates without one): rows, distinct_estimate, values and the quantiles ``q<percent>``.

    A quantile is null where no date of the period has a value.
    """
    both = daily.groupBy(*period).agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("value_sketch").alias("_values"))
    n = F.kll_sketch_get_n_double("_values")
    keys = [c for c in both.columns if c not in ("rows", "distinct_estimate", "_values")]
    return both.select(
        *keys, "rows", "distinct_estimate", F.coalesce(n, F.lit(0)).alias("values"),
        *[F.when(n > 0, F.kll_sketch_get_quantile_double("_values", F.lit(float(q)))).alias(f"q{round(100 * q)}") for q in quantiles])


def of_range(daily: DataFrame, start, end, quantiles: tuple = (0.75,)) -> DataFrame:
    """One row for the dates from ``start`` to ``end``, both included."""
    return merged(daily.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))), quantiles=quantiles)
