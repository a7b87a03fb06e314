"""Seasonality flag: does a daily ratio repeat after a fixed number of days?

The daily sums are laid on a gapless calendar (a day without rows is a gap,
not a zero).  The series of day-to-day changes, which has no trend left, is
compared with itself ``lag`` days earlier: the autocorrelation of every lag
up to ``max_lag``.  The lag with the highest one, from two days on, is the
cycle; it is flagged when it is at least ``LEAST`` and above what noise of
this length reaches (``NOISE`` standard errors).

All steps are windows over a table of one row per calendar day and metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.ratios import count_sum, money_sum, period_ratio
from adlens.operators.metrics import RATIO_PARTS
from adlens.session import cut_lineage

MAX_LAG, LEAST, NOISE = 28, 0.3, 3.0
#: Changes whose squares are below so much of the values' squares are rounding, not change.
ROUNDING = 1e-18


def daily_ratios(daily: DataFrame) -> DataFrame:
    """(metric, date, value) of every date that has rows; null where the ratio is undefined."""
    sums = daily.groupBy("date").agg(
        money_sum(daily, "spend").alias("spend"), money_sum(daily, "revenue").alias("revenue"),
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"))
    long = [F.struct(F.lit(m).alias("metric"), "date", period_ratio(*parts).alias("value")) for m, parts in RATIO_PARTS.items()]
    return sums.where("date IS NOT NULL").select(F.inline(F.array(*long)))


def on_calendar(series: DataFrame) -> DataFrame:
    """``series`` with a row for every date between a metric's first and last one; ``gap`` marks those added."""
    span = series.groupBy("metric").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = span.select("metric", F.explode(F.sequence("first", "last")).alias("date"))
    known = series.select("metric", "date", "value", F.lit(False).alias("_known"))
    return (days.join(known, ["metric", "date"], "left")
            .select("metric", "date", "value", F.col("_known").isNull().alias("gap")))


def autocorrelations(series: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """(metric, days, gaps, changes, lag, autocorrelation) for every lag; null where a series does not change."""
    by_date = Window.partitionBy("metric").orderBy("date")
    calendar = on_calendar(series)
    change = calendar.withColumn("d", F.col("value") - F.lag("value").over(by_date))
    mean = change.withColumn("x", F.col("d") - F.avg("d").over(Window.partitionBy("metric")))
    lagged = mean.select("metric", "gap", "value", "x", *[F.lag("x", k).over(by_date).alias(f"x{k}") for k in range(1, max_lag + 1)])
    sums = lagged.groupBy("metric").agg(
        F.count("*").alias("days"), F.count_if("gap").alias("gaps"), F.count("x").alias("changes"),
        F.sum(F.col("x") * F.col("x")).alias("own"), F.sum(F.col("value") * F.col("value")).alias("size"),
        *[F.sum(F.col("x") * F.col(f"x{k}")).alias(f"s{k}") for k in range(1, max_lag + 1)])
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.when(F.col("own") > ROUNDING * F.col("size"), F.col(f"s{k}") / F.col("own")).alias("autocorrelation"))
                     for k in range(1, max_lag + 1)])
    return sums.select("metric", "days", "gaps", "changes", F.explode(lags).alias("l")).select("metric", "days", "gaps", "changes", "l.*")


def seasonality(daily: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """One row per metric: days, gaps, the best lag with its autocorrelation, and whether it is a season.

    ``daily`` has a date and the additive sums, as ``metrics.daily_sums`` gives them.
    """
    found = autocorrelations(cut_lineage(daily_ratios(daily)), max_lag)      # a row per day, which two branches read
    long = F.col("lag") >= 2
    best = found.groupBy("metric", "days", "gaps", "changes").agg(
        F.max_by(F.struct("lag", "autocorrelation"), F.when(long, F.struct(F.col("autocorrelation"), -F.col("lag")))).alias("b"))
    r = F.col("b.autocorrelation")
    seasonal = (r >= LEAST) & (r > F.lit(NOISE) / F.sqrt(F.col("changes")))
    return best.select("metric", "days", "gaps", F.when(r.isNotNull(), F.col("b.lag")).alias("lag"), r.alias("autocorrelation"),
                       F.coalesce(seasonal, F.lit(False)).alias("seasonal"))
