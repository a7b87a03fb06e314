"""Exact quantile with linear interpolation, computed without a single-task gather.

``percentile`` keeps a value->count map of every distinct value in one final
task; on a row-level ratio column that map grows with the data.  Here:

1. distinct values with counts (hash aggregate, partial/final split), range
   partitioned into ``B`` ordered buckets (default: the session's shuffle
   partition count, so the bucket size follows the cluster sizing) by Spark's range partitioner
   (sampled boundaries, binary search per value) and written once, with the
   bucket number, to the session's checkpoint folder;
2. per-bucket counts (``B`` rows) and their prefix sums;
3. only the bucket(s) holding the two interpolation ranks are ranked with a
   window partitioned by bucket, i.e. about 1/B of the distinct values.

The interpolation follows numpy's ``linear`` method, including its
``b - (b-a)*(1-t)`` form for ``t >= 0.5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.session import cut_lineage

DEFAULT_BUCKETS = None  # None: spark.sql.shuffle.partitions, adjacent ranges merged by AQE


def bucketed_histogram(df: DataFrame, column: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """(v, c, bucket): distinct non-NULL values, their counts and an ordered bucket id.

    Range partitioning keeps buckets ordered by value (AQE may merge adjacent
    partitions, which keeps the order); the table is materialised so that
    every later read sees the same bucket ids.
    """
    vals = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    hist = vals.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    ranged = (hist.repartitionByRange("v") if buckets is None
              else hist.repartitionByRange(int(buckets), "v"))
    ranged = ranged.withColumn("bucket", F.spark_partition_id())
    return cut_lineage(ranged)


def quantile_frame(df: DataFrame, column: str, q: float,
                   buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """One row ``(n, quantile)``; quantile is NULL when the column has no values."""
    tagged = bucketed_histogram(df, column, buckets)
    per_bucket = tagged.groupBy("bucket").agg(F.sum("c").alias("bc"), F.min("v").alias("lo"))
    # prefix sums over at most B rows (bounded by the bucket count); buckets are
    # ordered by their smallest value, which is the range order
    w_pref = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(
        "bucket", "bc", F.coalesce(F.sum("bc").over(w_pref), F.lit(0)).alias("before"))
    n = per_bucket.agg(F.sum("bc")).scalar()
    pos = F.lit(float(q)) * (n - 1)
    k_lo = F.floor(pos)
    k_hi = F.ceil(pos)
    wanted = prefix.where(
        ((F.col("before") <= k_lo) & (k_lo < F.col("before") + F.col("bc")))
        | ((F.col("before") <= k_hi) & (k_hi < F.col("before") + F.col("bc"))))
    w_in = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (tagged.join(wanted.select("bucket", "before"), "bucket")
              .select("v", "c", (F.col("before") + F.coalesce(F.sum("c").over(w_in), F.lit(0)))
                      .alias("start")))
    picks = ranked.agg(
        F.max(F.when((F.col("start") <= k_lo) & (k_lo < F.col("start") + F.col("c")), F.col("v"))).alias("a"),
        F.max(F.when((F.col("start") <= k_hi) & (k_hi < F.col("start") + F.col("c")), F.col("v"))).alias("b"),
    )
    t = pos - k_lo
    diff = F.col("b") - F.col("a")
    lerp = F.when(t >= 0.5, F.col("b") - diff * (1 - t)).otherwise(F.col("a") + diff * t)
    return picks.select(n.cast("bigint").alias("n"),
                        F.when(n > 0, lerp).otherwise(F.lit(None).cast("double")).alias("quantile"))


def quantile_scalar(df: DataFrame, column: str, q: float,
                    buckets: int | None = DEFAULT_BUCKETS) -> Column:
    """The exact quantile as a scalar-subquery Column (no join needed to use it)."""
    return quantile_frame(df, column, q, buckets).select("quantile").scalar()
