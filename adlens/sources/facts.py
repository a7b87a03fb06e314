"""The ad fact table over the driver's TPC-H-style tables.

This module only shapes input: it gives rows in the fact schema the
analysis expects (one row per campaign/ad-set/day) and does none of the
analysis.  Money is carried as integer cents (exact, order-independent
sums) next to the DOUBLE amounts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its files are listed anew by every call, so appended ones are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: list[tuple[object, object]], default: object) -> Column:
    expr = None
    for key, val in mapping:
        expr = (F.when(col == key, F.lit(val)) if expr is None
                else expr.when(col == key, F.lit(val)))
    return expr.otherwise(F.lit(default))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part ⋈ (orders ⋈ customer ⋈ nation), only needed columns.

    Join strategy is left to Catalyst/AQE: the nation side is tiny and is
    broadcast by the size-checked automatic threshold; the lineitem/orders
    and lineitem/part joins stay shuffle joins at scale.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    oc = (orders.join(cust, orders.o_custkey == cust.c_custkey)
          .join(nation, cust.c_nationkey == nation.n_nationkey)
          .select("o_orderkey", "c_mktsegment", "n_name"))
    return (li.join(part, li.l_partkey == part.p_partkey)
            .join(oc, li.l_orderkey == oc.o_orderkey))


def _fact_columns() -> list[Column]:
    size5 = F.col("p_size") % 5
    size4 = F.col("p_size") % 4
    click_mult = _case(size4, [(0, 0.5), (1, 1.5), (2, 1.0)], 1.25).cast("double")
    status_mult = _case(F.col("l_linestatus"), [("O", 1.5)], 0.9).cast("double")
    segment_mult = _case(F.col("c_mktsegment"), [("BUILDING", 0.4), ("MACHINERY", 1.2)], 1.0).cast("double")
    brand_mult = (F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), F.lit(0.5))
                  .otherwise(F.lit(1.0)).cast("double"))
    audience_tag = _case(size5, [(0, "Female_18-30"), (1, "Female_31-45"),
                                 (2, "Male_18-24"), (3, "Male_25-40")], "Broad")
    return [
        F.concat(F.col("p_brand"), F.lit("_"), audience_tag).alias("campaign_name"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("l_returnflag")).alias("adset_name"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.floor(F.col("l_extendedprice") * F.abs(F.col("l_discount")) * 100 + 0.5)
         .cast("bigint").alias("spend_cents"),
        F.floor(F.col("l_quantity") * 1000).cast("bigint").alias("impressions"),
        F.floor(F.col("l_quantity") * 1000 * F.col("l_tax") / 4 * click_mult)
         .cast("bigint").alias("clicks"),
        F.col("l_linenumber").cast("bigint").alias("purchases"),
        F.floor(F.col("l_extendedprice") * F.col("l_tax") * 300 * status_mult * segment_mult
                * brand_mult + 0.5).cast("bigint").alias("revenue_cents"),
        _case(size4, [(0, "image"), (1, "video"), (2, "carousel")], "collection").alias("creative_type"),
        F.col("p_name").alias("creative_message"),
        F.col("c_mktsegment").alias("audience_type"),
        _case(F.col("l_linestatus"), [("O", "Facebook")], "Instagram").alias("platform"),
        F.col("n_name").alias("country"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_ord"),
        F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
    ]


def ad_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean fact table: typed columns, cents plus DOUBLE money, row-level ratios."""
    base = _joined(spark, sf_dir).select(*_fact_columns())
    return base.select(
        "campaign_name", "adset_name", "date",
        (F.col("spend_cents") / 100.0).alias("spend"),
        "impressions", "clicks", "purchases",
        (F.col("revenue_cents") / 100.0).alias("revenue"),
        "creative_type", "creative_message", "audience_type", "platform", "country",
        (F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0))).alias("ctr"),
        (F.col("revenue_cents") / F.nullif(F.col("spend_cents"), F.lit(0))).alias("roas"),
        "spend_cents", "revenue_cents", "row_ord",
    )


def raw_ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string fact rows as a CSV reader would give them, with dirty values.

    Money is written in cents.  Injected dirt: ``not-a-number`` spend,
    ``invalid-date`` dates and missing revenue on fixed order-key classes.
    ``row_ord`` is the input ordinal (file position): lines of one order that
    share a number are told apart by part and supplier, by arithmetic alone.
    """
    ordinal = F.col("row_ord") * (1 << 20) + (F.col("l_partkey") * 8191 + F.col("l_suppkey")) % (1 << 20)
    return _raw_rows(_joined(spark, sf_dir).select(*_fact_columns()), ordinal)


def numbered_ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_ad_rows`` whose ordinal is counted: lines of one order that share a number are numbered by a window
    over all their columns, so that no two rows have the same (up to 999 lines that share a number)."""
    same = Window.partitionBy("row_ord").orderBy(*[F.asc_nulls_last(c) for c in (
        "date", "campaign_name", "adset_name", "spend_cents", "impressions", "clicks", "revenue_cents", "creative_message",
        "country", "creative_type", "audience_type", "platform", "purchases", "l_orderkey")])
    return _raw_rows(_joined(spark, sf_dir).select(*_fact_columns()), F.col("row_ord") * 1000 + F.row_number().over(same))


def _raw_rows(base: DataFrame, ordinal: Column) -> DataFrame:
    ok = F.col("l_orderkey")
    s = lambda c: F.col(c).cast("string")
    return base.select(
        ordinal.alias("row_ord"),
        "campaign_name", "adset_name",
        F.when(ok % 89 == 0, F.lit("invalid-date")).otherwise(s("date")).alias("date"),
        F.when(ok % 97 == 0, F.lit("not-a-number")).otherwise(s("spend_cents")).alias("spend"),
        s("impressions").alias("impressions"),
        s("clicks").alias("clicks"),
        s("purchases").alias("purchases"),
        F.when(ok % 83 == 0, F.lit(None).cast("string")).otherwise(s("revenue_cents")).alias("revenue"),
        "creative_type", "creative_message", "audience_type", "platform", "country",
    )
