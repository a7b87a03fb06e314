"""Creative recommendations for low-CTR campaigns.

Per-campaign modes come from one GROUPING SETS count over (campaign, value)
pairs followed by a ``min_by`` per campaign (ties -> smallest value): both
levels are partial aggregates, so a campaign holding a third of all rows is
reduced map-side and never gathered into one task.  Variations are built
with array functions on one row per low-CTR campaign; the per-type CTR
lookup is an equi-join to the creative-type segments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.quantile import quantile_scalar
from adlens.functions.ratios import clamp01, fmt
from adlens.params import Params

# Recommendable creative types, message templates per audience
# tag and discount offers, in their defined order.
CREATIVE_TYPES = ["image", "video", "carousel", "collection"]
MESSAGE_TEMPLATES = {
    "female_18_30": [
        "Trendy comfort meets style - {discount}",
        "Feel confident all day - {discount}",
        "Your perfect fit awaits - {discount}",
    ],
    "female_31_45": [
        "Premium quality for everyday comfort - {discount}",
        "Designed for your lifestyle - {discount}",
        "Comfort that lasts - {discount}",
    ],
    "male_18_24": [
        "Athletic performance meets comfort - {discount}",
        "Minimalist design, maximum comfort - {discount}",
        "Built for your active life - {discount}",
    ],
    "male_25_40": [
        "Professional comfort for busy days - {discount}",
        "Quality essentials for modern men - {discount}",
        "Upgrade your basics - {discount}",
    ],
    "default": [
        "Premium comfort at great prices - {discount}",
        "Discover your new favorites - {discount}",
        "Quality you can feel - {discount}",
    ],
}
DISCOUNTS = ["20% off", "Buy 1 Get 1", "30% off first order", "Free shipping"]
FALLBACK_BEST_TYPES = ["video", "carousel", "image"]

MODE_FIELDS = ("creative_type", "creative_message", "audience_type")


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def campaign_modes(df: DataFrame) -> DataFrame:
    """Per campaign: most frequent creative_type, creative_message, audience_type
    (NULLs ignored, ties -> smallest value).  Absent columns give NULL."""
    fields = [f for f in MODE_FIELDS if f in df.columns]
    camp = "campaign_name"
    if not fields:
        return df.select(camp).distinct().select(
            camp, *[F.lit(None).cast("string").alias(f"mode_{f}") for f in MODE_FIELDS])
    counted = (df.groupingSets([[camp, f] for f in fields], camp, *fields)
               .agg(F.count(F.lit(1)).alias("cnt"),
                    *[F.grouping(f).alias(f"_g_{i}") for i, f in enumerate(fields)]))
    which = reduce(lambda acc, i: acc.when(F.col(f"_g_{i}") == 0, F.lit(fields[i])),
                   range(1, len(fields)), F.when(F.col("_g_0") == 0, F.lit(fields[0])))
    value = reduce(lambda acc, i: acc.when(F.col(f"_g_{i}") == 0, F.col(fields[i]).cast("string")),
                   range(1, len(fields)), F.when(F.col("_g_0") == 0, F.col(fields[0]).cast("string")))
    pairs = counted.select(camp, which.alias("field"), value.alias("value"), "cnt")
    key = F.struct((-F.col("cnt")).alias("n"), F.col("value").alias("v"))
    best = (pairs.groupBy(camp).agg(*[
        F.min_by(F.col("value"), F.when((F.col("field") == f) & F.col("value").isNotNull(), key))
        .alias(f"mode_{f}") for f in fields]))
    for f in MODE_FIELDS:
        if f not in fields:
            best = best.withColumn(f"mode_{f}", F.lit(None).cast("string"))
    return best.select(camp, *[f"mode_{f}" for f in MODE_FIELDS])


def low_ctr_campaigns(seg: DataFrame, df: DataFrame, params: Params = Params()) -> DataFrame:
    """Campaign segments with ctr < threshold that have rows in ``df``, with their modes."""
    low = (seg.where((F.col("dimension") == "campaign_name") & (F.col("ctr") < params.low_ctr))
           .select(F.col("value").alias("campaign_name"), F.col("ctr").alias("current_ctr"), "spend"))
    j = low.join(campaign_modes(df), "campaign_name", "inner")
    has_type = "creative_type" in df.columns
    has_msg = "creative_message" in df.columns
    return j.select(
        F.col("campaign_name").alias("campaign"), "current_ctr", "spend",
        (F.coalesce("mode_creative_type", F.lit("unknown")) if has_type else F.lit("unknown"))
        .alias("current_creative_type"),
        (F.coalesce("mode_creative_message", F.lit("")) if has_msg else F.lit(""))
        .alias("current_message"),
        F.col("mode_audience_type").alias("mode_audience_type"))


def best_creative_types(seg: DataFrame, k: int = 2) -> DataFrame:
    """One row: array of the top-k creative types by CTR (ties: spend desc, value asc)."""
    top = (seg.where(F.col("dimension") == "creative_type")
           .orderBy(F.col("ctr").desc(), F.col("spend").desc(), F.col("value").asc()).limit(k))
    srt = F.sort_array(F.collect_list(F.struct((-F.col("ctr")).alias("c"), (-F.col("spend")).alias("s"),
                                               F.col("value").alias("v"))))
    return top.agg(F.transform(srt, lambda e: e["v"]).alias("best_types"))


def ctr_p75(df: DataFrame) -> DataFrame:
    """One row: exact 75th percentile (linear) of the row-level ctr and the value count."""
    from adlens.functions.quantile import quantile_frame
    return quantile_frame(df, "ctr", 0.75).select(F.col("n").alias("ctr_values"),
                                                  F.col("quantile").alias("ctr_p75"))


def high_ctr_messages(df: DataFrame, k: int = 3) -> DataFrame:
    """Top-k messages by frequency among rows with ctr above the exact 75th percentile."""
    if "creative_message" not in df.columns or "ctr" not in df.columns:
        return df.sparkSession.createDataFrame([], "rank int, creative_message string, rows bigint")
    p75 = quantile_scalar(df, "ctr", 0.75)
    hi = df.where(F.col("ctr") > p75).where(F.col("creative_message").isNotNull())
    top = (hi.groupBy("creative_message").agg(F.count(F.lit(1)).alias("rows"))
           .orderBy(F.col("rows").desc(), F.col("creative_message").asc()).limit(k))
    srt = F.sort_array(F.collect_list(F.struct((-F.col("rows")).alias("n"), F.col("creative_message").alias("m"))))
    return (top.agg(srt.alias("a")).select(F.posexplode("a").alias("pos", "e"))
            .select((F.col("pos") + 1).alias("rank"), F.col("e.m").alias("creative_message"),
                    (-F.col("e.n")).alias("rows")))


def audience_tag(name: Column, mode_audience: Column, substring_rules: bool = True) -> Column:
    """Audience template key from the campaign name, else the campaign's audience mode, else default."""
    low = F.lower(name)
    if substring_rules:
        has = lambda s: low.contains(s)
        female, male = has("female"), has("male")
    else:
        has = lambda s: low.rlike(rf"(^|[^0-9]){s}([^0-9]|$)")
        female = low.rlike(r"(^|[^a-z])female([^a-z]|$)")
        male = low.rlike(r"(^|[^a-z])male([^a-z]|$)")
    return (F.when(female & has("18"), F.lit("female_18_30"))
            .when(female & (has("30") | has("31")), F.lit("female_31_45"))
            .when(male & has("18"), F.lit("male_18_24"))
            .when(male & (has("25") | has("30")), F.lit("male_25_40"))
            .otherwise(F.coalesce(mode_audience, F.lit("default"))))


def _templates_for(aud: Column) -> Column:
    m = F.create_map(*[x for key, tpl in MESSAGE_TEMPLATES.items() for x in (F.lit(key), _lit_array(tpl))])
    return F.coalesce(F.try_element_at(m, aud), _lit_array(MESSAGE_TEMPLATES["default"]))


def creative_candidates(low: DataFrame, best: DataFrame, params: Params = Params()) -> DataFrame:
    """Per low-CTR campaign: audience tag, best types, ordered candidate types, variation count."""
    best_types = best.select("best_types").scalar()
    cur = F.col("current_creative_type")
    bt = F.coalesce(best_types, F.array().cast("array<string>"))
    bt = F.when(F.size(bt) == 0, _lit_array(FALLBACK_BEST_TYPES)).otherwise(bt)
    with_best = low.select("*", best_types.alias("best_types_raw"), bt.alias("seed_types"))
    cand = F.array_distinct(F.concat(
        F.filter("seed_types", lambda x: ~x.eqNullSafe(cur)),
        F.filter(_lit_array(CREATIVE_TYPES), lambda x: ~x.eqNullSafe(cur))))
    return with_best.select(
        "campaign", "current_ctr", "current_creative_type", "current_message",
        audience_tag(F.col("campaign"), F.col("mode_audience_type"), params.audience_substring_rules)
        .alias("audience_type"),
        F.coalesce(F.col("best_types_raw"), F.array().cast("array<string>")).alias("best_types"),
        cand.alias("candidate_types"),
        F.greatest(F.lit(3), F.least(F.lit(4), F.size(cand))).alias("n_variations"))


def creative_variations(cands: DataFrame, seg: DataFrame) -> DataFrame:
    """One row per (campaign, variation index) with type, message, scores and rationale."""
    ex = cands.select("*", F.explode(F.sequence(F.lit(0), F.col("n_variations") - 1)).alias("i"))
    n_c = F.size("candidate_types")
    ex = ex.select(
        "*",
        F.element_at("candidate_types", (F.col("i") % n_c + 1).cast("int")).alias("creative_type"),
        F.element_at(_templates_for(F.col("audience_type")), (F.col("i") % 3 + 1).cast("int")).alias("template"),
        F.element_at(_lit_array(DISCOUNTS), (F.col("i") % len(DISCOUNTS) + 1).cast("int")).alias("discount"))
    type_ctr = (seg.where(F.col("dimension") == "creative_type")
                .select(F.col("value").alias("creative_type"), F.col("ctr").alias("type_ctr")))
    j = ex.join(type_ctr, "creative_type", "left")
    cur = F.col("current_ctr")
    avg_ctr = F.coalesce(F.col("type_ctr"), cur * 1.5)
    improvement = F.greatest(F.lit(10.0), F.least(
        F.lit(100.0), (avg_ctr - cur) / F.greatest(cur, F.lit(0.001)) * 100))
    pos = F.array_position("best_types", F.col("creative_type"))
    conf = (F.lit(0.6) + F.when(pos == 1, F.lit(0.2)).when(pos == 2, F.lit(0.1)).otherwise(F.lit(0.0))
            + F.when(F.col("type_ctr").isNotNull() & (F.col("type_ctr") > cur * 1.5), F.lit(0.1))
            .otherwise(F.lit(0.0)))
    in_best = F.array_contains("best_types", F.col("creative_type"))
    parts = F.concat_ws(", ",
                        F.when(~F.col("creative_type").eqNullSafe(F.col("current_creative_type")),
                               F.concat(F.lit("Switching from "), F.coalesce(F.col("current_creative_type"), F.lit("None")),
                                        F.lit(" to "), F.col("creative_type"), F.lit(" format"))),
                        F.when(in_best, F.concat(F.col("creative_type"), F.lit(" is among top-performing creative types"))),
                        F.when(F.col("audience_type") != "default",
                               F.concat(F.lit("tailored for "), F.col("audience_type"), F.lit(" audience"))),
                        fmt("expected to improve CTR by %.0f%%", improvement))
    rationale = F.concat(F.upper(F.substring(parts, 1, 1)), F.substring(parts, 2, 1 << 30), F.lit("."))
    return j.select(
        "campaign", "i",
        F.sha2(F.concat_ws("~", F.col("campaign"), F.col("i").cast("string")), 256).alias("creative_id"),
        "creative_type",
        F.replace(F.col("template"), F.lit("{discount}"), F.col("discount")).alias("creative_message"),
        "audience_type",
        rationale.alias("rationale"),
        clamp01(conf).alias("confidence_score"),
        improvement.cast("double").alias("expected_ctr_improvement"),
        "current_ctr", "current_creative_type", "current_message")


def recommendations(variations: DataFrame) -> DataFrame:
    """One row per campaign with its variations (3-4 per campaign) as an ordered array."""
    v = F.struct("i", "creative_id", "creative_type", "creative_message", "audience_type",
                 "rationale", "confidence_score", "expected_ctr_improvement")
    g = variations.groupBy("campaign", "current_ctr", "current_creative_type", "current_message") \
        .agg(F.sort_array(F.collect_list(v)).alias("v"))
    return g.select("campaign", "current_ctr", "current_creative_type", "current_message",
                    F.transform("v", lambda e: e.dropFields("i")).alias("new_creatives"))


def creative_pipeline(seg: DataFrame, df: DataFrame, params: Params = Params()) -> dict:
    low = low_ctr_campaigns(seg, df, params)
    cands = creative_candidates(low, best_creative_types(seg), params)
    var = creative_variations(cands, seg)
    return {"low_ctr": low, "candidates": cands, "variations": var, "recommendations": recommendations(var)}


def recommendation_summary(variations: DataFrame, low: DataFrame) -> DataFrame:
    """One row: campaigns, their mean CTR, variations, mean variations per campaign, mean confidence."""
    c = low.agg(F.count(F.lit(1)).alias("low_ctr_campaigns"), F.avg("current_ctr").alias("avg_low_ctr"))
    v = variations.agg(F.count(F.lit(1)).alias("total_variations"),
                       F.countDistinct("campaign").alias("campaigns_with_variations"),
                       F.avg("confidence_score").alias("avg_confidence"))
    return c.select(
        "low_ctr_campaigns", "avg_low_ctr",
        v.select("total_variations").scalar().alias("total_variations"),
        v.select(F.when(F.col("campaigns_with_variations") > 0,
                        F.col("total_variations") / F.col("campaigns_with_variations"))).scalar()
        .alias("avg_variations_per_campaign"),
        v.select("avg_confidence").scalar().alias("avg_confidence"))
