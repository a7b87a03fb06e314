"""Tagging of free-text analysis requests (intent, focus metric, period, validity).

Runs as Column expressions over any table with a text column, one output
row per request; no UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.ratios import stripped

# Keyword rules, in precedence order.
ROAS_WORDS = ["roas", "return on ad spend", "roi"]
CREATIVE_WORDS = ["creative", "ad copy", "recommendation"]
PERIOD_PHRASES = [
    (7, ["last 7 days", "past 7 days", "last week"]),
    (14, ["last 14 days", "past 14 days", "last 2 weeks"]),
    (30, ["last 30 days", "past 30 days", "last month"]),
]
WORKFLOW_OF_INTENT = {"roas_analysis": "analysis", "creative_generation": "creative_generation",
                      "full_analysis": "full"}
ISO_DATE = r"\d{4}-\d{2}-\d{2}"


def _any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def intent(text: Column) -> Column:
    t = F.lower(text)
    return (F.when(_any(t, ROAS_WORDS), F.lit("roas_analysis"))
            .when(_any(t, CREATIVE_WORDS), F.lit("creative_generation"))
            .otherwise(F.lit("full_analysis")))


def focus_metric(text: Column) -> Column:
    t = F.lower(text)
    return (F.when(t.contains("ctr") | t.contains("click"), F.lit("ctr"))
            .when(t.contains("roas"), F.lit("roas"))
            .when(t.contains("conversion") | t.contains("cvr"), F.lit("cvr")))


def workflow_type(intent_col: Column) -> Column:
    expr = None
    for k, v in WORKFLOW_OF_INTENT.items():
        expr = F.when(intent_col == k, F.lit(v)) if expr is None else expr.when(intent_col == k, F.lit(v))
    return expr.otherwise(F.lit("full"))


def period(text: Column, as_of) -> tuple[Column, Column]:
    """(date_from, date_to): relative phrases end at ``as_of``; else the first two ISO
    dates; else one ISO date d -> [d-7, d]; else NULL."""
    t = F.lower(text)
    hi = F.to_date(F.lit(str(as_of))) if not isinstance(as_of, Column) else as_of
    dates = F.regexp_extract_all(t, F.lit(ISO_DATE), 0)
    d1 = F.try_element_at(dates, F.lit(1))
    d2 = F.try_element_at(dates, F.lit(2))
    frm, to = None, None
    for days, phrases in PERIOD_PHRASES:
        cond = _any(t, phrases)
        frm = F.when(cond, F.date_sub(hi, days)) if frm is None else frm.when(cond, F.date_sub(hi, days))
        to = F.when(cond, hi) if to is None else to.when(cond, hi)
    n = F.size(dates)
    frm = frm.when(n >= 2, F.try_to_date(d1, "yyyy-MM-dd")) \
             .when(n == 1, F.date_sub(F.try_to_date(d1, "yyyy-MM-dd"), 7))
    to = to.when(n >= 2, F.try_to_date(d2, "yyyy-MM-dd")) \
           .when(n == 1, F.try_to_date(d1, "yyyy-MM-dd"))
    return frm, to


def is_valid(text: Column) -> Column:
    """At least five characters besides white space at the ends."""
    return F.coalesce(F.length(stripped(text)) >= 5, F.lit(False))


def tag_requests(df: DataFrame, text_col: str = "text", as_of="2025-12-01",
                 keys=("conv_id", "turn")) -> DataFrame:
    """One row per request: keys, intent, focus_metric, date_from, date_to, workflow_type, valid."""
    txt = F.col(text_col)
    it = intent(txt)
    frm, to = period(txt, as_of)
    return df.select(*[k for k in keys if k in df.columns],
                     it.alias("intent"), focus_metric(txt).alias("focus_metric"),
                     frm.alias("date_from"), to.alias("date_to"),
                     workflow_type(it).alias("workflow_type"), is_valid(txt).alias("valid"))
