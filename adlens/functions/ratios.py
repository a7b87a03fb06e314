"""Column expressions for ratios, changes and scores (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """``num/den`` when ``den > 0``, else 0.0 (a NULL denominator also gives 0.0)."""
    n, d = col_(num), col_(den)
    return F.coalesce(F.when(d > 0, F.try_divide(n.cast("double"), d.cast("double"))),
                      F.lit(0.0))


def period_ratio(num: str | Column, den: str | Column) -> Column:
    """``num/den`` with a zero denominator giving NULL (a missing value, not 0)."""
    n, d = col_(num), col_(den)
    return F.try_divide(n.cast("double"), F.nullif(d, F.lit(0)).cast("double"))


def pct_change(last: str | Column, prev: str | Column) -> Column:
    """Percent change ``(last-prev)/prev*100``; 0.0 when prev is missing or zero.

    A missing ``last`` with a usable ``prev`` stays missing.
    """
    lst, prv = col_(last), col_(prev)
    return (F.when(prv.isNull() | (prv == 0), F.lit(0.0))
            .otherwise((lst - prv) / prv * 100.0))


def trend_direction(wow: str | Column, mom: str | Column, stable_threshold: float) -> Column:
    """increasing / decreasing when the mean absolute change exceeds the threshold (in %)."""
    w, m = col_(wow), col_(mom)
    avg_change = (F.abs(w) + F.abs(m)) / 2.0
    return (F.when(avg_change > stable_threshold * 100.0,
                   F.when((w > 0) | (m > 0), F.lit("increasing")).otherwise(F.lit("decreasing")))
            .otherwise(F.lit("stable")))


def clamp01(c: Column) -> Column:
    """Clamp into [0, 1]; NULL stays NULL (greatest/least would skip it)."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def initial_confidence(magnitude: Column, max_magnitude: float) -> Column:
    """``0.3 + 0.5*min(magnitude/max, 1)`` clamped to [0, 1]; missing magnitude counts as 0."""
    m = F.coalesce(magnitude, F.lit(0.0))
    return clamp01(F.lit(0.3) + F.least(m / float(max_magnitude), F.lit(1.0)) * 0.5)


def money_sum(df: DataFrame, name: str) -> Column:
    """Sum of a money column, exact when integer cents are carried (``<name>_cents``)."""
    cents = f"{name}_cents"
    if cents in df.columns:
        return F.coalesce(F.sum(cents), F.lit(0)).cast("double") / 100.0
    return F.coalesce(F.sum(F.col(name).cast("double")), F.lit(0.0))


def count_sum(name: str) -> Column:
    """Sum of a count column (impressions, clicks, purchases); 0 for none."""
    return F.coalesce(F.sum(F.col(name)), F.lit(0))


def fmt(pattern: str, *cols: Column) -> Column:
    """printf-style text (``%.2f`` etc.) built JVM-side."""
    return F.format_string(pattern, *cols)


#: White space as Unicode defines it, with the separators U+001C-U+001F.
WHITE = r"[\x09-\x0D\x1C-\x1F\x20\x85\p{Z}]"


def stripped(text: Column) -> Column:
    """``text`` without white space at both ends (``trim`` knows the plain space only)."""
    return F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", "")
