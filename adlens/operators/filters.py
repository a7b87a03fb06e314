"""Row filters on the fact table (pushed to the parquet scan by Catalyst)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(str(d)))


def date_range(df: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive date range; either bound may be omitted."""
    if start is not None:
        df = df.where(F.col("date") >= _date_lit(start))
    if end is not None:
        df = df.where(F.col("date") <= _date_lit(end))
    return df


def last_n_days(df: DataFrame, n: int, as_of) -> DataFrame:
    """``[as_of - n days, as_of]`` inclusive (n+1 calendar days)."""
    hi = _date_lit(as_of)
    return df.where((F.col("date") >= F.date_sub(hi, int(n))) & (F.col("date") <= hi))
