"""Sketches against exact figures; planted cycles, trends, gaps and noise for the seasonality flag."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from adlens.operators import metrics as M
from adlens.operators import seasonality as Z
from adlens.operators import sketches as K


def test_any_period_from_daily_sketches_is_within_its_bounds(spark, facts):
    daily = K.daily_sketches(facts)
    for start, end in (("1995-01-01", "1995-01-01"), ("1995-01-01", "1995-12-31"), ("1900-01-01", "2100-01-01"), ("2050-01-01", "2050-02-01")):
        got = K.of_range(daily, start, end, quantiles=(0.25, 0.75)).first()
        own = facts.where(F.col("date").between(start, end))
        exact = own.agg(F.count("*").alias("rows"), F.countDistinct("campaign_name").alias("n"), F.count("ctr").alias("values")).first()
        assert (got["rows"] or 0, got["values"]) == (exact["rows"], exact["values"])
        assert abs((got["distinct_estimate"] or 0) - exact["n"]) <= 3 * K.COUNT_ERROR * exact["n"] + 0.5
        values = sorted(r["ctr"] for r in own.where("ctr IS NOT NULL").select("ctr").collect())
        for q in (0.25, 0.75):
            if not values:
                assert got[f"q{round(100 * q)}"] is None
                continue
            x = got[f"q{round(100 * q)}"]
            below, upto = (sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values))
            assert below - 3 * K.RANK_ERROR <= q <= upto + 3 * K.RANK_ERROR + 1 / len(values)


def test_many_distinct_values_and_odd_rows(spark):
    n = 200_000
    df = spark.range(n).select(F.expr("date_add('2024-01-01', CAST(id % 40 AS INT))").alias("date"),
                               F.expr("concat('c', id % 50000)").alias("campaign_name"),
                               F.expr("IF(id % 11 = 0, double('NaN'), IF(id % 13 = 0, NULL, id / 200000.0))").alias("ctr"))
    df = df.union(spark.createDataFrame([(None, "x", 0.5)], "date date, campaign_name string, ctr double"))
    got = K.merged(K.daily_sketches(df)).first()
    assert got["rows"] == n and got["values"] == sum(i % 11 != 0 and i % 13 != 0 for i in range(n))
    assert abs(got["distinct_estimate"] / 50_000 - 1) < 4 * K.COUNT_ERROR and abs(got["q75"] - 0.75) < 3 * K.RANK_ERROR
    by_month = K.merged(K.daily_sketches(df), F.date_trunc("month", "date").cast("date").alias("month")).collect()
    assert sorted(r["month"] for r in by_month) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def daily_of(spark, revenue, gaps=()):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), 100.0, 100.0 * v, 1000, 10) for i, v in enumerate(revenue) if i not in gaps]
    return spark.createDataFrame(rows, "date date, spend double, revenue double, impressions long, clicks long")


def flag(spark, revenue, **k):
    return {r["metric"]: r for r in Z.seasonality(daily_of(spark, revenue, **k)).collect()}["roas"]


def test_planted_cycles_are_found(spark):
    pick = random.Random(3)
    for period in (5, 7, 14):
        wave = [3 + math.sin(2 * math.pi * i / period) + 0.01 * i + pick.gauss(0, 0.15) for i in range(180)]
        r = flag(spark, wave, gaps={20, 21, 90})
        assert r["seasonal"] and r["lag"] % period == 0 and (r["days"], r["gaps"]) == (180, 3), r


def test_noise_trends_and_short_series_are_not_seasonal(spark):
    for seed in range(4):
        pick = random.Random(seed)
        assert not flag(spark, [3 + pick.gauss(0, 1) for _ in range(200)])["seasonal"]
    assert not flag(spark, [3 + 0.05 * i for i in range(100)])["seasonal"]
    assert not flag(spark, [1.0, 2.0, 1.0])["seasonal"]
    assert flag(spark, [2.0] * 50)["lag"] is None
    assert Z.seasonality(daily_of(spark, [])).collect() == []


def test_autocorrelation_equals_plain_computation(spark):
    pick = random.Random(9)
    x = [2 + pick.random() for _ in range(60)]
    got = {r["lag"]: r["autocorrelation"] for r in Z.autocorrelations(Z.daily_ratios(daily_of(spark, x))).where("metric = 'roas'").collect()}
    d = [b - a for a, b in zip(x, x[1:])]
    d = [v - sum(d) / len(d) for v in d]
    for lag in range(1, 29):
        assert math.isclose(got[lag], sum(a * b for a, b in zip(d, d[lag:])) / sum(v * v for v in d), rel_tol=1e-9, abs_tol=1e-12)


def test_daily_sums_feed_it(facts):
    rows = Z.seasonality(M.daily_sums(facts)).collect()
    assert {r["metric"] for r in rows} == {"roas", "ctr"} and all(r["days"] > 300 for r in rows)
