import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens.functions import stats
from adlens.functions.quantile import quantile_frame


def p_values(spark, rows):
    df = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(rows)], "i int, t double, dof double")
    return [r.p for r in df.select("i", stats.p_value(F.col("t"), F.col("dof")).alias("p")).orderBy("i").collect()]


def test_p_value_matches_the_distribution(spark):
    jvm = spark._jvm.org.apache.commons.math3.distribution.TDistribution
    rows = [(0.5, 3.0), (2.1, 10.0), (-1.7, 25.0), (3.5, 120.0), (0.01, 1.0), (8.0, 4000.0), (2.0, 9999.0), (2.0, 10001.0), (5.0, 20000.0)]
    for (t, dof), got in zip(rows, p_values(spark, rows)):
        assert got == pytest.approx(2 * jvm(dof).cumulativeProbability(-abs(t)), rel=1e-8, abs=1e-300)


def test_p_value_keeps_its_digits_at_large_dof(spark):
    """Against the expansion of the t tail in 1/dof, whose error is of order 1/dof^3."""
    rows = [(t, dof) for t in (0.1, 1.0, 2.0, 4.0, 6.0) for dof in (1e6, 1e8, 1e10, 1e12)]
    for (t, v), got in zip(rows, p_values(spark, rows)):
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        more = (t ** 3 + t) / (4 * v) + (3 * t ** 7 - 5 * t ** 5 - 7 * t ** 3 - 3 * t) / (96 * v * v)
        assert got == pytest.approx(math.erfc(t / math.sqrt(2)) + 2 * density * more, rel=1e-9)


def test_p_value_edges(spark):
    assert p_values(spark, [(None, 5.0), (1.0, None), (1.0, 0.0), (float("inf"), 5.0), (float("-inf"), 1e9), (0.0, 1e9)]) \
        == [None, None, None, 0.0, 0.0, 1.0]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.sampled_from([0.0, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_quantile_matches_numpy(spark, values, q):
    vals = [v / 7.0 for v in values]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = quantile_frame(df, "x", q, buckets=4).collect()[0]
    assert got.n == len(vals)
    assert got.quantile == pytest.approx(float(np.quantile(np.array(vals), q)), rel=1e-12, abs=1e-12)


def test_quantile_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile_frame(df, "x", 0.75).collect()[0].quantile is None
