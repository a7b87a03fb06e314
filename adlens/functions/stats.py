"""P-value of the two-sample Student t-test from sufficient statistics.

The heavy part (n, mean, sample variance per segment) is a hash aggregate
elsewhere, and t, degrees of freedom and interval are arithmetic on one row of
statistics per segment pair (``operators/evidence.py``).  The p-value needs
special functions that Spark SQL lacks; they are called JVM-side through
``reflect`` in the commons-math library that ships with Spark, on the already
aggregated rows (a handful per analysis), never per fact row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From so many degrees of freedom the normal transformation is used: the
#: incomplete beta function loses digits as its argument nears one.
LARGE_DOF = 1e4


def _reflected(cls: str, method: str, *args: Column) -> Column:
    return F.call_function("reflect", F.lit(f"org.apache.commons.math3.special.{cls}"), F.lit(method),
                           *[a.cast("double") for a in args]).cast("double")


def p_value(t: Column, dof: Column) -> Column:
    """Two-sided p-value; infinite |t| gives 0, NULL t gives NULL.

    Below ``LARGE_DOF`` the regularised incomplete beta function
    I_x(dof / 2, 1 / 2) at x = dof / (dof + t^2).  Beyond, Hill's normal
    transformation (CACM algorithm 395): y = (dof - 1/2) log(1 + t^2 / dof),
    computed with log1p, turned into a normal deviate by a series in 1 / dof^2
    whose error is below double precision there.
    """
    dof = dof.cast("double")
    exact = F.least(F.lit(1.0), _reflected("Beta", "regularizedBeta", dof / (dof + t * t), dof / 2.0, F.lit(0.5)))
    a = dof - 0.5
    b = 48.0 * a * a
    y = a * F.log1p(t * t / dof)
    tail = (((-0.4 * y - 3.3) * y - 24.0) * y - 85.5) / (0.8 * y * y + 100.0 + b)
    normal = F.sqrt(y) * (1.0 + (y + 3.0 + tail) / b)
    large = _reflected("Erf", "erfc", normal / F.sqrt(F.lit(2.0)))
    return (F.when(t.isNull() | dof.isNull() | (dof <= 0), F.lit(None).cast("double"))
            .when(F.abs(t) == float("inf"), F.lit(0.0))
            .when(dof < LARGE_DOF, exact).otherwise(large))
