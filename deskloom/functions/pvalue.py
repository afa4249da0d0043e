"""Significance of a correlation as an Arrow UDF (called on aggregated rows)."""

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def regularised_beta(x: float, a: float, b: float) -> float:
    """I_x(a, b) by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularised_beta(1.0 - x, b, a)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    tiny = 1e-300
    upper, lower = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1.0)) or tiny)
    value = lower
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            lower = 1.0 / ((1.0 + term * lower) or tiny)
            upper = (1.0 + term / upper) or tiny
            value *= upper * lower
        if abs(upper * lower - 1.0) < 1e-15:
            break
    return front * value


@F.pandas_udf(DoubleType())
def correlation_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a Pearson correlation (t test with n - 2 degrees of freedom)."""
    def one(r, n):
        if r is None or math.isnan(r) or n < 3:
            return None
        if abs(r) >= 1.0:
            return 0.0
        v = n - 2.0
        return regularised_beta(v / (v + r * r * v / (1.0 - r * r)), v / 2.0, 0.5)

    return pd.Series([one(a, b) for a, b in zip(r, n)], dtype="float64")
