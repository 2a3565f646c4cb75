"""Upper tail of the chi-square distribution, for the one-row result of a test."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chi_square_p_value(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic): the regularised upper incomplete gamma function at (dof/2, x/2).

    The functions are nested so that they travel to the executors by value.
    """

    # First terms of the expansion's coefficients near the mean.
    near_0 = (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600)
    near_1 = (-1 / 540, -1 / 288, 1 / 378)

    def series(a: float, x: float, scale: float) -> float:
        term = total = 1.0 / a
        i = 0
        while term > total * 1e-16:
            i += 1
            term *= x / (a + i)
            total += term
        return max(0.0, 1.0 - total * scale)

    def continued_fraction(a: float, x: float, scale: float) -> float:
        # Modified Lentz method.
        tiny = 1e-300
        b = x + 1 - a
        c, d = 1 / tiny, 1 / b
        fraction = d
        for i in range(1, 100_000):
            step = -i * (i - a)
            b += 2
            d = 1 / (step * d + b or tiny)
            c = b + step / c or tiny
            fraction *= d * c
            if abs(d * c - 1) <= 1e-15:
                return fraction * scale
        raise ArithmeticError(f"no p-value: the fraction does not converge at {a}, {x}")

    def expansion(a: float, x: float) -> float:
        """Uniform in x: an error function of the distance from the mean, and two corrections."""
        mu = (x - a) / a
        if abs(mu) < 0.01:  # mu - log(1 + mu) without cancellation
            half_square = sum((-mu) ** k / k for k in range(2, 12))
        else:
            half_square = mu - math.log1p(mu)
        eta = math.copysign(math.sqrt(2 * half_square), mu)
        if abs(eta) < 0.05:
            c_0 = sum(c * eta**k for k, c in enumerate(near_0))
            c_1 = sum(c * eta**k for k, c in enumerate(near_1))
        else:
            c_0 = 1 / mu - 1 / eta
            c_1 = 1 / eta**3 - 1 / mu**3 - 1 / mu**2 - 1 / (12 * mu)
        correction = math.exp(-a * half_square) / math.sqrt(2 * math.pi * a) * (c_0 + c_1 / a)
        return min(1.0, max(0.0, 0.5 * math.erfc(eta * math.sqrt(a / 2)) + correction))

    def upper_tail(x: float, k: float) -> float:
        if math.isnan(x) or math.isnan(k):
            return math.nan
        if k <= 0 or x <= 0:
            return 1.0
        a, x = k / 2.0, x / 2.0
        if math.isinf(x):
            return 0.0
        if a > 500:
            return expansion(a, x)
        scale = math.exp(a * math.log(x) - x - math.lgamma(a))
        return series(a, x, scale) if x < a + 1 else continued_fraction(a, x, scale)

    @F.pandas_udf(T.DoubleType())
    def p_value(statistics: pd.Series, dofs: pd.Series) -> pd.Series:
        return pd.Series([upper_tail(x, k) for x, k in zip(statistics, dofs)], dtype="float64")

    return p_value(statistic, dof.cast("double"))
