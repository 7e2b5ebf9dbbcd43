"""Statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SERIES, FRACTION = 40, 60  # terms: both sides of x = 2 are then good to 12 places


def erfc(x: Column) -> Column:
    """Complementary error function: the positive-term series of erf up to 2, a continued fraction beyond."""
    a = F.abs(x)
    series = F.lit(1.0)
    for n in range(SERIES, 0, -1):
        series = 1.0 + series * (a * a * (2.0 / (2 * n + 1)))
    fraction = a
    for k in range(FRACTION, 0, -1):
        fraction = a + F.lit(k / 2.0) / fraction
    decay = F.exp(-a * a)
    near = 1.0 - a * decay * series * (2.0 / math.sqrt(math.pi))
    upper = F.when(a < 2.0, near).when(a.isNotNull(), decay / fraction / math.sqrt(math.pi))
    return F.when(x < 0, 2.0 - upper).otherwise(upper)


def chi2_sf_1df(x: Column) -> Column:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return erfc(F.sqrt(x / 2.0))


def normal_sf(z: Column) -> Column:
    return erfc(z / math.sqrt(2.0)) / 2.0


def binom_half_p(k: Column, n: Column) -> Column:
    """Exact two-sided binomial p at p=0.5: twice the smaller tail, at most 1.

    Terms are carried as logarithms, so large depths neither overflow nor vanish.
    """
    m = F.least(k, n - k)
    base = -n * F.lit(math.log(2.0))
    start = F.struct(base.alias("lt"), F.exp(base).alias("s"))

    def step(acc, i):
        lt = acc["lt"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double"))
        return F.struct(lt.alias("lt"), (acc["s"] + F.exp(lt)).alias("s"))

    steps = F.when(m >= 1, F.sequence(F.lit(1), m.cast("int"))).otherwise(F.array().cast("array<int>"))
    tail = F.aggregate(steps, start, step, lambda acc: acc["s"])
    return F.when(2 * k == n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * tail))


def bucket_index(value: Column, edges) -> Column:
    """Number of ``edges`` at or below ``value`` (0 = below the first)."""
    out = F.lit(0)
    for e in edges:
        out = out + F.when(value >= F.lit(e), 1).otherwise(0)
    return out
