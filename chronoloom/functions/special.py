"""Distribution functions as JVM expressions (no Python at run time)."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, functions as F


def _terms(a: float) -> int:
    """Terms after which the series (left of a + 1) and the fraction (right of it) stand still in doubles."""
    return 100 + 20 * math.ceil(math.sqrt(a))


def _gamma_p(a: float, x: Column) -> Column:
    """Regularised lower incomplete gamma P(a, x) by its power series; for x up to about a + 1."""
    scale = F.exp(F.lit(a) * F.log(x) - x - F.lit(math.lgamma(a + 1.0)))
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(_terms(a))),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, n: F.struct(
            (s["term"] * x / (F.lit(a) + n)).alias("term"),
            (s["total"] + s["term"] * x / (F.lit(a) + n)).alias("total")),
    )["total"]
    return F.when(x <= 0, F.lit(0.0)).otherwise(F.least(scale * total, F.lit(1.0)))


def _gamma_q(a: float, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x) by its continued fraction; for x above a + 1.

    The fraction 1 / (x + 1 - a - 1 (1 - a) / (x + 3 - a - ...)) is evaluated from its far end.
    """
    n = _terms(a)
    tail = F.aggregate(F.sequence(F.lit(n), F.lit(1), F.lit(-1)), F.lit(0.0),
                       lambda s, i: i * (F.lit(a) - i) / (x + 2 * i + 1 - a + s))
    return F.exp(F.lit(a) * F.log(x) - x - F.lit(math.lgamma(a))) / (x + 1.0 - a + tail)


def chi2_tail(x: Column, dof: int) -> Column:
    """P(X > x) for a chi-square variable, accurate in both tails."""
    a, half = dof / 2.0, x / 2.0
    return F.when(half <= a + 1.0, F.greatest(F.lit(1.0) - _gamma_p(a, half), F.lit(0.0))).otherwise(_gamma_q(a, half))


def normal_cdf(z: Column) -> Column:
    half = z * z / 2.0
    p = F.when(half <= 1.5, _gamma_p(0.5, half)).otherwise(1.0 - _gamma_q(0.5, half))
    body = F.when(z >= 0, 0.5 * (1 + p)).otherwise(0.5 * (1 - p))
    return body


def normal_pdf(z: Column) -> Column:
    return F.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)


def z_value(p: float) -> float:
    return NormalDist().inv_cdf(p)


def level_z(level: float) -> float:
    """Half-width multiplier of a central interval at ``level`` percent."""
    return z_value(0.5 + level / 200.0)
