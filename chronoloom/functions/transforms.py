"""Response transformations: forward, inverse and the inverse's curvature."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Transform:
    """``forward`` maps y to the model scale, ``inverse`` back.

    ``curvature`` is the second derivative of ``inverse``; it gives the
    bias-adjusted mean f(mu) + f''(mu) sigma^2 / 2.
    """

    name: str
    forward: Callable[[Column], Column]
    inverse: Callable[[Column], Column]
    curvature: Callable[[Column], Column]

    def mean(self, mu: Column, sigma2: Column) -> Column:
        return self.inverse(mu) + self.curvature(mu) * sigma2 / 2.0

    def median(self, mu: Column) -> Column:
        return self.inverse(mu)


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def box_cox(y: Column, lam) -> Column:
    lam = _col(lam)
    return F.when(lam == 0, F.log(y)).otherwise((F.pow(y, lam) - 1.0) / lam)


def inv_box_cox(w: Column, lam) -> Column:
    lam = _col(lam)
    return F.when(lam == 0, F.exp(w)).otherwise(F.pow(lam * w + 1.0, 1.0 / lam))


def box_cox_transform(lam: float) -> Transform:
    return Transform(
        f"box_cox({lam})",
        lambda y: box_cox(y, lam),
        lambda w: inv_box_cox(w, lam),
        (lambda w: F.exp(w)) if lam == 0 else
        (lambda w: (1.0 - lam) * F.pow(lam * w + 1.0, F.lit(1.0 / lam - 2.0))),
    )


identity = Transform("identity", lambda y: y, lambda w: w, lambda w: F.lit(0.0))
log = Transform("log", lambda y: F.log(y), lambda w: F.exp(w), lambda w: F.exp(w))
sqrt = Transform("sqrt", lambda y: F.sqrt(y), lambda w: w * w, lambda w: F.lit(2.0))


def scaled_logit(lower: float, upper: float) -> Transform:
    """log((y - a) / (b - y)); keeps forecasts inside (a, b)."""
    width = upper - lower

    def share(w: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-w))

    return Transform(
        f"scaled_logit({lower},{upper})",
        lambda y: F.log((y - lower) / (upper - y)),
        lambda w: lower + width * share(w),
        lambda w: width * share(w) * (1.0 - share(w)) * (1.0 - 2.0 * share(w)),
    )
