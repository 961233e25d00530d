"""Statistical helpers as Column expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_DOF = 100  # up to here quantiles are solved for; beyond, the expansion is exact to ten digits


def normal_quantile(p: float) -> float:
    """Standard normal quantile of a *parameter* (confidence level), not data."""
    return NormalDist().inv_cdf(p)


def t_cdf(t: float, dof: int) -> float:
    """Student-t distribution function for a whole number of degrees of freedom: the finite
    trigonometric series in theta = atan(t / sqrt(dof))."""
    theta = math.atan(t / math.sqrt(dof))
    c, s = math.cos(theta), math.sin(theta)
    if dof % 2:
        term, total = c, c if dof > 1 else 0.0
        for k in range(3, dof - 1, 2):
            term *= c * c * (k - 1) / k
            total += term
        return 0.5 + (theta + s * total) / math.pi
    term, total = 1.0, 1.0
    for k in range(2, dof, 2):
        term *= c * c * (k - 1) / k
        total += term
    return 0.5 + s * total / 2.0


def t_quantile_exact(p: float, dof: int) -> float:
    """Quantile by bisection of the distribution function."""
    lo, hi = -1.0, 1.0
    while t_cdf(lo, dof) > p:
        lo *= 2
    while t_cdf(hi, dof) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_cdf(mid, dof) < p else (lo, mid)
    return (lo + hi) / 2


def t_quantile(p: float, dof: Column) -> Column:
    """Student-t quantile for any number of degrees of freedom from 1 up (null below): solved for up
    to ``EXACT_DOF``, above by the Cornish-Fisher expansion around the normal
    quantile (Abramowitz & Stegun 26.7.5, four correction terms)."""
    z = normal_quantile(p)
    g1 = (z ** 3 + z) / 4.0
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96.0
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384.0
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160.0
    nu = dof.cast("double")
    t = F.lit(z) + F.lit(g1) / nu + F.lit(g2) / nu ** 2 + F.lit(g3) / nu ** 3 + F.lit(g4) / nu ** 4
    small = F.array(*[F.lit(t_quantile_exact(p, d)) for d in range(1, EXACT_DOF + 1)])
    return F.when(dof > EXACT_DOF, t).when(dof >= 1, F.get(small, (dof - 1).cast("int")))
