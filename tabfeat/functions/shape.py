"""Expressions that reshape or cut one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabfeat.fixed_values import INVERSE_NORMAL


def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson power of ``x``; ``expm1`` keeps precision when an exponent is near zero."""
    upper = F.log1p(x) if lam == 0 else F.expm1(lam * F.log1p(x)) / lam
    mirrored = 2 - lam
    lower = -F.log1p(-x) if mirrored == 0 else -F.expm1(mirrored * F.log1p(-x)) / mirrored
    return F.when(x >= 0, upper).otherwise(lower)


def bin_code(x: Column, edges: Sequence[float]) -> Column:
    """Number of inner edges strictly below ``x``: right-closed bins with open outer ends.

    Written as a balanced decision tree, so a row needs log2(bins) comparisons.
    """
    cuts = sorted(set(edges))

    def descend(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > cuts[mid], descend(mid + 1, hi)).otherwise(descend(lo, mid))

    return F.when(x.isNotNull(), descend(0, len(cuts))).cast("int")


def equal_width_slot(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Histogram slot of ``x`` in ``[lo, hi]``; the last slot includes its right end."""
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    return F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    value = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        value = value * x + c
    return value


def inverse_normal(p: Column) -> Column:
    """Quantile function of the standard normal for ``0 < p < 1`` (relative error below 2e-9)."""
    a, b, c, d, tail = (INVERSE_NORMAL[k] for k in ("a", "b", "c", "d", "tail"))
    low = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(low))
    outer = _polynomial(c, t) / _polynomial((*d, 1.0), t)
    q = p - 0.5
    r = q * q
    centre = _polynomial(a, r) * q / _polynomial((*b, 1.0), r)
    return (F.when(p < tail, outer)
            .when(p > 1 - tail, -outer)
            .otherwise(centre))
