"""Agreement measures and intervals.  Operators: A1 A2 A3 A4 A6."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.959964


def confusion(human: Column, ai: Column) -> list[Column]:
    """A1: a decision that is neither 0 nor 1 falls in no cell."""
    cell = lambda h, a, name: F.count_if((human == h) & (ai == a)).alias(name)
    return [cell(1, 1, "tp"), cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn")]


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def agreement() -> list[Column]:
    """A2: from columns tp, tn, fp, fn; null where a denominator is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    po = ratio(tp + tn, n)
    out = {"observed_agreement": po, "pabak": 2 * po - 1, "sensitivity": ratio(tp, tp + fn), "specificity": ratio(tn, tn + fp), "ppv": ratio(tp, tp + fp), "npv": ratio(tn, tn + fn)}
    return [F.round(v, 6).alias(k) for k, v in out.items()]


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """A4."""
    p, z2 = k / n, Z95 * Z95
    mid, half = (p + z2 / (2 * n)) / (1 + z2 / n), Z95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), mid - half)), F.when(n > 0, F.least(F.lit(1.0), mid + half))


def _beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_tail(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * total


def exact_interval(k: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """A3: Clopper-Pearson, by bisection."""

    def quantile(p: float, a: float, b: float) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if _beta_tail(mid, a, b) < p else (lo, mid)
        return (lo + hi) / 2

    if n <= 0:
        return math.nan, math.nan
    return (0.0 if k == 0 else quantile(alpha / 2, k, n - k + 1)), (1.0 if k == n else quantile(1 - alpha / 2, k + 1, n - k))


def percentile_by_place(values: Column, share: float) -> Column:
    """Of n sorted values the one at place max(0, int(share * n) - 1)."""
    v = F.array_sort(values)
    return F.get(v, F.greatest(F.lit(0), F.floor(F.size(v) * F.lit(share)).cast("int") - 1))
