"""Rates, intervals, calibration and percentile conventions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the normal quantile of 95 % intervals.
Z95 = 1.959963984540054


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """Bounds of the Wilson interval; null for n = 0."""
    p, z2 = k / n, Z95 * Z95
    mid, half = (p + z2 / (2 * n)) / (1 + z2 / n), Z95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return F.when(n > 0, mid - half), F.when(n > 0, mid + half)


def platt(score: Column, a: float, b: float) -> Column:
    """sigmoid(a logit(s) + b), with the score kept off 0 and 1."""
    s = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), score))
    return 1 / (1 + F.exp(-(a * F.ln(s / (1 - s)) + b)))


def nearest_rank(values: Column, q: float, rule: str) -> Column:
    """A percentile of an array by rank. Rules, which differ by one place and must not be mixed:

    index: sorted[min(n - 1, floor(q n))]; ceil: sorted[ceil(q n) - 1]; before: sorted[floor(q n) - 1]; upper: sorted[floor(n / 2)].
    """
    s, n = F.array_sort(values), F.size(values)
    at = {"index": F.least(n - 1, F.floor(q * n).cast("int")), "ceil": F.ceil(q * n).cast("int") - 1, "before": F.greatest(F.lit(0), F.floor(q * n).cast("int") - 1), "upper": F.floor(n / 2).cast("int")}[rule]
    return F.get(s, at)
