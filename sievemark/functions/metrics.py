"""Metric formulas as Column expressions, with the zero rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 97.5 % normal quantile, the support under which a slice is flagged, clamps.
WILSON_Z = 1.959963984540054
LOW_SUPPORT, CLAMP = 30, 1e-6


def ratio(n: Column, d: Column, empty: float = 0.0) -> Column:
    """n / d, ``empty`` where d is 0."""
    return F.when(d == 0, F.lit(empty)).otherwise(n.cast("double") / d)


def fbeta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    b2 = beta * beta
    den = b2 * precision + recall
    return F.when(den == 0, F.lit(0.0)).otherwise((1.0 + b2) * precision * recall / den)


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """Low and high end of the 95 % interval, null at n = 0."""
    z2, p = WILSON_Z * WILSON_Z, k.cast("double") / n
    den = 1.0 + z2 / n
    centre = (p + z2 / (2.0 * n)) / den
    half = WILSON_Z * F.sqrt(p * (1.0 - p) / n + z2 / (4.0 * n * n)) / den
    return F.when(n > 0, F.greatest(F.lit(0.0), centre - half)), F.when(n > 0, F.least(F.lit(1.0), centre + half))


def logit(p: Column) -> Column:
    c = F.least(F.greatest(p, F.lit(CLAMP)), F.lit(1.0 - CLAMP))
    return F.ln(c / (1.0 - c))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1.0 / (1.0 + F.exp(-x))).otherwise(F.exp(x) / (1.0 + F.exp(x)))


def posterior(raw: Column, prior: Column) -> Column:
    """sigmoid(logit(raw) + logit(prior))."""
    return sigmoid(logit(raw) + logit(prior))
