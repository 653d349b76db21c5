"""Ratios, intervals, rounding and grades over counted outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f1_score(precision: Column, recall: Column) -> Column:
    """Harmonic mean, 0 when either side is 0."""
    mean = F.try_divide(F.lit(2.0) * precision * recall, precision + recall)
    return F.when((precision == 0) | (recall == 0), F.lit(0.0)).otherwise(F.coalesce(mean, F.lit(0.0)))


def wilson(hits: Column, trials: Column, level: float = 0.95) -> Column:
    """Wilson score interval ``struct<lo, hi>`` clamped to [0, 1]; (0, 0) without trials."""
    z = fixed.Z_95 if level == 0.95 else fixed.Z_99
    k, n = hits.cast("double"), trials.cast("double")
    # The interval multiplied out by n + z^2: a short expression plans and compiles quickly.
    spread = F.lit(z) * F.sqrt(F.try_divide(k * (n - k), n) + F.lit(z * z / 4))
    low, high = (k + F.lit(z * z / 2) - spread) / (n + F.lit(z * z)), (k + F.lit(z * z / 2) + spread) / (n + F.lit(z * z))

    def bound(edge: Column) -> Column:
        return F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), edge))).otherwise(F.lit(0.0))

    return F.struct(bound(low).alias("lo"), bound(high).alias("hi"))


def matthews(tp: Column, fp: Column, tn: Column, fn: Column) -> Column:
    """Matthews correlation, computed in doubles so that the four-way product cannot overflow."""
    a, b, c, d = (x.cast("double") for x in (tp, fp, tn, fn))
    below = F.sqrt((a + b) * (a + d) * (c + b) * (c + d))
    return F.coalesce(F.try_divide(a * c - b * d, below), F.lit(0.0))


def round_half_away(value: Column, digits: int) -> Column:
    """Round to ``digits`` places by scaling, halves away from zero."""
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def pct_round(value: Column, digits: int = 1) -> Column:
    """A share as a rounded percentage."""
    return round_half_away(value * F.lit(100.0), digits)


def grade_band(f1: Column, fnr: Column | None = None) -> Column:
    """excellent / good / needs_improvement / poor from F1 and, when given, the miss rate."""
    top = f1 > 0.8
    if fnr is not None:
        top = top & (fnr < 0.15)
    return (
        F.when(top, "excellent").when(f1 > 0.7, "good").when(f1 > 0.6, "needs_improvement").otherwise("poor")
    )


def miss_rate_band(fnr: Column) -> Column:
    """high above 0.2, moderate above 0.1, else low."""
    return F.when(fnr > 0.2, "high").when(fnr > 0.1, "moderate").otherwise("low")


def quality_warnings(precision: Column, recall: Column) -> Column:
    """Warnings for precision or recall below 0.7."""
    return F.array_compact(
        F.array(F.when(recall < 0.7, F.lit("low recall")), F.when(precision < 0.7, F.lit("low precision")))
    )
