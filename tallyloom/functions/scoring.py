"""Per-row metrics: ``(y_true, y_pred, confidence) -> struct<score, details>``.

A metric is a plain Python function over columns, so any function with this signature plugs in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Metric = Callable[[Column, Column, Column], Column]


def _flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def metric_safety(y_true: Column, y_pred: Column, confidence: Column) -> Column:
    """A missed event scores 0, a false alarm 0.3, a right answer 1."""
    truth, guess = _flag(y_true), _flag(y_pred)
    kind = (
        F.when(truth & ~guess, "false_negative")
        .when(~truth & guess, "false_positive")
        .when(truth, "true_positive")
        .otherwise("true_negative")
    )
    risk = F.when(truth & ~guess, "high").when(~truth & guess, "low").otherwise("none")
    score = F.when(truth & ~guess, 0.0).when(~truth & guess, 0.3).otherwise(1.0)
    details = F.struct(
        kind.alias("type"), truth.alias("expected"), guess.alias("predicted"), risk.alias("medical_risk")
    )
    return F.struct(score.alias("score"), details.alias("details"))


def metric_balanced(y_true: Column, y_pred: Column, confidence: Column) -> Column:
    """1 for agreement, else 0."""
    correct = y_true.eqNullSafe(y_pred)
    details = F.struct(y_true.alias("expected"), y_pred.alias("predicted"), correct.alias("correct"))
    return F.struct(correct.cast("double").alias("score"), details.alias("details"))


def metric_confidence_aware(threshold: float = 0.7) -> Metric:
    """Agreement, halved when confidence is below the threshold; missing confidence counts as 1."""

    def metric(y_true: Column, y_pred: Column, confidence: Column) -> Column:
        correct = y_true.eqNullSafe(y_pred)
        sure = F.coalesce(confidence, F.lit(1.0))
        penalty = F.when(sure < threshold, 0.5).otherwise(1.0)
        details = F.struct(
            y_true.alias("expected"),
            y_pred.alias("predicted"),
            sure.alias("confidence"),
            correct.alias("correct"),
            penalty.alias("confidence_penalty"),
        )
        return F.struct((correct.cast("double") * penalty).alias("score"), details.alias("details"))

    return metric


def metric_comprehensive(y_true: Column, y_pred: Column, confidence: Column) -> Column:
    """Agreement with details; missing confidence counts as 0.5."""
    correct = y_true.eqNullSafe(y_pred)
    details = F.struct(
        y_true.alias("expected"),
        y_pred.alias("predicted"),
        F.coalesce(confidence, F.lit(0.5)).alias("confidence"),
        correct.alias("correct"),
    )
    return F.struct(correct.cast("double").alias("score"), details.alias("details"))


def metric_status_threshold(threshold: float = 0.0) -> Callable[[Column, Column, Column], Column]:
    """True when the status is right and its confidence present and at least the threshold."""

    def metric(expected: Column, predicted: Column, confidence: Column) -> Column:
        present = predicted.isNotNull() & confidence.isNotNull()
        return F.coalesce(present & (confidence >= threshold) & (expected == predicted), F.lit(False))

    return metric
