"""Labels, statuses, pairs and the shape of one prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

PAIRS = "array<struct<drug:string,symptom:string>>"


def label_to_bool(label: Column) -> Column:
    """True for 1; any other value, and null, is false."""
    return F.coalesce(label == 1, F.lit(False))


def label_to_status(label: Column) -> Column:
    """1 is a mild event, everything else no event."""
    return F.when(label == 1, F.lit(fixed.MILD_EVENT)).otherwise(F.lit(fixed.NO_EVENT))


def parse_status(status: Column) -> Column:
    """Canonical status for any accepted spelling; unknown and null mean no event."""
    spelled = F.lower(status)
    found = F.lit(None).cast("string")
    for name, spellings in fixed.STATUS_SPELLINGS.items():
        found = F.when(spelled.isin(*spellings), F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit(fixed.NO_EVENT))


def parse_pairs(pairs_json: Column) -> Column:
    """JSON list of objects to typed pairs: missing fields become '', non-objects are dropped."""
    items = F.from_json(pairs_json, "array<string>")
    objects = F.filter(items, lambda s: F.coalesce(F.ltrim(s).startswith("{"), F.lit(False)))
    typed = F.transform(
        objects,
        lambda s: F.struct(
            F.coalesce(F.get_json_object(s, "$.drug"), F.lit("")).alias("drug"),
            F.coalesce(F.get_json_object(s, "$.symptom"), F.lit("")).alias("symptom"),
        ),
    )
    return F.coalesce(typed, F.array().cast(PAIRS))


def format_prediction(
    status: Column, confidence: Column, pairs: Column, default_confidence: float = 0.8
) -> Column:
    """A complete prediction struct: defaults filled in, confidence clamped to [0, 1]."""
    filled = F.coalesce(confidence.cast("double"), F.lit(default_confidence))
    return F.struct(
        parse_status(status).alias("ade_status"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), filled)).alias("confidence"),
        F.coalesce(pairs, F.array().cast(PAIRS)).alias("drug_symptom_pairs"),
    )


def outcome_label(y_true: Column, y_pred: Column) -> Column:
    """TP / FP / TN / FN of one row; a missing side counts as negative."""
    truth = F.coalesce(y_true, F.lit(False))
    guess = F.coalesce(y_pred, F.lit(False))
    return (
        F.when(truth & guess, "TP").when(guess, "FP").when(truth, "FN").otherwise("TN")
    )
