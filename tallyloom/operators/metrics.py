"""Evaluation metrics over scored rows, all runs at once through ``by``.

Scored rows carry ``y_true, y_pred`` and, as needed, ``confidence, pred_items, true_items,
api_calls, latency_s, error``. Every metric is one aggregation with map-side combine.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.pricing import dollars
from ..functions.ratios import (
    f1_score,
    grade_band,
    matthews,
    miss_rate_band,
    pct_round,
    quality_warnings,
    round_half_away,
    safe_ratio,
    wilson,
)
from ..functions.scoring import Metric
from ..functions.text import snippet
from ..session import scratch_path

_CELLS = ("tp", "fp", "tn", "fn")


def _cells(y_true: Column, y_pred: Column, prefix: str = "") -> list[Column]:
    return [
        F.count_if(y_true & y_pred).alias(f"{prefix}tp"),
        F.count_if(~y_true & y_pred).alias(f"{prefix}fp"),
        F.count_if(~y_true & ~y_pred).alias(f"{prefix}tn"),
        F.count_if(y_true & ~y_pred).alias(f"{prefix}fn"),
    ]


def confusion_binary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn; a row with a missing side falls in no cell."""
    return scored.groupBy(*by).agg(*_cells(F.col("y_true"), F.col("y_pred")))


def confusion_of_rules(df: DataFrame, y_true: Column, rules: Mapping[str, Column]) -> DataFrame:
    """The four cells of many rules over the same rows: one pass, and no row is repeated per rule.

    ``rules`` maps a run id to its prediction; the result has one row per run.
    """
    cells = []
    for number, y_pred in enumerate(rules.values()):
        cells += _cells(y_true, y_pred, f"r{number}_")
    counted = df.agg(*cells)
    runs = [
        F.struct(F.lit(run).alias("run_id"), *[F.col(f"r{number}_{c}").alias(c) for c in _CELLS])
        for number, run in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*runs)))


def add_classification(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity and Wilson intervals from the four cells."""
    tp, fp, tn, fn = (F.col(c) for c in _CELLS)
    return (
        counts.withColumn("total", tp + fp + tn + fn)
        .withColumns(
            {
                "accuracy": safe_ratio(tp + tn, F.col("total")),
                "precision": safe_ratio(tp, tp + fp),
                "recall": safe_ratio(tp, tp + fn),
                "specificity": safe_ratio(tn, tn + fp),
                "accuracy_ci": wilson(tp + tn, F.col("total")),
                "precision_ci": wilson(tp, tp + fp),
                "recall_ci": wilson(tp, tp + fn),
                "specificity_ci": wilson(tn, tn + fp),
            }
        )
        .withColumn("f1", f1_score(F.col("precision"), F.col("recall")))
    )


def add_safety(counts: DataFrame) -> DataFrame:
    """Miss rate, predictive values, Matthews correlation, missed events and false alarms."""
    tp, fp, tn, fn = (F.col(c) for c in _CELLS)
    return counts.withColumns(
        {
            "false_negative_rate": safe_ratio(fn, tp + fn),
            "positive_predictive_value": safe_ratio(tp, tp + fp),
            "negative_predictive_value": safe_ratio(tn, tn + fn),
            "matthews_correlation": matthews(tp, fp, tn, fn),
            "missed_ades": fn,
            "false_alarms": fp,
        }
    )


def classification_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return add_classification(confusion_binary(scored, by))


def safety_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return add_safety(confusion_binary(scored, by))


def add_grades(metrics: DataFrame) -> DataFrame:
    """Grade, miss-rate band and warnings for rows with both metric families."""
    return metrics.withColumns(
        {
            "grade": grade_band(F.col("f1"), F.col("false_negative_rate")),
            "miss_rate": miss_rate_band(F.col("false_negative_rate")),
            "warnings": quality_warnings(F.col("precision"), F.col("recall")),
        }
    )


def confusion_multiclass(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The matrix in long form: ``pred, actual, n``."""
    return scored.groupBy(*by, F.col("y_pred").alias("pred"), F.col("y_true").alias("actual")).agg(
        F.count(F.lit(1)).alias("n")
    )


def fold_matrix(matrix: DataFrame, negative: str = fixed.NO_EVENT, by: Sequence[str] = ()) -> DataFrame:
    """The matrix folded to positive / negative, plus exact matches and totals."""
    guess = ~F.col("pred").eqNullSafe(F.lit(negative))
    truth = ~F.col("actual").eqNullSafe(F.lit(negative))

    def cell(keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0))

    return matrix.groupBy(*by).agg(
        cell(truth & guess).alias("tp"),
        cell(~truth & guess).alias("fp"),
        cell(~truth & ~guess).alias("tn"),
        cell(truth & ~guess).alias("fn"),
        cell(F.col("pred").eqNullSafe(F.col("actual"))).alias("correct"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def per_class_metrics(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest precision, recall and F1 of every class seen on either side, from the matrix."""
    hit = F.col("pred").eqNullSafe(F.col("actual"))
    sides = matrix.withColumn(
        "_side",
        F.explode(
            F.array(
                F.struct(F.col("pred").alias("cls"), F.lit("pred").alias("as")),
                F.struct(F.col("actual").alias("cls"), F.lit("actual").alias("as")),
            )
        ),
    )

    def total(keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0))

    as_pred, as_actual = F.col("_side.as") == "pred", F.col("_side.as") == "actual"
    counts = sides.groupBy(*by, F.col("_side.cls").alias("class")).agg(
        total(as_pred & hit).alias("tp"),
        total(as_pred & ~hit).alias("fp"),
        total(as_actual & ~hit).alias("fn"),
    )
    rated = counts.withColumns(
        {
            "precision": safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    )
    return rated.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))


def evaluate_batch(
    scored: DataFrame, negative: str = fixed.NO_EVENT, by: Sequence[str] = ()
) -> DataFrame:
    """Folded precision, recall and F1 with exact-match accuracy; zeros for empty input."""
    folded = fold_matrix(confusion_multiclass(scored, by), negative, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rated = folded.withColumns(
        {
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "accuracy": safe_ratio(F.col("correct"), F.col("total")),
        }
    )
    return rated.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))


def _item_set(items: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.transform(F.coalesce(items, empty), F.lower))


def _extraction_rows(pred: Column, truth: Column) -> dict[str, Column]:
    guessed, wanted = _item_set(pred), _item_set(truth)
    hits = F.size(F.array_intersect(guessed, wanted)).cast("long")
    return {"hits": hits, "n_pred": F.size(guessed).cast("long"), "n_true": F.size(wanted).cast("long")}


def _extraction_aggregates(hits: Column, n_pred: Column, n_true: Column, prefix: str = "") -> list[Column]:
    valid = n_true > 0
    precision, recall = safe_ratio(hits, n_pred), safe_ratio(hits, n_true)

    def over_valid(value: Column) -> Column:
        return F.coalesce(F.avg(F.when(valid, value)), F.lit(0.0))

    def summed(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(valid, value)), F.lit(0))

    return [
        over_valid(precision).alias(f"{prefix}precision"),
        over_valid(recall).alias(f"{prefix}recall"),
        over_valid(f1_score(precision, recall)).alias(f"{prefix}f1"),
        summed(hits).alias(f"{prefix}item_tp"),
        summed(n_pred - hits).alias(f"{prefix}item_fp"),
        summed(n_true - hits).alias(f"{prefix}item_fn"),
        F.count_if(valid).alias(f"{prefix}valid_examples"),
        F.count(F.lit(1)).alias(f"{prefix}total_examples"),
    ]


def _add_micro(df: DataFrame, prefix: str = "") -> DataFrame:
    tp, fp, fn = (F.col(f"{prefix}item_{c}") for c in ("tp", "fp", "fn"))
    rated = df.withColumns(
        {
            f"{prefix}micro_precision": safe_ratio(tp, tp + fp),
            f"{prefix}micro_recall": safe_ratio(tp, tp + fn),
        }
    )
    return rated.withColumn(
        f"{prefix}micro_f1",
        f1_score(F.col(f"{prefix}micro_precision"), F.col(f"{prefix}micro_recall")),
    )


def extraction_metrics(
    scored: DataFrame,
    pred: str = "pred_items",
    truth: str = "true_items",
    by: Sequence[str] = (),
) -> DataFrame:
    """Macro and micro scores of item lists, compared as lower-cased sets.

    Rows without true items are counted in the total only.
    """
    rows = scored.select(*by, *[c.alias(n) for n, c in _extraction_rows(F.col(pred), F.col(truth)).items()])
    scores = rows.groupBy(*by).agg(
        *_extraction_aggregates(F.col("hits"), F.col("n_pred"), F.col("n_true"))
    )
    return _add_micro(scores)


def extraction_metrics_long(
    pred: DataFrame, truth: DataFrame, key: str = "example_id", item: str = "item", by: Sequence[str] = ()
) -> DataFrame:
    """The same scores from one row per item, for examples whose lists do not fit one row.

    Examples that occur on neither side are unknown here, so totals count the seen examples.
    """
    tagged = pred.select(*by, key, F.lower(item).alias("item"), F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        truth.select(*by, key, F.lower(item).alias("item"), F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    items = tagged.groupBy(*by, key, "item").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    rows = items.groupBy(*by, key).agg(
        F.count_if((F.col("p") == 1) & (F.col("t") == 1)).alias("hits"),
        F.count_if(F.col("p") == 1).alias("n_pred"),
        F.count_if(F.col("t") == 1).alias("n_true"),
    )
    scores = rows.groupBy(*by).agg(
        *_extraction_aggregates(F.col("hits"), F.col("n_pred"), F.col("n_true"))
    )
    return _add_micro(scores)


def extraction_errors(scored: DataFrame, pred: str = "pred_items", truth: str = "true_items") -> DataFrame:
    """Rows with unexpected or missing items, as two more array columns."""
    guessed, wanted = _item_set(F.col(pred)), _item_set(F.col(truth))
    rows = scored.withColumns(
        {
            "false_positives": F.array_except(guessed, wanted),
            "false_negatives": F.array_except(wanted, guessed),
        }
    )
    return rows.filter((F.size("false_positives") > 0) | (F.size("false_negatives") > 0))


def error_item_bag(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of every wrong item over all rows: ``kind, item, n``."""
    tagged = F.concat(
        F.transform("false_positives", lambda i: F.struct(F.lit("false_positive").alias("kind"), i.alias("item"))),
        F.transform("false_negatives", lambda i: F.struct(F.lit("false_negative").alias("kind"), i.alias("item"))),
    )
    return (
        errors.select(*by, F.explode(tagged).alias("_e"))
        .groupBy(*by, "_e.kind", "_e.item")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _scorecard(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Metric families from one row per example with counts of hits, predicted and true items."""
    counted = rows.groupBy(*by).agg(
        *_extraction_aggregates(F.col("d_hits"), F.col("d_n_pred"), F.col("d_n_true"), "drug_"),
        *_extraction_aggregates(F.col("e_hits"), F.col("e_n_pred"), F.col("e_n_true"), "effect_"),
        *_cells(F.col("y_true"), F.col("y_pred")),
        F.count(F.lit(1)).alias("examples_evaluated"),
    )
    return add_safety(add_classification(_add_micro(_add_micro(counted, "drug_"), "effect_")))


def pipeline_scorecard(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Drug and effect extraction, classification and safety of every run from one pass.

    Reads ``pred_drugs, true_drugs, pred_effects, true_effects, y_true, y_pred``.
    """
    drugs = _extraction_rows(F.col("pred_drugs"), F.col("true_drugs"))
    effects = _extraction_rows(F.col("pred_effects"), F.col("true_effects"))
    rows = scored.select(
        *by,
        "y_true",
        "y_pred",
        *[c.alias(f"d_{n}") for n, c in drugs.items()],
        *[c.alias(f"e_{n}") for n, c in effects.items()],
    )
    return _scorecard(rows, by)


def pipeline_scorecard_parts(scored: DataFrame, key: str, by: Sequence[str] = (), part: str = "part") -> DataFrame:
    """The same scorecard when the lists of an example are cut into parts.

    Items are compared in long form over all parts of an example; ``y_true`` and ``y_pred`` are those of
    part 0. Nothing is gathered per example but counts.
    """

    def items(name: str, kind: str, pred: int) -> Column:
        values = F.coalesce(F.col(name), F.array().cast("array<string>"))
        return F.transform(
            values,
            lambda v: F.struct(F.lit(kind).alias("kind"), F.lower(v).alias("item"), F.lit(pred).alias("p"), F.lit(1 - pred).alias("t")),
        )

    example = F.array(F.struct(F.lit("example").alias("kind"), F.lit(None).cast("string").alias("item"), F.lit(0).alias("p"), F.lit(0).alias("t")))
    every = F.concat(
        example, items("pred_drugs", "d", 1), items("true_drugs", "d", 0), items("pred_effects", "e", 1), items("true_effects", "e", 0)
    )
    answer = F.when(F.col(part) == 0, F.struct("y_true", "y_pred"))
    long = scored.select(*by, key, answer.alias("_a"), F.explode(every).alias("_i")).select(
        *by, key, "_i.*", F.when(F.col("_i.kind") == "example", F.col("_a")).alias("_a")
    )
    distinct = long.groupBy(*by, key, "kind", "item").agg(F.max("p").alias("p"), F.max("t").alias("t"), F.max("_a").alias("_a"))
    found, guessed, wanted = (F.col("p") == 1) & (F.col("t") == 1), F.col("p") == 1, F.col("t") == 1
    rows = distinct.groupBy(*by, key).agg(
        *[
            F.count_if((F.col("kind") == kind) & which).alias(f"{kind}_{name}")
            for kind in ("d", "e")
            for name, which in (("hits", found), ("n_pred", guessed), ("n_true", wanted))
        ],
        F.max("_a").alias("_a"),
    )
    return _scorecard(rows.select("*", "_a.*"), by)


def _effort() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("examples_evaluated"),
        F.coalesce(F.sum(F.coalesce(F.col("api_calls"), F.lit(1)).cast("long")), F.lit(0)).alias("total_api_calls"),
        F.count_if(F.col("error").isNotNull()).alias("processing_errors"),
        F.coalesce(F.avg("latency_s"), F.lit(0.0)).alias("_seconds"),
    ]


def _add_performance(counted: DataFrame) -> DataFrame:
    calls = F.col("total_api_calls")
    price = F.lit(fixed.FLAT_COST_PER_CALL).cast("decimal(12,10)")
    return counted.withColumns(
        {
            "api_calls_per_prediction": safe_ratio(calls, F.col("examples_evaluated")),
            "avg_processing_time": round_half_away(F.col("_seconds"), 3),
            "estimated_cost_usd": dollars(calls.cast("decimal(20,0)") * price),
        }
    ).drop("_seconds")


def pipeline_performance(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Calls, errors, mean time (3 places) and flat cost estimate (6 places)."""
    return _add_performance(scored.groupBy(*by).agg(*_effort()))


def run_table(scored: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Classification, safety and performance of every run from one aggregation."""
    counted = scored.groupBy(*by).agg(*_cells(F.col("y_true"), F.col("y_pred")), *_effort())
    return _add_performance(add_safety(add_classification(counted)))


def evaluator_summary(
    scored: DataFrame, by: Sequence[str] = (), low: float = 0.6, passed: str | None = None
) -> DataFrame:
    """Confusion, rates, confidence figures and pass rate; a missing answer counts as negative."""
    truth = F.coalesce(F.col("y_true"), F.lit(False))
    guess = F.coalesce(F.col("y_pred"), F.lit(False))
    sure = F.coalesce(F.col("confidence"), F.lit(0.5))
    ok = F.col(passed) if passed else truth == guess
    counted = scored.groupBy(*by).agg(
        *_cells(truth, guess),
        F.coalesce(F.avg(sure), F.lit(0.0)).alias("average_confidence"),
        F.count_if(sure < low).alias("low_confidence_predictions"),
        F.coalesce(F.avg(ok.cast("double")), F.lit(0.0)).alias("pass_rate"),
    )
    keep = [c for c in counted.columns]
    rated = add_safety(add_classification(counted))
    return rated.select(
        *keep, "accuracy", "precision", "recall", "f1", "false_negative_rate", "missed_ades", "false_alarms"
    )


def pass_rate(scored: DataFrame, metric: Metric, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and share of full scores under a per-row metric."""
    result = metric(F.col("y_true"), F.col("y_pred"), F.col("confidence"))
    rows = scored.select(*by, result["score"].alias("score"))
    return rows.groupBy(*by).agg(
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean_score"),
        F.coalesce(F.avg((F.col("score") == 1.0).cast("double")), F.lit(0.0)).alias("pass_rate"),
    )


def recall_on_positives(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives tested, misses and recall in percent (0 without positives)."""
    counted = (
        scored.filter(F.col("y_true"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("positives"),
            F.count_if(~F.coalesce(F.col("y_pred"), F.lit(False))).alias("missed"),
        )
    )
    found = F.col("positives") - F.col("missed")
    return counted.withColumn("recall_pct", pct_round(safe_ratio(found, F.col("positives"))))


def error_budget(scored: DataFrame, max_errors: int, by: Sequence[str] = ()) -> DataFrame:
    """Failed rows per run and whether the budget is used up."""
    counted = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("error").isNotNull()).alias("errors")
    )
    return counted.withColumn("stopped", F.col("errors") >= max_errors)


class BudgetExceeded(RuntimeError):
    """Scoring was stopped because too many rows failed."""


def require_budget(scored: DataFrame, max_errors: int) -> DataFrame:
    """The rows themselves, written once to the shared folder; scoring stops when ``max_errors`` rows carry an error.

    Tasks count their errors in an accumulator while rows are written; when the tasks that have ended reach the
    budget, the job's other tasks are cancelled, nothing is kept and ``BudgetExceeded`` is raised. So a run that goes
    wrong pays for the tasks that run at that time, not for all rows.
    """
    spark = scored.sparkSession
    context = spark.sparkContext
    errors, group, ended = context.accumulator(0), f"budget-{uuid.uuid4().hex}", threading.Event()

    def counted(batches):
        for batch in batches:
            failed = batch.column(batch.schema.get_field_index("error"))
            errors.add(len(failed) - failed.null_count)
            yield batch

    def watch() -> None:
        while not ended.wait(0.1):
            if errors.value >= max_errors:
                context.cancelJobGroup(group)
                return

    path = scratch_path(spark, "scored")
    watcher = InheritableThread(target=watch, daemon=True)
    watcher.start()
    context.setJobGroup(group, "scoring under an error budget", interruptOnCancel=True)
    try:
        scored.mapInArrow(counted, scored.schema).write.parquet(path)
    except Exception:
        if errors.value < max_errors:
            raise
    finally:
        ended.set()
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)
    if errors.value >= max_errors:
        raise BudgetExceeded(f"error budget exceeded: {errors.value} of {max_errors} rows failed")
    return spark.read.schema(scored.schema).parquet(path)


def error_cases(
    scored: DataFrame, kind: str = "FN", text: str = "text", last_index: int = 200, key: str = "example_id"
) -> DataFrame:
    """Misses (``FN``) or false alarms (``FP``) with their text cut."""
    truth = F.coalesce(F.col("y_true"), F.lit(False))
    guess = F.coalesce(F.col("y_pred"), F.lit(False))
    wrong = (truth & ~guess) if kind == "FN" else (~truth & guess)
    shown = [c for c in ("run_id", key, "y_true", "y_pred") if c in scored.columns]
    extra = [c for c in ("reasoning",) if c in scored.columns]
    return scored.filter(wrong).select(
        *shown,
        F.coalesce(F.col("confidence"), F.lit(0.5)).alias("confidence"),
        snippet(F.col(text), last_index).alias("text"),
        *extra,
    )


def confidence_filter(scored: DataFrame, threshold: float = 0.6, text: str = "text", last_index: int = 200) -> DataFrame:
    """Rows below the confidence threshold with their text cut."""
    return scored.filter(F.col("confidence") < threshold).withColumn(text, snippet(F.col(text), last_index))


def top_errors(cases: DataFrame, n: int, *order) -> DataFrame:
    """The first n error rows in the given order."""
    return cases.orderBy(*order).limit(n)
