"""Evaluation metrics, per-row scores and run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import ratios, scoring
from tallyloom.functions.status import outcome_label
from tallyloom.operators import compare, metrics, profile
from tallyloom.operators.joins import align_predictions
from tallyloom.plans import flows

from .base import (
    LINES_SQL,
    RUNS_SQL,
    SCORED_SQL,
    pct_sql,
    query,
    ratio,
    scored_documents,
    scored_lines,
    table,
    tidy,
    wilson_sql,
)

RUN = ["run_id"]
RATE_COLUMNS = ("accuracy", "precision", "recall", "specificity", "f1")
RATE_LIST = ", ".join(f'round("{c}", 6) AS "{c}"' for c in RATE_COLUMNS)


# --- binary ----------------------------------------------------------------------------------

@query("confusion_binary", f"WITH {SCORED_SQL}, {RUNS_SQL} SELECT run_id, tp, fp, tn, fn FROM runs")
def confusion_binary(spark, sf):
    return tidy(metrics.confusion_binary(scored_documents(spark, sf), RUN))


CI_SQL = ", ".join(
    f"{wilson_sql(hits, trials, side)} AS {name}_{side}"
    for name, hits, trials in (
        ("accuracy", "tp + tn", "tp + fp + tn + fn"),
        ("precision", "tp", "tp + fp"),
        ("recall", "tp", "tp + fn"),
        ("specificity", "tn", "tn + fp"),
    )
    for side in ("lo", "hi")
)


def _metric_columns(df):
    bounds = [
        F.col(f"{n}_ci.{side}").alias(f"{n}_{side}")
        for n in ("accuracy", "precision", "recall", "specificity")
        for side in ("lo", "hi")
    ]
    return tidy(df.select("run_id", "tp", "fp", "tn", "fn", "total", *RATE_COLUMNS, *bounds))


@query(
    "classification_metrics",
    f"WITH {SCORED_SQL}, {RUNS_SQL} SELECT run_id, tp, fp, tn, fn, tp + fp + tn + fn AS total, {RATE_LIST}, {CI_SQL} FROM runs",
)
def classification_metrics(spark, sf):
    return _metric_columns(metrics.classification_metrics(scored_documents(spark, sf), RUN))


@query(
    "classification_metrics_lines",
    f"WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id, tp, fp, tn, fn, tp + fp + tn + fn AS total, {RATE_LIST}, {CI_SQL} FROM runs",
)
def classification_metrics_lines(spark, sf):
    return _metric_columns(metrics.classification_metrics(scored_lines(spark, sf), RUN))


SAFETY = (
    "false_negative_rate",
    "positive_predictive_value",
    "negative_predictive_value",
    "matthews_correlation",
)
SAFETY_LIST = ", ".join(f"round({c}, 6) AS {c}" for c in SAFETY)


@query(
    "safety_metrics",
    f"WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id, {SAFETY_LIST}, fn AS missed_ades, fp AS false_alarms FROM runs",
)
def safety_metrics(spark, sf):
    df = metrics.safety_metrics(scored_lines(spark, sf), RUN)
    return tidy(df.select("run_id", *SAFETY, "missed_ades", "false_alarms"))


@query(
    "wilson",
    f"""WITH g AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS hits, count(*) AS trials
      FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey, hits, trials, {wilson_sql('hits', 'trials', 'lo')} AS lo, {wilson_sql('hits', 'trials', 'hi')} AS hi FROM g""",
)
def wilson(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("hits"), F.count(F.lit(1)).alias("trials")
    )
    return tidy(
        counted.withColumn("ci", ratios.wilson(F.col("hits"), F.col("trials"))).select(
            "l_suppkey", "hits", "trials", "ci.lo", "ci.hi"
        )
    )


@query(
    "safe_ratio",
    f"""WITH g AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'R' AND l_discount > 0.05::DOUBLE) AS tp,
        count(*) FILTER (l_discount > 0.05::DOUBLE) AS guessed, count(*) FILTER (l_returnflag = 'R') AS actual
      FROM lineitem GROUP BY l_partkey),
    r AS (SELECT *, {ratio('tp', 'guessed')} AS p, {ratio('tp', 'actual')} AS r FROM g)
    SELECT l_partkey, round(p, 6) AS "precision", round(r, 6) AS recall,
      round(CASE WHEN p = 0 OR r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM r""",
)
def safe_ratio(spark, sf):
    guess, truth = F.col("l_discount") > 0.05, F.col("l_returnflag") == "R"
    counted = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count_if(guess & truth).alias("tp"), F.count_if(guess).alias("guessed"), F.count_if(truth).alias("actual")
    )
    rated = counted.withColumns(
        {
            "precision": ratios.safe_ratio(F.col("tp"), F.col("guessed")),
            "recall": ratios.safe_ratio(F.col("tp"), F.col("actual")),
        }
    )
    return tidy(
        rated.select(
            "l_partkey", "precision", "recall", ratios.f1_score(F.col("precision"), F.col("recall")).alias("f1")
        )
    )


@query(
    "pct_round",
    f"""SELECT l_suppkey, {pct_sql("avg((l_returnflag = 'R')::INT)")} AS pct_1, {pct_sql("avg((l_returnflag = 'R')::INT)", 2)} AS pct_2
    FROM lineitem GROUP BY l_suppkey""",
)
def pct_round(spark, sf):
    share = F.avg((F.col("l_returnflag") == "R").cast("int"))
    return tidy(
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(ratios.pct_round(share, 1).alias("pct_1"), ratios.pct_round(share, 2).alias("pct_2"))
    )


@query(
    "behaviour_rates",
    f"""WITH {LINES_SQL} SELECT run_id, count(*) AS total, count(*) FILTER (y_true) AS actual_positives,
      count(*) FILTER (y_pred) AS predicted_positives,
      {pct_sql('count(*) FILTER (y_pred)::DOUBLE / count(*)')} AS positive_prediction_pct,
      {pct_sql('count(*) FILTER (y_true)::DOUBLE / count(*)')} AS ground_truth_positive_pct
    FROM scored GROUP BY run_id""",
)
def behaviour_rates(spark, sf):
    return tidy(profile.behaviour_rates(scored_lines(spark, sf), RUN))


@query(
    "outcome_label",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id,
      CASE WHEN y_true AND y_pred THEN 'TP' WHEN y_pred THEN 'FP' WHEN y_true THEN 'FN' ELSE 'TN' END AS outcome FROM scored""",
)
def outcomes(spark, sf):
    return scored_documents(spark, sf).select(
        "run_id", "example_id", outcome_label(F.col("y_true"), F.col("y_pred")).alias("outcome")
    )


@query(
    "grade_band",
    f"""WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id,
      CASE WHEN f1 > 0.8 AND false_negative_rate < 0.15 THEN 'excellent' WHEN f1 > 0.7 THEN 'good'
        WHEN f1 > 0.6 THEN 'needs_improvement' ELSE 'poor' END AS grade,
      CASE WHEN false_negative_rate > 0.2 THEN 'high' WHEN false_negative_rate > 0.1 THEN 'moderate' ELSE 'low' END AS miss_rate,
      concat_ws('; ', CASE WHEN recall < 0.7 THEN 'low recall' END, CASE WHEN "precision" < 0.7 THEN 'low precision' END) AS warnings
    FROM runs""",
)
def grade_band(spark, sf):
    graded = flows.graded_run(scored_lines(spark, sf), RUN)
    return graded.select("run_id", "grade", "miss_rate", F.array_join("warnings", "; ").alias("warnings"))


@query(
    "align_predictions",
    """SELECT d.doc_id AS example_id, d.n_chars >= 2000 AS y_pred, l.toxic = 1 AS y_true
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def aligned(spark, sf):
    guesses = table(spark, sf, "documents").select(
        F.col("doc_id").alias("example_id"), (F.col("n_chars") >= 2000).alias("y_pred")
    )
    truth = table(spark, sf, "labels").select(F.col("doc_id").alias("example_id"), (F.col("toxic") == 1).alias("y_true"))
    return align_predictions(guesses, truth)


# --- multi-class -----------------------------------------------------------------------------

def scored_languages(spark, sf):
    """Language guessed from accented letters against the recorded language."""
    text = F.col("text")
    guess = (
        F.when(text.rlike("[äöüß]"), "de")
        .when(text.rlike("[ñóíáú]"), "es")
        .when(text.rlike("[éèêàç]"), "fr")
        .otherwise("en")
    )
    return table(spark, sf, "documents").select(F.col("lang").alias("y_true"), guess.alias("y_pred"))


LANGUAGE_SQL = """scored AS (SELECT lang AS y_true,
  CASE WHEN regexp_matches(text, '[äöüß]') THEN 'de' WHEN regexp_matches(text, '[ñóíáú]') THEN 'es'
    WHEN regexp_matches(text, '[éèêàç]') THEN 'fr' ELSE 'en' END AS y_pred FROM documents)"""


@query(
    "confusion_multiclass",
    f"WITH {LANGUAGE_SQL} SELECT y_pred AS pred, y_true AS actual, count(*) AS n FROM scored GROUP BY ALL",
)
def confusion_multiclass(spark, sf):
    return tidy(metrics.confusion_multiclass(scored_languages(spark, sf)))


@query(
    "per_class_metrics",
    f"""WITH {LANGUAGE_SQL}, classes AS (SELECT y_pred AS class FROM scored UNION SELECT y_true FROM scored),
    c AS (SELECT class, count(*) FILTER (y_pred = class AND y_true = class) AS tp,
        count(*) FILTER (y_pred = class AND y_true <> class) AS fp,
        count(*) FILTER (y_pred <> class AND y_true = class) AS fn FROM classes, scored GROUP BY class),
    r AS (SELECT *, {ratio('tp', 'tp + fp')} AS p, {ratio('tp', 'tp + fn')} AS r FROM c)
    SELECT class, tp, fp, fn, round(p, 6) AS "precision", round(r, 6) AS recall,
      round(CASE WHEN p = 0 OR r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM r""",
)
def per_class_metrics(spark, sf):
    return tidy(metrics.per_class_metrics(metrics.confusion_multiclass(scored_languages(spark, sf))))


@query(
    "evaluate_batch",
    f"""WITH {LANGUAGE_SQL},
    c AS (SELECT count(*) FILTER (y_pred <> 'en' AND y_true <> 'en') AS tp, count(*) FILTER (y_pred <> 'en' AND y_true = 'en') AS fp,
      count(*) FILTER (y_pred = 'en' AND y_true = 'en') AS tn, count(*) FILTER (y_pred = 'en' AND y_true <> 'en') AS fn,
      count(*) FILTER (y_pred = y_true) AS correct, count(*) AS total FROM scored),
    r AS (SELECT *, {ratio('tp', 'tp + fp')} AS p, {ratio('tp', 'tp + fn')} AS r FROM c)
    SELECT tp, fp, tn, fn, correct, total, round(p, 6) AS "precision", round(r, 6) AS recall,
      round({ratio('correct', 'total')}, 6) AS accuracy,
      round(CASE WHEN p = 0 OR r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM r""",
)
def evaluate_batch(spark, sf):
    return tidy(metrics.evaluate_batch(scored_languages(spark, sf), "en"))


# --- extraction ------------------------------------------------------------------------------
# Truth: distinct flag/status codes of an order; prediction: the codes of its lines over 20 pieces.
# Six codes exist, so a list is six flags, whatever the number of lines of an order.

FLAGS, STATUSES = ("A", "N", "R"), ("F", "O")


def code_list(present, codes):
    """Codes that occur in a group, from one flag per code (plain hash aggregation)."""
    return F.array_compact(F.array(*[F.when(F.bool_or(present(c)), F.lit(c)) for c in codes]))


def scored_orders(spark, sf):
    lines = table(spark, sf, "lineitem")
    code = F.concat("l_returnflag", F.lit("-"), "l_linestatus")
    upper = [f"{f}-{s}" for f in FLAGS for s in STATUSES]
    return lines.groupBy("l_orderkey").agg(
        code_list(lambda c: (F.col("l_returnflag") != "N") & (code == c), upper).alias("true_items"),
        code_list(lambda c: (F.col("l_quantity") > 20) & (F.lower(code) == c), [c.lower() for c in upper]).alias(
            "pred_items"
        ),
    )


ORDERS_SQL = """coded AS (SELECT l_orderkey, lower(l_returnflag || '-' || l_linestatus) AS item,
    max((l_returnflag <> 'N')::INT) AS t, max((l_quantity > 20)::INT) AS p FROM lineitem GROUP BY ALL),
  rows_ AS (SELECT l_orderkey, count(*) FILTER (t = 1 AND p = 1) AS hits, count(*) FILTER (p = 1) AS np,
    count(*) FILTER (t = 1) AS nt FROM coded GROUP BY l_orderkey),
  rated AS (SELECT *, coalesce(hits::DOUBLE / nullif(np, 0), 0) AS p, coalesce(hits::DOUBLE / nullif(nt, 0), 0) AS r FROM rows_),
  marks AS (SELECT *, CASE WHEN p = 0 OR r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM rated)"""

EXTRACTION_SQL = f"""{ORDERS_SQL},
  s AS (SELECT avg(p) FILTER (nt > 0) AS "precision", avg(r) FILTER (nt > 0) AS recall, avg(f) FILTER (nt > 0) AS f1,
    (sum(hits) FILTER (nt > 0))::BIGINT AS item_tp, (sum(np - hits) FILTER (nt > 0))::BIGINT AS item_fp,
    (sum(nt - hits) FILTER (nt > 0))::BIGINT AS item_fn, count(*) FILTER (nt > 0) AS valid_examples,
    count(*) AS total_examples FROM marks),
  m AS (SELECT *, {ratio('item_tp', 'item_tp + item_fp')} AS mp, {ratio('item_tp', 'item_tp + item_fn')} AS mr FROM s)
  SELECT round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, item_tp, item_fp, item_fn,
    valid_examples, total_examples, round(mp, 6) AS micro_precision, round(mr, 6) AS micro_recall,
    round(2 * mp * mr / (mp + mr), 6) AS micro_f1 FROM m"""


@query("extraction_metrics", f"WITH {EXTRACTION_SQL}")
def extraction_metrics(spark, sf):
    return tidy(metrics.extraction_metrics(scored_orders(spark, sf)))


@query(
    "extraction_metrics_long",
    f"WITH {EXTRACTION_SQL.replace('FROM marks', 'FROM marks WHERE np + nt > 0')}",
)
def extraction_metrics_long(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("example_id"),
        F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("item"),
        "l_returnflag",
        "l_quantity",
    )
    return tidy(
        metrics.extraction_metrics_long(
            lines.filter(F.col("l_quantity") > 20), lines.filter(F.col("l_returnflag") != "N")
        )
    )


@query(
    "extraction_errors",
    f"""WITH {ORDERS_SQL} SELECT l_orderkey,
      coalesce(string_agg(item, ',' ORDER BY item) FILTER (p = 1 AND t = 0), '') AS false_positives,
      coalesce(string_agg(item, ',' ORDER BY item) FILTER (t = 1 AND p = 0), '') AS false_negatives
    FROM coded GROUP BY l_orderkey HAVING count(*) FILTER (p <> t) > 0""",
)
def extraction_errors(spark, sf):
    errors = metrics.extraction_errors(scored_orders(spark, sf))
    return errors.select(
        "l_orderkey",
        F.array_join(F.sort_array("false_positives"), ",").alias("false_positives"),
        F.array_join(F.sort_array("false_negatives"), ",").alias("false_negatives"),
    )


@query(
    "extraction_error_bag",
    f"""WITH {ORDERS_SQL} SELECT CASE WHEN p = 1 THEN 'false_positive' ELSE 'false_negative' END AS kind, item, count(*) AS n
    FROM coded WHERE p <> t GROUP BY ALL""",
)
def extraction_error_bag(spark, sf):
    return tidy(metrics.error_item_bag(metrics.extraction_errors(scored_orders(spark, sf))))


# --- runs ------------------------------------------------------------------------------------

@query(
    "pipeline_scorecard",
    f"""WITH coded AS (SELECT l_orderkey, l_returnflag AS item, max((l_linestatus = 'F')::INT) AS t,
        max((l_quantity > 25)::INT) AS p FROM lineitem GROUP BY ALL),
      statuses AS (SELECT l_orderkey, l_linestatus AS item, max((l_tax > 0.02)::INT) AS t,
        max((l_discount > 0.02)::INT) AS p FROM lineitem GROUP BY ALL),
      a AS (SELECT l_orderkey, count(*) FILTER (t = 1 AND p = 1) AS h, count(*) FILTER (p = 1) AS np, count(*) FILTER (t = 1) AS nt FROM coded GROUP BY 1),
      b AS (SELECT l_orderkey, count(*) FILTER (t = 1 AND p = 1) AS h, count(*) FILTER (p = 1) AS np, count(*) FILTER (t = 1) AS nt FROM statuses GROUP BY 1),
      g AS (SELECT l_orderkey, sum(l_quantity) > 100 AS y_true, max(l_linenumber) > 4 AS y_pred FROM lineitem GROUP BY 1),
      c AS (SELECT count(*) FILTER (y_true AND y_pred) AS tp, count(*) FILTER (NOT y_true AND y_pred) AS fp,
        count(*) FILTER (NOT y_true AND NOT y_pred) AS tn, count(*) FILTER (y_true AND NOT y_pred) AS fn, count(*) AS examples_evaluated FROM g)
      SELECT examples_evaluated, tp, fp, tn, fn, round({ratio('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy,
        round({ratio('fn', 'tp + fn')}, 6) AS false_negative_rate,
        (SELECT round(avg({ratio('h', 'np')}) FILTER (nt > 0), 6) FROM a) AS drug_precision,
        (SELECT round(avg({ratio('h', 'nt')}) FILTER (nt > 0), 6) FROM a) AS drug_recall,
        (SELECT round(avg({ratio('h', 'np')}) FILTER (nt > 0), 6) FROM b) AS effect_precision,
        (SELECT round(avg({ratio('h', 'nt')}) FILTER (nt > 0), 6) FROM b) AS effect_recall FROM c""",
)
def pipeline_scorecard(spark, sf):
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        code_list(lambda c: (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == c), FLAGS).alias("true_drugs"),
        code_list(lambda c: (F.col("l_quantity") > 25) & (F.col("l_returnflag") == c), FLAGS).alias("pred_drugs"),
        code_list(lambda c: (F.col("l_tax") > 0.02) & (F.col("l_linestatus") == c), STATUSES).alias("true_effects"),
        code_list(lambda c: (F.col("l_discount") > 0.02) & (F.col("l_linestatus") == c), STATUSES).alias("pred_effects"),
        (F.sum("l_quantity") > 100).alias("y_true"),
        (F.max("l_linenumber") > 4).alias("y_pred"),
    )
    card = metrics.pipeline_scorecard(orders)
    return tidy(
        card.select(
            "examples_evaluated", "tp", "fp", "tn", "fn", "accuracy", "false_negative_rate",
            "drug_precision", "drug_recall", "effect_precision", "effect_recall",
        )
    )


PERFORMANCE_SQL = f"""perf AS (SELECT run_id, count(*) AS examples_evaluated, sum(coalesce(api_calls, 1))::BIGINT AS total_api_calls,
    count(*) FILTER (error IS NOT NULL) AS processing_errors, avg(latency_s) AS seconds FROM scored GROUP BY run_id),
  performance AS (SELECT run_id, examples_evaluated, total_api_calls, processing_errors,
    {ratio('total_api_calls', 'examples_evaluated')} AS api_calls_per_prediction,
    round(seconds * 1000.0::DOUBLE) / 1000.0::DOUBLE AS avg_processing_time,
    total_api_calls * 150 / 1000000.0::DOUBLE AS estimated_cost_usd FROM perf)"""


@query(
    "pipeline_performance",
    f"WITH {LINES_SQL}, {PERFORMANCE_SQL} SELECT * REPLACE (round(api_calls_per_prediction, 6) AS api_calls_per_prediction, round(avg_processing_time, 6) AS avg_processing_time, round(estimated_cost_usd, 6) AS estimated_cost_usd) FROM performance",
)
def pipeline_performance(spark, sf):
    return tidy(metrics.pipeline_performance(scored_lines(spark, sf), RUN))


@query(
    "evaluator_summary",
    f"""WITH {SCORED_SQL}, {RUNS_SQL},
    c AS (SELECT run_id, avg(confidence) AS average_confidence, count(*) FILTER (confidence < 0.6) AS low_confidence_predictions,
      avg((y_true = y_pred)::INT) AS pass_rate FROM scored GROUP BY run_id)
    SELECT run_id, tp, fp, tn, fn, round(average_confidence, 6) AS average_confidence, low_confidence_predictions,
      round(pass_rate, 6) AS pass_rate, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
      round(recall, 6) AS recall, round(f1, 6) AS f1, round(false_negative_rate, 6) AS false_negative_rate,
      fn AS missed_ades, fp AS false_alarms FROM runs JOIN c USING (run_id)""",
)
def evaluator_summary(spark, sf):
    return tidy(metrics.evaluator_summary(scored_documents(spark, sf), RUN))


@query(
    "recall_on_positives",
    f"""WITH {LINES_SQL} SELECT run_id, count(*) AS positives, count(*) FILTER (NOT y_pred) AS missed,
      {pct_sql('count(*) FILTER (y_pred)::DOUBLE / count(*)')} AS recall_pct FROM scored WHERE y_true GROUP BY run_id""",
)
def recall_on_positives(spark, sf):
    return tidy(metrics.recall_on_positives(scored_lines(spark, sf), RUN))


@query(
    "error_budget",
    f"""WITH {LINES_SQL} SELECT run_id, y_true, y_pred, api_calls::BIGINT AS api_calls, count(*) AS "rows", count(*) FILTER (error IS NOT NULL) AS errors,
      count(*) FILTER (error IS NOT NULL) >= 100 AS stopped FROM scored GROUP BY run_id, y_true, y_pred, api_calls""",
)
def error_budget(spark, sf):
    """Runs cut by outcome and number of calls, so that some use up the budget and some do not."""
    return tidy(metrics.error_budget(scored_lines(spark, sf), 100, [*RUN, "y_true", "y_pred", "api_calls"]))


@query(
    "error_cases",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id, y_true, y_pred, round(coalesce(confidence, 0.5), 6) AS confidence,
      substring(text, 1, 201) AS text FROM scored WHERE y_true AND NOT y_pred""",
)
def error_cases(spark, sf):
    return tidy(metrics.error_cases(scored_documents(spark, sf), "FN"))


@query(
    "confidence_filter",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id, round(confidence, 6) AS confidence, substring(text, 1, 201) AS text
    FROM scored WHERE confidence < 0.6""",
)
def confidence_filter(spark, sf):
    low = metrics.confidence_filter(scored_documents(spark, sf), 0.6)
    return tidy(low.select("run_id", "example_id", "confidence", "text"))


@query(
    "top_errors",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id, round(confidence, 6) AS confidence, substring(text, 1, 101) AS text
    FROM scored WHERE NOT y_true AND y_pred ORDER BY scored.confidence, example_id, run_id LIMIT 3""",
)
def top_errors(spark, sf):
    cases = metrics.error_cases(scored_documents(spark, sf), "FP", last_index=100)
    return tidy(metrics.top_errors(cases, 3, "confidence", "example_id", "run_id").select("run_id", "example_id", "confidence", "text"))


# --- per-row metrics -------------------------------------------------------------------------

def _scores(spark, sf, metric, *details):
    scored = scored_documents(spark, sf)
    result = metric(F.col("y_true"), F.col("y_pred"), F.col("confidence"))
    rows = scored.select("run_id", "example_id", result.alias("m"))
    return tidy(rows.select("run_id", "example_id", "m.score", *[f"m.details.{d}" for d in details]))


@query(
    "metric_safety",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id,
      CASE WHEN y_true AND NOT y_pred THEN 0.0::DOUBLE WHEN NOT y_true AND y_pred THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END AS score,
      CASE WHEN y_true AND NOT y_pred THEN 'false_negative' WHEN NOT y_true AND y_pred THEN 'false_positive'
        WHEN y_true THEN 'true_positive' ELSE 'true_negative' END AS type,
      CASE WHEN y_true AND NOT y_pred THEN 'high' WHEN NOT y_true AND y_pred THEN 'low' ELSE 'none' END AS medical_risk FROM scored""",
)
def metric_safety(spark, sf):
    return _scores(spark, sf, scoring.metric_safety, "type", "medical_risk")


@query(
    "metric_balanced",
    f"WITH {SCORED_SQL} SELECT run_id, example_id, (y_true = y_pred)::INT::DOUBLE AS score, y_true = y_pred AS correct FROM scored",
)
def metric_balanced(spark, sf):
    return _scores(spark, sf, scoring.metric_balanced, "correct")


@query(
    "metric_confidence_aware",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id,
      (y_true = y_pred)::INT * CASE WHEN confidence < 0.7::DOUBLE THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS score,
      CASE WHEN confidence < 0.7::DOUBLE THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS confidence_penalty FROM scored""",
)
def metric_confidence_aware(spark, sf):
    return _scores(spark, sf, scoring.metric_confidence_aware(0.7), "confidence_penalty")


@query(
    "metric_comprehensive",
    f"""WITH {SCORED_SQL} SELECT run_id, example_id, (y_true = y_pred)::INT::DOUBLE AS score,
      round(coalesce(confidence, 0.5), 6) AS confidence FROM scored""",
)
def metric_comprehensive(spark, sf):
    return _scores(spark, sf, scoring.metric_comprehensive, "confidence")


@query(
    "metric_status_threshold",
    f"WITH {SCORED_SQL} SELECT run_id, example_id, confidence >= 0.7::DOUBLE AND y_true = y_pred AS passed FROM scored",
)
def metric_status_threshold(spark, sf):
    metric = scoring.metric_status_threshold(0.7)
    status = lambda c: F.when(F.col(c), "mild_adverse_event").otherwise("no_adverse_event")
    passed = metric(status("y_true"), status("y_pred"), F.col("confidence"))
    return scored_documents(spark, sf).select("run_id", "example_id", passed.alias("passed"))


@query(
    "pass_rate",
    f"""WITH {LINES_SQL}, m AS (SELECT run_id, CASE WHEN y_true AND NOT y_pred THEN 0.0::DOUBLE
        WHEN NOT y_true AND y_pred THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END AS score FROM scored)
    SELECT run_id, round(avg(score), 6) AS mean_score, round(avg((score = 1)::INT), 6) AS pass_rate FROM m GROUP BY run_id""",
)
def pass_rate(spark, sf):
    return tidy(metrics.pass_rate(scored_lines(spark, sf), scoring.metric_safety, RUN))


@query(
    "metric_plug_in",
    f"""WITH {LINES_SQL} SELECT run_id, round(avg(CASE WHEN y_true = y_pred THEN confidence ELSE 0 END), 6) AS mean_score,
      round(avg((y_true = y_pred AND confidence = 1)::INT), 6) AS pass_rate FROM scored GROUP BY run_id""",
)
def metric_plug_in(spark, sf):
    def agreement_weight(y_true, y_pred, confidence):
        return F.struct(F.when(y_true == y_pred, confidence).otherwise(0.0).alias("score"))

    return tidy(metrics.pass_rate(scored_lines(spark, sf), agreement_weight, RUN))


# --- comparison ------------------------------------------------------------------------------

def run_table(spark, sf):
    """Metrics and performance of the three runs."""
    return metrics.run_table(scored_lines(spark, sf), RUN)


NAMES = ("accuracy", "precision", "recall", "f1", "false_negative_rate")
LONG_SQL = f"""long AS (UNPIVOT (SELECT run_id, accuracy, "precision", recall, f1, false_negative_rate FROM runs)
    ON accuracy, "precision", recall, f1, false_negative_rate INTO NAME metric VALUE v),
  delta AS (SELECT metric, max(v) FILTER (run_id = 'open') AS baseline, max(v) FILTER (run_id = 'quantity') AS candidate FROM long GROUP BY metric)"""


@query(
    "run_delta",
    f"""WITH {LINES_SQL}, {RUNS_SQL}, {LONG_SQL} SELECT metric, round(baseline, 6) AS baseline, round(candidate, 6) AS candidate,
      round(candidate - baseline, 6) AS delta FROM delta""",
)
def run_delta(spark, sf):
    table_ = metrics.add_safety(metrics.classification_metrics(scored_lines(spark, sf), RUN))
    return tidy(compare.run_delta(table_, "open", "quantity", NAMES))


def change_sql(new: str, old: str, digits: int = 1) -> str:
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"(round(coalesce(({new} - {old}) / nullif({old}, 0), 0) * 100.0::DOUBLE * {scale}) / {scale})"


@query(
    "improvement",
    f"""WITH {LINES_SQL}, {RUNS_SQL}, {LONG_SQL} SELECT metric,
      CASE WHEN metric <> 'false_negative_rate' THEN {change_sql('candidate', 'baseline')} END AS improvement_pct,
      CASE WHEN metric = 'false_negative_rate' THEN round((baseline - candidate) * 1000.0::DOUBLE) / 1000.0::DOUBLE END AS fnr_reduction
    FROM delta""",
)
def improvement(spark, sf):
    out = flows.experiment(scored_lines(spark, sf), "open", "quantity", NAMES)
    return tidy(out["delta"].select("metric", "improvement_pct", "fnr_reduction"))


@query(
    "safety_delta",
    f"""WITH {LINES_SQL}, {RUNS_SQL}, b AS (SELECT * FROM runs WHERE run_id = 'open'), c AS (SELECT * FROM runs WHERE run_id = 'quantity')
    SELECT round(c.fn::DOUBLE / (b.tp + b.fn), 6) AS false_negative_rate, c.fn AS critical_misses,
      round(c.recall - b.recall, 6) AS recall_improvement FROM b, c""",
)
def safety_delta(spark, sf):
    table_ = metrics.classification_metrics(scored_lines(spark, sf), RUN)
    return tidy(compare.safety_delta(table_, "open", "quantity"))


def _of(run: str, column: str) -> str:
    return f'max("{column}") FILTER (run_id = \'{run}\')'


TABLE_SQL = f"{LINES_SQL}, {RUNS_SQL}, {PERFORMANCE_SQL}, run_table AS (SELECT * FROM runs JOIN performance USING (run_id))"


EFFICIENCY_SELECT = f"""SELECT round(sc / dc * 10) / 10 AS api_call_ratio, round(scost / dcost * 10) / 10 AS cost_ratio,
      round((sc - dc) / sc * 100) AS cost_savings_pct, {change_sql('df', 'sf')} AS performance_trade_off_pct,
      {pct_sql('df')} AS baseline_f1_pct, {pct_sql('o')} AS optimized_f1_pct, {change_sql('o', 'df')} AS improvement_pct,
      o - df > 0.05 AS optimization_worthwhile FROM
      (SELECT {_of('open', 'api_calls_per_prediction')} AS sc, {_of('quantity', 'api_calls_per_prediction')} AS dc,
        {_of('open', 'estimated_cost_usd')} AS scost, {_of('quantity', 'estimated_cost_usd')} AS dcost,
        {_of('open', 'f1')} AS sf, {_of('quantity', 'f1')} AS df, {_of('discount', 'f1')} AS o FROM run_table)"""


@query("cost_efficiency", f"WITH {TABLE_SQL} {EFFICIENCY_SELECT}")
def cost_efficiency(spark, sf):
    return tidy(compare.cost_efficiency(run_table(spark, sf), "open", "quantity", "discount"))


ADVICE_SQL = f"""{TABLE_SQL}, p AS (SELECT {_of('open', 'f1')} AS s, {_of('quantity', 'f1')} AS d, {_of('discount', 'f1')} AS o,
        {_of('open', 'api_calls_per_prediction')} AS sc, {_of('quantity', 'api_calls_per_prediction')} AS dc FROM run_table),
    q AS (SELECT {change_sql('d', 's')} AS diff, {change_sql('o', 'd')} AS gain, round(sc / dc * 10) / 10 AS ratio FROM p),
    a AS (SELECT 1 AS k, 'architecture' AS category, CASE WHEN abs(diff) < 5 THEN 'direct' ELSE 'staged' END AS recommendation,
        'F1 of the direct run against the staged one: ' || diff::VARCHAR || ' %' ||
          CASE WHEN abs(diff) < 5 THEN '; calls saved by a factor of ' || ratio::VARCHAR ELSE '' END AS reasoning,
        CASE WHEN abs(diff) < 5 THEN 'High' ELSE 'Medium' END AS confidence FROM q WHERE abs(diff) < 5 OR diff < -10
      UNION ALL SELECT 2, 'optimisation', CASE WHEN gain > 10 THEN 'optimise' WHEN gain > 5 THEN 'try_optimising' ELSE 'keep_baseline' END,
        'F1 after optimising: ' || gain::VARCHAR || ' %', CASE WHEN gain > 10 THEN 'High' ELSE 'Medium' END FROM q)"""


@query(
    "recommend",
    f"WITH {ADVICE_SQL} SELECT row_number() OVER (ORDER BY k) AS rule_no, category, recommendation, reasoning, confidence FROM a",
)
def recommend(spark, sf):
    return compare.recommend(run_table(spark, sf), "open", "quantity", "discount")


@query(
    "trade_off_verdict",
    f"""WITH {LINES_SQL}, {RUNS_SQL}, p AS (SELECT ({_of('open', 'f1')} - {_of('quantity', 'f1')}) * 100 AS f,
        ({_of('open', 'false_negative_rate')} - {_of('quantity', 'false_negative_rate')}) * 100 AS n FROM runs)
    SELECT round(f * 10) / 10 AS f1_delta, round(n * 10) / 10 AS fnr_delta,
      CASE WHEN abs(f) < 5 THEN 'similar' WHEN f > 0 THEN 'staged' ELSE 'direct' END AS f1_advantage,
      CASE WHEN abs(n) < 2 THEN 'similar' WHEN n > 0 THEN 'direct' ELSE 'staged' END AS safer,
      CASE WHEN abs(f) < 3 AND abs(n) < 3 THEN 'direct' WHEN f > 5 AND n < -5 THEN 'staged' ELSE 'mixed' END AS recommended FROM p""",
)
def trade_off_verdict(spark, sf):
    return tidy(compare.trade_off_verdict(run_table(spark, sf), "open", "quantity"))


@query(
    "optimizer_winner",
    f"""WITH {LINES_SQL}, {RUNS_SQL} SELECT
      CASE WHEN {_of('quantity', 'f1')} > {_of('discount', 'f1')} THEN 'quantity' ELSE 'discount' END AS f1_winner,
      CASE WHEN {_of('quantity', 'false_negative_rate')} < {_of('discount', 'false_negative_rate')} THEN 'quantity' ELSE 'discount' END AS safer
    FROM runs""",
)
def optimizer_winner(spark, sf):
    return compare.optimizer_winner(run_table(spark, sf), "discount", "quantity")


@query(
    "rank_runs",
    f"""WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id, round(f1, 6) AS f1,
      row_number() OVER (ORDER BY f1 DESC, run_id) AS position FROM runs""",
)
def rank_runs(spark, sf):
    ranked = flows.experiment(scored_lines(spark, sf), "open", "quantity", NAMES)["ranking"]
    return tidy(ranked.select("run_id", "f1", "position"))


@query(
    "best_recall",
    f"""WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id AS best_run, round(recall, 6) AS recall, round("precision", 6) AS "precision"
    FROM runs ORDER BY runs.recall DESC, run_id LIMIT 1""",
)
def best_recall(spark, sf):
    return tidy(compare.best_recall(metrics.classification_metrics(scored_lines(spark, sf), RUN)))


# A candidate is one quantity threshold; all candidates are counted in a single pass.
@query(
    "candidate_grid",
    f"""WITH scored AS (SELECT 'q' || lpad(t::VARCHAR, 2, '0') AS run_id, l_returnflag = 'R' AS y_true, l_quantity > t AS y_pred
      FROM lineitem, (SELECT unnest([5, 10, 15, 20, 25, 30, 35, 40]) AS t)), {RUNS_SQL}
    SELECT run_id, round(f1, 6) AS f1, round(recall, 6) AS recall,
      run_id = (SELECT run_id FROM runs ORDER BY f1 DESC, run_id LIMIT 1) AS is_best FROM runs""",
)
def candidate_grid(spark, sf):
    rules = {f"q{t:02d}": F.col("l_quantity") > t for t in range(5, 45, 5)}
    cells = metrics.confusion_of_rules(table(spark, sf, "lineitem"), F.col("l_returnflag") == "R", rules)
    grid = compare.candidate_grid(metrics.add_classification(cells))
    return tidy(grid.select("run_id", "f1", "recall", "is_best"))
