import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scoring
from tallyloom.operators import compare, metrics, profile
from tallyloom.operators.joins import align_predictions

from .conftest import collected

SCORED = "run_id string, example_id long, y_true boolean, y_pred boolean, confidence double, text string"


def cells(tp, fp, tn, fn, run="r"):
    kinds = [(True, True)] * tp + [(False, True)] * fp + [(False, False)] * tn + [(True, False)] * fn
    return [(run, i, t, p, 0.9, f"text {i}") for i, (t, p) in enumerate(kinds)]


def test_published_staged_run(rows):
    got = metrics.add_safety(metrics.classification_metrics(rows(cells(8, 3, 14, 0), SCORED))).first()
    assert got["accuracy"] == 0.88 and got["recall"] == 1.0
    assert got["precision"] == pytest.approx(0.7273, abs=1e-4) and got["f1"] == pytest.approx(0.8421, abs=1e-4)
    assert got["specificity"] == pytest.approx(0.8235, abs=1e-4)
    assert got["matthews_correlation"] == pytest.approx(0.773905989951895, abs=1e-12)
    assert got["accuracy_ci"]["lo"] == pytest.approx(0.7004380781662651, abs=1e-12)


def test_published_direct_run(rows):
    got = metrics.add_safety(metrics.classification_metrics(rows(cells(8, 5, 12, 0), SCORED))).first()
    assert got["accuracy"] == 0.8 and got["f1"] == pytest.approx(0.7619, abs=1e-4)
    assert got["matthews_correlation"] == pytest.approx(0.6590820436573077, abs=1e-12)


def test_missing_side_is_in_no_cell(rows):
    data = [("r", 1, True, None, None, ""), ("r", 2, None, True, None, ""), ("r", 3, True, True, None, "")]
    got = metrics.confusion_binary(rows(data, SCORED)).first()
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == (1, 0, 0, 0)


def test_empty_input_gives_zeros(rows):
    got = metrics.add_safety(metrics.classification_metrics(rows([], SCORED))).first()
    assert got["total"] == 0 and got["accuracy"] == 0.0 and got["f1"] == 0.0 and got["matthews_correlation"] == 0.0
    assert got["recall_ci"]["hi"] == 0.0


def test_runs_are_evaluated_together(rows):
    df = rows(cells(8, 3, 14, 0, "a") + cells(8, 5, 12, 0, "b"), SCORED)
    got = {r["run_id"]: r["accuracy"] for r in metrics.classification_metrics(df, ["run_id"]).collect()}
    assert got == {"a": 0.88, "b": 0.8}


def test_rules_agree_with_repeated_rows(rows):
    df = rows(cells(4, 3, 2, 1), SCORED)
    many = metrics.confusion_of_rules(df, F.col("y_true"), {"same": F.col("y_pred"), "not": ~F.col("y_pred")})
    assert collected(many, "run_id") == [("not", 1, 2, 3, 4), ("same", 4, 3, 2, 1)]


PREDS = ["none", "mild", "severe", "none", "mild"]
ACTUALS = ["none", "mild", "mild", "none", "severe"]


def three_class(rows):
    return rows(list(zip(PREDS, ACTUALS)), "y_pred string, y_true string")


def test_three_class_matrix(rows):
    matrix = metrics.confusion_multiclass(three_class(rows))
    got = {(r["pred"], r["actual"]): r["n"] for r in matrix.collect()}
    assert got == {("none", "none"): 2, ("mild", "mild"): 1, ("severe", "mild"): 1, ("mild", "severe"): 1}
    per = {r["class"]: r for r in metrics.per_class_metrics(matrix).collect()}
    assert per["none"]["f1"] == 1.0 and per["mild"]["precision"] == 0.5 and per["mild"]["recall"] == 0.5
    assert per["severe"]["f1"] == 0.0


def test_evaluate_batch(rows):
    got = metrics.evaluate_batch(three_class(rows), "none").first()
    assert (got["tp"], got["fp"], got["tn"], got["fn"], got["correct"], got["total"]) == (3, 0, 2, 0, 3, 5)
    assert got["accuracy"] == 0.6 and got["f1"] == 1.0
    empty = metrics.evaluate_batch(three_class(rows).limit(0), "none").first()
    assert empty["accuracy"] == 0.0 and empty["total"] == 0


ITEMS = "example_id long, pred_items array<string>, true_items array<string>"


def item_rows(rows):
    return rows(
        [
            (1, ["Aspirin", "aspirin", "x"], ["ASPIRIN"]),
            (2, None, ["a", "b"]),
            (3, ["c"], []),
            (4, ["d", "e"], ["d", "e"]),
        ],
        ITEMS,
    )


def test_extraction(rows):
    got = metrics.extraction_metrics(item_rows(rows)).first()
    assert (got["valid_examples"], got["total_examples"]) == (3, 4)
    assert (got["item_tp"], got["item_fp"], got["item_fn"]) == (3, 1, 2)
    assert got["precision"] == pytest.approx((0.5 + 0 + 1) / 3) and got["recall"] == pytest.approx(2 / 3)
    assert got["f1"] == pytest.approx((2 / 3 + 0 + 1) / 3)
    assert got["micro_precision"] == 0.75 and got["micro_recall"] == 0.6


def test_long_extraction_agrees(rows):
    df = item_rows(rows)
    pred = df.select("example_id", F.explode("pred_items").alias("item"))
    true = df.select("example_id", F.explode("true_items").alias("item"))
    wide, long = metrics.extraction_metrics(df).first(), metrics.extraction_metrics_long(pred, true).first()
    assert wide == long


def test_extraction_errors(rows):
    errors = metrics.extraction_errors(item_rows(rows))
    assert [r["example_id"] for r in errors.orderBy("example_id").collect()] == [1, 2, 3]
    bag = {(r["kind"], r["item"]): r["n"] for r in metrics.error_item_bag(errors).collect()}
    assert bag == {("false_positive", "x"): 1, ("false_negative", "a"): 1, ("false_negative", "b"): 1, ("false_positive", "c"): 1}


def test_scorecard_is_one_pass(rows):
    df = rows(
        [(["a"], ["a"], ["e"], ["e", "f"], True, True), (["b"], [], [], [], False, True)],
        "pred_drugs array<string>, true_drugs array<string>, pred_effects array<string>, true_effects array<string>, y_true boolean, y_pred boolean",
    )
    card = metrics.pipeline_scorecard(df)
    got = card.first()
    assert got["drug_f1"] == 1.0 and got["effect_recall"] == 0.5 and got["examples_evaluated"] == 2
    assert got["precision"] == 0.5 and got["false_alarms"] == 1
    plan = card._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_performance(rows):
    df = rows(
        [("s", 3, 2.5, None), ("s", None, 3.1004, "boom")], "run_id string, api_calls int, latency_s double, error string"
    )
    got = metrics.pipeline_performance(df, ["run_id"]).first()
    assert got["total_api_calls"] == 4 and got["api_calls_per_prediction"] == 2.0 and got["processing_errors"] == 1
    assert got["avg_processing_time"] == 2.8 and got["estimated_cost_usd"] == 0.0006


def test_summary_counts_missing_answer_as_negative(rows):
    data = [("r", 1, True, None, None, ""), ("r", 2, True, True, 0.9, ""), ("r", 3, False, False, 0.4, "")]
    got = metrics.evaluator_summary(rows(data, SCORED)).first()
    assert (got["tp"], got["fn"], got["tn"]) == (1, 1, 1)
    assert got["low_confidence_predictions"] == 2 and got["average_confidence"] == pytest.approx(0.6)
    assert got["pass_rate"] == pytest.approx(2 / 3) and got["missed_ades"] == 1


def test_recall_and_errors(rows):
    df = rows(cells(3, 1, 1, 1), SCORED)
    got = metrics.recall_on_positives(df).first()
    assert tuple(got) == (4, 1, 75.0)
    assert metrics.recall_on_positives(df.limit(0)).first()["recall_pct"] == 0.0
    misses = metrics.error_cases(df, "FN").collect()
    assert len(misses) == 1 and misses[0]["text"] == "text 5"
    assert metrics.error_cases(df, "FP").count() == 1
    assert metrics.top_errors(metrics.error_cases(df, "FP"), 3, "example_id").count() == 1


def test_budget(rows):
    df = rows([(1, "e"), (2, "e"), (3, None)], "example_id long, error string")
    assert metrics.error_budget(df, 2).first()["stopped"] is True
    assert metrics.error_budget(df, 3).first()["stopped"] is False
    assert metrics.require_budget(df, 3).count() == 3
    with pytest.raises(Exception, match="error budget exceeded"):
        metrics.require_budget(df, 2).collect()


def test_pass_rate(rows):
    got = metrics.pass_rate(rows(cells(2, 1, 0, 1), SCORED), scoring.metric_safety).first()
    assert got["mean_score"] == pytest.approx((2 + 0.3) / 4) and got["pass_rate"] == 0.5


def test_alignment(rows):
    pred = rows([(1, True), (2, False)], "example_id long, y_pred boolean")
    true = rows([(1, True), (3, False)], "example_id long, y_true boolean")
    assert collected(align_predictions(pred, true), "example_id") == [(1, True, True), (2, False, None)]
    with pytest.raises(Exception, match="same length"):
        align_predictions(pred, true, strict=True).collect()
    assert align_predictions(pred, true.replace(3, 2, "example_id"), strict=True).count() == 2


def test_behaviour(rows):
    got = profile.behaviour_rates(rows(cells(3, 1, 4, 0), SCORED)).first()
    assert (got["total"], got["positive_prediction_pct"], got["ground_truth_positive_pct"]) == (8, 50.0, 37.5)


RUNS = "run_id string, f1 double, recall double, `precision` double, false_negative_rate double, tp long, fn long, api_calls_per_prediction double, estimated_cost_usd double"


def published_runs(rows):
    return rows(
        [
            ("direct", 0.7619047619047619, 1.0, 0.6154, 0.0, 8, 0, 1.0, 0.00375),
            ("staged", 0.8421052631578948, 1.0, 0.7273, 0.0, 8, 0, 3.0, 0.01125),
            ("tuned", 0.80, 0.9, 0.72, 0.1, 7, 1, 1.0, 0.00375),
        ],
        RUNS,
    )


def test_cost_efficiency_matches_published(rows):
    got = compare.cost_efficiency(published_runs(rows), "staged", "direct", "tuned").first()
    assert (got["api_call_ratio"], got["cost_ratio"], got["cost_savings_pct"]) == (3.0, 3.0, 67.0)
    assert got["performance_trade_off_pct"] == -9.5 and got["optimization_worthwhile"] is False


def test_deltas(rows):
    delta = compare.improvement(compare.run_delta(published_runs(rows), "direct", "staged", ["f1", "false_negative_rate"]))
    got = {r["metric"]: r for r in delta.collect()}
    assert got["f1"]["improvement_pct"] == 10.5 and got["false_negative_rate"]["fnr_reduction"] == 0.0
    safety = compare.safety_delta(published_runs(rows), "direct", "tuned").first()
    assert safety["false_negative_rate"] == 1 / 8 and safety["critical_misses"] == 1
    assert safety["recall_improvement"] == pytest.approx(-0.1)


def test_improvement_from_zero(rows):
    table = rows([("a", 0.0), ("b", 0.5)], "run_id string, f1 double")
    assert compare.improvement(compare.run_delta(table, "a", "b", ["f1"])).first()["improvement_pct"] == 0.0


def test_recommendations(rows):
    got = collected(compare.recommend(published_runs(rows), "staged", "direct", "tuned"), "rule_no")
    # -9.5 % is neither similar nor more than 10 % worse, and a gain of exactly 5.0 % is not above 5.
    assert [(r[1], r[2]) for r in got] == [("optimisation", "keep_baseline")]
    close = rows([("s", 0.80, 2.0), ("d", 0.79, 1.0)], "run_id string, f1 double, api_calls_per_prediction double")
    reason = compare.recommend(close, "s", "d").first()["reasoning"]
    assert reason == "F1 of the direct run against the staged one: -1.3 %; calls saved by a factor of 2.0"
    assert compare.recommend(close.drop("api_calls_per_prediction"), "s", "d").first()["reasoning"].endswith("factor of unknown")
    far = rows([("s", 0.80), ("d", 0.60)], "run_id string, f1 double")
    assert compare.recommend(far, "s", "d").first()["recommendation"] == "staged"


def test_ranking(rows):
    table = published_runs(rows)
    assert [r["run_id"] for r in compare.rank_runs(table).orderBy("position").collect()] == ["staged", "tuned", "direct"]
    assert compare.best_recall(table).first()["best_run"] == "direct"
    best = [r["run_id"] for r in compare.candidate_grid(table).filter("is_best").collect()]
    assert best == ["staged"]
    winner = compare.optimizer_winner(table, "direct", "tuned").first()
    assert tuple(winner) == ("tuned", "direct")
    verdict = compare.trade_off_verdict(table, "staged", "direct").first()
    assert verdict["f1_delta"] == 8.0 and verdict["recommended"] == "mixed"
