"""The four flows: corpus to scorecard, experiment, cost report, changelog."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.compare import cost_efficiency, improvement, rank_runs, recommend, run_delta
from ..operators.corpus import classification_examples, unify_corpus
from ..operators.costs import (
    calls_with_usage,
    cassette_costs,
    cassette_filter,
    cost_recommendations,
    cost_summary,
    phase_costs,
    phase_files,
    phase_join,
    phase_total,
)
from ..operators.metrics import add_grades, add_safety, classification_metrics, pipeline_scorecard_parts
from ..operators.reports import (
    comparison_lines,
    finding_lines,
    metric_table,
    recommendation_lines,
    title_lines,
)
from ..operators.splits import split_stratified
from ..operators.themes import (
    SERVICE_RULES,
    Rules,
    categorize,
    customer_facing,
    render_changelog,
    themed_rows,
)


def graded_run(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Classification, safety and grade of scored rows from one aggregation."""
    return add_grades(add_safety(classification_metrics(scored, by)))


def corpus_scorecard(
    base: DataFrame,
    effects: DataFrame,
    dosages: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    key: str,
    split: str = "test",
    seed: int | str = 42,
    by: Sequence[str] = (),
) -> DataFrame:
    """Unify, split, score the chosen split and report all metric families.

    ``scorer`` adds ``y_pred, pred_drugs, pred_effects`` to examples with ``text, drugs, effects``. The
    lists of a text come in parts, one row each; predicted items of all parts count, ``y_pred`` that of part 0.
    """
    labelled = split_stratified(base, key, "label", seed=seed).filter(F.col("split") == split)
    examples = classification_examples(unify_corpus(labelled, effects, dosages))
    scored = scorer(examples).withColumns(
        {"y_true": F.col("has_ade"), "true_drugs": F.col("drugs"), "true_effects": F.col("effects")}
    )
    return pipeline_scorecard_parts(scored, key, by)


def experiment(scored: DataFrame, base: str, candidate: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Run table, ranking and deltas of several runs scored over the same examples."""
    metrics = add_safety(classification_metrics(scored, ["run_id"]))
    delta = improvement(run_delta(metrics, base, candidate, names))
    return {
        "metrics": metrics,
        "ranking": rank_runs(metrics),
        "delta": delta,
        "lines": comparison_lines(delta),
    }


def approach_report(
    metrics: DataFrame,
    staged: str,
    direct: str,
    optimized: str | None = None,
    title: str = "Pipeline Comparison",
    facts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Report lines of a run table: title, result table, findings, numbered recommendations."""
    runs = metrics
    parts = [
        metric_table(runs, 1),
        finding_lines(cost_efficiency(runs, staged, direct, optimized), 2),
        recommendation_lines(recommend(runs, staged, direct, optimized), 3),
    ]
    lines = title_lines(metrics.sparkSession, title, facts or {})
    for part in parts:
        lines = lines.unionByName(part)
    return lines


def cost_report(interactions: DataFrame, whole_path: bool = True) -> dict[str, DataFrame]:
    """Per-file costs, totals, phases and advice for recorded interactions."""
    costs = cassette_costs(calls_with_usage(interactions))
    matched = phase_join(costs, whole_path=whole_path)
    phases = phase_costs(matched)
    return {
        "files": costs,
        "summary": cost_summary(cassette_filter(costs)),
        "phases": phases,
        "phase_files": phase_files(matched),
        "phase_total": phase_total(phases),
        "recommendations": cost_recommendations(phases),
    }


def changelog(
    prs: DataFrame,
    month: str | None = None,
    year: int | None = None,
    rules: Rules = SERVICE_RULES,
    sub_rules: Rules | None = None,
    internal_hidden: bool = True,
) -> DataFrame:
    """Pull requests to changelog pieces: of one month, or of every month if ``prs`` has ``month`` and ``year``.

    One rule set names every theme once, so there is nothing to merge here (``merge_themes`` is for themes
    that were named apart).
    """
    visible = customer_facing(categorize(prs)).drop("category", "service") if internal_hidden else prs
    return render_changelog(themed_rows(visible, rules, sub_rules=sub_rules or {}), month, year)
