import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import costs
from tallyloom.plans import flows
from tallyloom.sources import readers

from .conftest import collected

URI = "https://api.openai.com/v1/chat/completions"


def usage(i, o, total=None):
    body = {"id": "x", "usage": {"prompt_tokens": i, "completion_tokens": o, "total_tokens": total or i + o}}
    return json.dumps(body)


def recorded(rows):
    data = [
        ("ade_reproducibility/token_usage.yml", 0, "post", URI, None, 200, usage(1000, 500), "t"),
        ("ade_reproducibility/token_usage.yml", 1, "post", URI, None, 200, usage(729, 75), "t"),
        ("ade_reproducibility/optimization.yml", 0, "post", URI, None, 200, usage(100, 50), "t"),
        ("dataset_loader/list.yml", 0, "get", "https://datasets.example/list", None, 200, "{}", "t"),
        ("dataset_loader/list.yml", 1, "post", URI, None, 200, "not json", "t"),
        ("dataset_loader/list.yml", 2, "post", URI, None, 200, json.dumps({"id": 1}), "t"),
        ("drug_extractor.yml", 0, "post", URI, None, 200, usage(10, 10), "t"),
    ]
    return rows(data, readers.INTERACTION_SCHEMA)


def test_only_priced_calls_count(rows):
    assert costs.calls_with_usage(recorded(rows)).count() == 4


def test_report(rows):
    out = flows.cost_report(recorded(rows))
    files = {r["cassette"]: r for r in out["files"].collect()}
    usage_file = files["ade_reproducibility/token_usage.yml"]
    assert usage_file["total_cost"] == Decimal("0.000604") and usage_file["cost_per_request"] == Decimal("0.000302")
    summary = out["summary"].first()
    # drug_extractor is outside the path filter
    assert (summary["cassettes_analyzed"], summary["requests"], summary["total_tokens"]) == (2, 3, 2454)
    assert summary["total_cost"] == Decimal("0.000649")
    assert summary["avg_tokens_per_request"] == 818.0
    phases = {r["phase"]: r for r in out["phases"].collect()}
    assert phases["optimization"]["requests"] == 1 and phases["optimization"]["total_cost"] == Decimal("0.000045")
    assert phases["reproducibility"]["n_files"] == 2
    lines = collected(out["recommendations"], "rule_no")
    assert lines == [(4, "spent in all: $0.0007")]


def test_literal_phase_patterns_stay_in_the_file_name(rows):
    out = flows.cost_report(recorded(rows), whole_path=False)
    phases = {r["phase"]: r["n_files"] for r in out["phases"].collect()}
    assert {p for p, n in phases.items() if n} == {"optimization"} and len(phases) == 4
    assert {r["phase"] for r in out["phase_files"].collect()} == {"optimization"}
    assert out["phase_total"].first()["n_files"] == phases["optimization"]


def test_file_filter(rows):
    paths = rows([("dataset_loader/x.yml",), ("drug_extractor.yml",), ("a/BASELINE/y.yml",)], "cassette string")
    assert {r[0] for r in costs.cassette_filter(paths).collect()} == {"dataset_loader/x.yml", "a/BASELINE/y.yml"}


def test_golden_totals(rows):
    """Token sums of the published recordings give the published cost figures."""
    costs_df = rows(
        [("all", 90211, 8244, 98455, 139, Decimal("0.018476"), Decimal("0.000133"))],
        "cassette string, input_tokens long, output_tokens long, total_tokens long, requests long, total_cost decimal(20,6), cost_per_request decimal(20,6)",
    )
    got = costs.cost_summary(costs_df).first()
    assert (got["input_cost"], got["output_cost"]) == (0.013532, 0.004946)
    assert (got["avg_tokens_per_request"], got["cost_per_1k_tokens"]) == (708.3, 0.000188)


def test_all_advice_lines(rows):
    phases = rows(
        [("optimization", Decimal("0.110000"), 5, 1, Decimal("0.022000")), ("reproducibility", Decimal("0.010000"), 21, 1, Decimal("0.000500"))],
        "phase string, total_cost decimal(20,6), requests long, n_files long, cost_per_request decimal(20,6)",
    )
    lines = [r["line"] for r in costs.cost_recommendations(phases).orderBy("rule_no").collect()]
    assert lines[0] == "high spending ($0.12): develop on a smaller sample" and len(lines) == 4


CALLS = "id long, predictor string, epoch int, input_tokens long, output_tokens long, total_tokens long"


def test_ledger(rows):
    calls = rows([(1, "p", 0, 100, 50, 150), (2, "p", 0, 200, 75, None), (3, "p", 1, 1000, 500, 1500)], CALLS)
    got = {r["epoch"]: r for r in costs.usage_ledger(calls, ["predictor", "epoch"]).collect()}
    assert got[0]["token_total"] == 425 and got[0]["request_total"] == 2
    assert got[1]["cost_total"] == pytest.approx(0.00045)
    running = costs.usage_ledger(calls, ["predictor"], order="id").orderBy("id").collect()
    assert [r["input_total"] for r in running] == [100, 300, 1300]
    assert [r["request_total"] for r in running] == [1, 2, 3]


def test_modules(rows):
    events = rows([("a", 1, 2), (None, 3, None), ("a", None, 5)], "module string, tokens_input long, tokens_output long")
    assert collected(costs.tokens_by_module(events), "module") == [("a", 1, 7), ("unknown", 3, 0)]


def test_estimates(rows):
    got = costs.optimizer_cost_estimate(rows([("few_shot",), ("bootstrap",), ("x",)], "optimizer string")).collect()
    assert [(r["estimated_api_calls"], r["estimated_cost"]) for r in got] == [(50, 0.1), (150, 0.3), (None, 0.0)]
    price = lambda c, n: rows([(c, n)], "c double, n long").select(costs.cost_per_example(F.col("c"), F.col("n"))).first()[0]
    assert price(0.3, 7) == 0.042857 and price(0.0, 7) == 0.0 and price(0.5, 0) == 0.5
