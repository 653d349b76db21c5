import pytest
from pyspark.sql import functions as F

from tallyloom.functions import pricing, ratios, scoring, status, text, units


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "hits, trials, lo, hi",
    [
        (8, 11, 0.4343497069897537, 0.9025411942607853),
        (22, 25, 0.7004380781662651, 0.9583325864293191),
        (8, 8, 0.6755843804891231, 1.0),
        (14, 17, 0.5897007098262422, 0.9380898628745101),
        (0, 0, 0.0, 0.0),
    ],
)
def test_wilson(spark, hits, trials, lo, hi):
    got = one(spark, ratios.wilson(F.lit(hits), F.lit(trials)))
    assert got["lo"] == pytest.approx(lo, abs=1e-12) and got["hi"] == pytest.approx(hi, abs=1e-12)


def test_wilson_99_is_wider(spark):
    narrow, wide = one(spark, ratios.wilson(F.lit(22), F.lit(25))), one(spark, ratios.wilson(F.lit(22), F.lit(25), 0.99))
    assert wide["lo"] < narrow["lo"] and wide["hi"] > narrow["hi"]


def test_ratios(spark):
    assert one(spark, ratios.safe_ratio(F.lit(5), F.lit(7))) == pytest.approx(0.714, abs=1e-3)
    assert one(spark, ratios.safe_ratio(F.lit(5), F.lit(8))) == 0.625
    assert one(spark, ratios.safe_ratio(F.lit(0), F.lit(0))) == 0.0
    assert one(spark, ratios.f1_score(F.lit(0.8), F.lit(0.6))) == pytest.approx(0.686, abs=1e-3)
    assert one(spark, ratios.f1_score(F.lit(0.0), F.lit(0.5))) == 0.0


@pytest.mark.parametrize(
    "cells, mcc",
    [((8, 3, 14, 0), 0.773905989951895), ((8, 5, 12, 0), 0.6590820436573077), ((6, 5, 9, 0), 0.5921565254637922), ((0, 0, 5, 0), 0.0)],
)
def test_matthews(spark, cells, mcc):
    assert one(spark, ratios.matthews(*map(F.lit, cells))) == pytest.approx(mcc, abs=1e-12)


def test_matthews_does_not_overflow(spark):
    big = 3 * 10**12
    assert one(spark, ratios.matthews(*[F.lit(big)] * 4)) == 0.0


def test_rounding_and_grades(spark):
    assert one(spark, ratios.pct_round(F.lit(0.8421))) == 84.2
    assert one(spark, ratios.pct_round(F.lit(0.125), 1)) == 12.5
    assert one(spark, ratios.round_half_away(F.lit(-2.5), 0)) == -3.0
    assert one(spark, ratios.grade_band(F.lit(0.85), F.lit(0.1))) == "excellent"
    assert one(spark, ratios.grade_band(F.lit(0.85), F.lit(0.3))) == "good"
    assert one(spark, ratios.grade_band(F.lit(0.65))) == "needs_improvement"
    assert one(spark, ratios.grade_band(F.lit(0.6))) == "poor"
    assert one(spark, ratios.miss_rate_band(F.lit(0.15))) == "moderate"
    assert one(spark, ratios.quality_warnings(F.lit(0.6), F.lit(0.9))) == ["low precision"]


def test_medication_scan(spark):
    scan = lambda s, **k: one(spark, text.extract_medications(F.lit(s), **k))
    assert scan("Took Aspirin and ibuprofen, then ASPIRIN.") == ["aspirin", "ibuprofen"]
    assert scan("aspirinlike éaspirin aspirin_x") == []
    assert scan(None) == []
    assert scan("aspirin and warfarin", seed=F.lit("warfarin")) == ["warfarin", "aspirin"]
    assert scan("aspirin", seed=F.lit("Aspirin")) == ["Aspirin", "aspirin"]
    assert scan("aspirin", seed=F.lit(None).cast("string")) == ["aspirin"]


def test_symptom_scan_keeps_spellings_apart(spark):
    assert one(spark, text.extract_symptoms(F.lit("Rash, rash, rash and fever"))) == "rash, rash, fever"
    assert one(spark, text.extract_symptoms(F.lit("nothing"))) == ""
    assert one(spark, text.extract_symptoms(F.lit("fever"), seed=F.lit("cough"))) == "cough, fever"


def test_pairs(spark):
    meds = F.array(F.lit("a"), F.lit("b"))
    got = one(spark, text.drug_symptom_pairs(meds, F.lit("rash, fever")))
    assert [(p["drug"], p["symptom"]) for p in got] == [("a", "rash"), ("b", "rash")]
    assert one(spark, text.drug_symptom_pairs(meds, F.lit(""))) == []
    assert one(spark, text.drug_symptom_pairs(F.array().cast("array<string>"), F.lit("rash"))) == []


def test_snippets_and_tokens(spark):
    assert one(spark, text.snippet(F.lit("x" * 300), 200)) == "x" * 201
    assert one(spark, text.snippet(F.lit("x" * 101), 100, "...")) == "x" * 101 + "..."
    assert one(spark, text.snippet(F.lit("x" * 100), 100, "...")) == "x" * 100
    assert one(spark, text.approx_tokens(F.lit("12345"))) == 2
    assert one(spark, text.approx_tokens(F.lit(None).cast("string"))) == 0


def test_redaction_leaves_no_tail(spark):
    got = one(spark, text.redact_secrets(F.lit("a sk-ant-abc123 b sk-xyz789 c")))
    assert got == "a <ANTHROPIC_API_KEY> b <OPENAI_API_KEY> c"
    headers = F.create_map(F.lit("Authorization"), F.array(F.lit("Bearer sk-1")), F.lit("Host"), F.array(F.lit("h")))
    assert one(spark, text.redact_authorization(headers)) == {"Authorization": ["Bearer <REDACTED>"], "Host": ["h"]}


def test_statuses(spark):
    parse = lambda s: one(spark, status.parse_status(F.lit(s).cast("string")))
    assert [parse(s) for s in ("NoADE", "Mild", "SEVERE_ADVERSE_EVENT", "odd", None)] == [
        "no_adverse_event", "mild_adverse_event", "severe_adverse_event", "no_adverse_event", "no_adverse_event",
    ]
    assert [one(spark, status.label_to_bool(F.lit(v).cast("int"))) for v in (1, 0, 2, None)] == [True, False, False, False]
    assert [one(spark, status.label_to_status(F.lit(v).cast("int"))) for v in (0, 1, 7)] == [
        "no_adverse_event", "mild_adverse_event", "no_adverse_event",
    ]


def test_parse_pairs(spark):
    got = one(spark, status.parse_pairs(F.lit('[{"drug": "a", "symptom": "b"}, {"drug": "c"}, "x", 3, null]')))
    assert [(p["drug"], p["symptom"]) for p in got] == [("a", "b"), ("c", "")]
    assert one(spark, status.parse_pairs(F.lit(None).cast("string"))) == []
    assert one(spark, status.parse_pairs(F.lit("broken"))) == []


def test_format_prediction(spark):
    none = F.lit(None).cast(status.PAIRS)
    form = lambda s, c: one(spark, status.format_prediction(F.lit(s).cast("string"), F.lit(c).cast("double"), none))
    assert form("mild", 1.7)["confidence"] == 1.0 and form("mild", -1)["confidence"] == 0.0
    assert form(None, None)["confidence"] == 0.8 and form(None, None)["ade_status"] == "no_adverse_event"
    assert form("mild", 0.5)["drug_symptom_pairs"] == []


def test_costs(spark):
    cost = lambda i, o: float(one(spark, pricing.request_cost(F.lit(i), F.lit(o))))
    assert cost(1000, 500) == pytest.approx(0.00045, abs=1e-12)
    assert cost(729, 75) == pytest.approx(729 / 1000 * 0.00015 + 75 / 1000 * 0.0006, abs=1e-12)
    usage = one(spark, pricing.usage_tokens(F.lit('{"prompt_tokens": 100, "completion_tokens": 50}')))
    assert tuple(usage) == (100, 50, 150)
    usage = one(spark, pricing.usage_tokens(F.lit('{"prompt_tokens": 200, "completion_tokens": 75, "total_tokens": 280}')))
    assert tuple(usage) == (200, 75, 280)


@pytest.mark.parametrize(
    "value, a, b, wanted",
    [
        (10, "meters", "feet", 32.8084),
        (32.8084, "feet", "Meters", 10.0),
        (100, "celsius", "fahrenheit", 212.0),
        (212, "fahrenheit", "celsius", 100.0),
        (1, "miles", "km", 1.6093),
        (1, "km", "miles", 0.6214),
        (1, "miles", "kilometers", 1.6093),
        (1, "kilometers", "miles", 0.6214),
        (2, "KG", "pounds", 4.4092),
        (1, "pounds", "kg", 0.4536),
        (2, "kilograms", "pounds", 4.4092),
        (1, "pounds", "kilograms", 0.4536),
    ],
)
def test_units(spark, value, a, b, wanted):
    got = one(spark, units.convert_units(F.lit(value), F.lit(a), F.lit(b)))
    assert got["converted"] == wanted and got["error"] is None


def test_unknown_unit(spark):
    got = one(spark, units.convert_units(F.lit(1), F.lit("stone"), F.lit("kg")))
    assert got["converted"] is None and got["error"] == "Error: Conversion from stone to kg not supported"


def test_stamps(spark):
    at = F.lit("2025-08-12 12:40:14").cast("timestamp_ntz")
    assert one(spark, units.iso_stamp(at)) == "2025-08-12T12:40:14Z"
    assert one(spark, units.file_stamp(at)) == "20250812_124014"
    assert one(spark, units.iso_stamp(units.from_epoch(F.lit(1_700_000_000)))) == "2023-11-14T22:13:20Z"


def test_row_metrics(spark):
    score = lambda m, t, p, c=None: one(spark, m(F.lit(t), F.lit(p).cast("boolean"), F.lit(c).cast("double")))
    safety = scoring.metric_safety
    assert [score(safety, t, p)["score"] for t, p in ((True, False), (False, True), (True, True), (False, False))] == [0.0, 0.3, 1.0, 1.0]
    assert score(safety, True, None)["details"]["type"] == "false_negative"
    assert score(scoring.metric_balanced, True, True)["score"] == 1.0
    aware = scoring.metric_confidence_aware()
    assert [score(aware, True, True, c)["score"] for c in (0.6, 0.7, None)] == [0.5, 1.0, 1.0]
    assert score(aware, True, False, 0.9)["score"] == 0.0
    assert score(scoring.metric_comprehensive, True, True)["details"]["confidence"] == 0.5


def test_status_threshold(spark):
    metric = scoring.metric_status_threshold(0.7)
    ok = lambda e, p, c: one(spark, metric(F.lit(e), F.lit(p).cast("string"), F.lit(c).cast("double")))
    assert ok("a", "a", 0.9) and ok("a", "a", 0.7)
    assert not ok("a", "a", 0.5) and not ok("a", "b", 0.9) and not ok("a", None, 0.9) and not ok("a", "a", None)
