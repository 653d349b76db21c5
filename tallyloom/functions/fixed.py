"""Fixed values that results depend on, stated once."""

# Word lists of the medication and symptom scans.
MEDICATIONS = ("aspirin", "ibuprofen", "penicillin", "acetaminophen", "warfarin")
SYMPTOMS = ("headache", "nausea", "dizziness", "rash", "vomiting", "fatigue", "fever")

# Status domain and the accepted spellings of each status.
NO_EVENT = "no_adverse_event"
MILD_EVENT = "mild_adverse_event"
SEVERE_EVENT = "severe_adverse_event"
STATUS_SPELLINGS = {
    NO_EVENT: ("no_adverse_event", "noade", "none", "no"),
    MILD_EVENT: ("mild_adverse_event", "mildade", "mild"),
    SEVERE_EVENT: ("severe_adverse_event", "severeade", "severe"),
}

# Column names accepted for each field of a raw example, first non-null wins.
FIELD_ALIASES = {
    "text": ("text", "sentence", "content"),
    "label": ("label", "ade_label"),
    "drug": ("drug", "medication"),
    "effect": ("effect", "symptom", "adverse_effect"),
}

# Dollars per 1,000 tokens, and the flat per-call estimates.
INPUT_PRICE_PER_1K = "0.00015"
OUTPUT_PRICE_PER_1K = "0.0006"
FLAT_COST_PER_CALL = "0.00015"
OPTIMIZER_COST_PER_CALL = 0.002
OPTIMIZER_CALLS = {
    "few_shot": (50, "Few-shot optimization"),
    "bootstrap": (150, "Bootstrap optimization with candidates"),
}

# Normal quantiles of the 95 % and the 99 % interval.
Z_95 = 1.96
Z_99 = 2.576

# Unit conversions as (multiplier, divisor, offset before, offset after),
# result = (value + before) * multiplier / divisor + after.
UNIT_CONVERSIONS = {
    ("meters", "feet"): (3.28084, 1.0, 0.0, 0.0),
    ("feet", "meters"): (1.0, 3.28084, 0.0, 0.0),
    ("miles", "km"): (1.60934, 1.0, 0.0, 0.0),
    ("km", "miles"): (1.0, 1.60934, 0.0, 0.0),
    ("miles", "kilometers"): (1.60934, 1.0, 0.0, 0.0),
    ("kilometers", "miles"): (1.0, 1.60934, 0.0, 0.0),
    ("celsius", "fahrenheit"): (9.0, 5.0, 0.0, 32.0),
    ("fahrenheit", "celsius"): (5.0, 9.0, -32.0, 0.0),
    ("kg", "pounds"): (2.20462, 1.0, 0.0, 0.0),
    ("pounds", "kg"): (1.0, 2.20462, 0.0, 0.0),
    ("kilograms", "pounds"): (2.20462, 1.0, 0.0, 0.0),
    ("pounds", "kilograms"): (1.0, 2.20462, 0.0, 0.0),
}

# Pull-request categories and services.
CATEGORIES = (
    "customer_facing_available",
    "customer_facing_not_released",
    "bug_fix_maintenance",
    "internal_improvement",
)
SERVICES = (
    "Managed PostgreSQL",
    "GitHub Runners",
    "Ubicloud Kubernetes",
    "AI & GPUs",
    "Compute",
    "Load Balancers",
    "Platform Improvements",
    "Developer Experience",
    "Other",
)

# Recorded files that belong to the cost analysis, the address of priced calls,
# and the path patterns of each phase.
COSTED_FILES = "(?i)ade|baseline|optimization"
PRICED_HOST = "api.openai.com"
PHASE_PATTERNS = {
    "baseline": ("baseline_predictor", "debug_empty_input"),
    "optimization": ("ade_reproducibility/optimization",),
    "integration": ("ade_pipeline_integration",),
    "reproducibility": ("ade_reproducibility",),
}
