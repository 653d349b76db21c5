"""Predictions: parsing, validation, scoring, replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import scoring, status
from tallyloom.functions.text import extract_medications, extract_symptoms, has_word
from tallyloom.operators import predict
from tallyloom.operators.joins import replay_responses

from .base import query, table, tidy, word_count_sql
from .inputs import MEDS, MEDS_SQL, SYMS, SYMS_SQL

PERCENT = "(event_id % 130)"


def _confidence_text():
    """0.00 to 1.29 as it stands in the JSON."""
    percent = F.col("event_id") % 130
    return F.concat(
        F.floor(percent / 100).cast("string"), F.lit("."), F.lpad((percent % 100).cast("string"), 2, "0")
    )


@query(
    "format_prediction",
    f"""SELECT event_id, CASE event_type WHEN 'error' THEN 'severe_adverse_event' WHEN 'click' THEN 'mild_adverse_event' ELSE 'no_adverse_event' END AS ade_status,
      round(CASE WHEN event_type = 'view' THEN 0.8::DOUBLE ELSE least(1, greatest(0, value / 100 - 0.2::DOUBLE)) END, 6) AS confidence, 0::BIGINT AS n_pairs FROM events""",
)
def format_prediction(spark, sf):
    kind = F.col("event_type")
    said = F.when(kind == "error", "severe").when(kind == "click", "Mild").when(kind == "view", "none")
    sure = F.when(kind != "view", F.col("value") / 100 - 0.2)
    made = status.format_prediction(said, sure, F.lit(None).cast(status.PAIRS))
    rows = table(spark, sf, "events").select("event_id", made.alias("p"))
    return tidy(rows.select("event_id", "p.ade_status", "p.confidence", F.size("p.drug_symptom_pairs").alias("n_pairs")))


@query(
    "parse_pairs",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN user_id || '>'
      ELSE user_id || '>' || event_type || ';>' || event_type END AS pairs FROM events""",
)
def parse_pairs(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    raw = (
        F.when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "click", F.concat(F.lit('[{"drug": "'), user, F.lit('"}, "loose", 3, null]')))
        .otherwise(
            F.concat(
                F.lit('[{"drug": "'), user, F.lit('", "symptom": "'), kind, F.lit('"}, [1], {"symptom": "'), kind, F.lit('"}]')
            )
        )
    )
    shown = F.transform(status.parse_pairs(raw), lambda p: F.concat(p["drug"], F.lit(">"), p["symptom"]))
    return table(spark, sf, "events").select("event_id", F.array_join(shown, ";").alias("pairs"))


def raw_predictions(spark, sf):
    """JSON answers: some with a text for the boolean, confidence above 1, a missing reason or no JSON."""
    kind = F.col("event_type")
    answer = F.concat(
        F.lit('{"has_ade": '),
        F.when(kind == "click", '"yes"').when(kind == "view", "false").otherwise("true"),
        F.lit(', "confidence": '),
        _confidence_text(),
        F.when(kind == "signup", "").otherwise(', "reasoning": "because"'),
        F.lit("}"),
    )
    raw = F.when(F.col("event_id") % 17 == 0, F.lit("no JSON at all")).otherwise(answer)
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 19 == 0, "  ").otherwise(kind).alias("text"), raw.alias("output_json")
    )


@query(
    "validate_predictions",
    f"""WITH r AS (SELECT event_id, event_type, {PERCENT} AS pc, (event_id % 130 / 100.0::DOUBLE)::VARCHAR AS shown FROM events),
    m AS (SELECT event_id, event_type, pc, CASE WHEN event_id % 19 = 0 THEN 'Text cannot be nil or empty'
      WHEN event_id % 17 = 0 THEN 'invalid has_ade: null' WHEN event_type = 'click' THEN 'invalid has_ade: yes'
      WHEN pc > 100 THEN 'invalid confidence: ' || shown WHEN event_type = 'signup' THEN 'invalid reasoning: null' END AS message FROM r)
    SELECT event_id, message IS NULL AND event_type <> 'view' AS has_ade,
      CASE WHEN message IS NULL THEN round(pc / 100.0::DOUBLE, 6) ELSE 0 END AS confidence,
      CASE WHEN message IS NULL THEN 'because' ELSE 'Error occurred during classification' END AS reasoning,
      1::BIGINT AS api_calls, message FROM m""",
)
def validate_predictions(spark, sf):
    checked = predict.validate_predictions(raw_predictions(spark, sf))
    return tidy(checked.select("event_id", "has_ade", "confidence", "reasoning", "api_calls", F.col("error.message").alias("message")))


@query(
    "validate_staged_predictions",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'invalid drugs: none' WHEN 'view' THEN 'invalid effects: null' END AS message,
      event_type NOT IN ('click', 'view') AS has_ade, CASE WHEN event_type IN ('click', 'view') THEN '' ELSE user_id::VARCHAR || ',b' END AS drugs,
      3::BIGINT AS api_calls FROM events""",
)
def validate_staged_predictions(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    drugs = F.when(kind == "click", '"none"').otherwise(F.concat(F.lit('["'), user, F.lit('", "b"]')))
    effects = F.when(kind == "view", "").otherwise(', "effects": ["c"]')
    raw = F.concat(F.lit('{"has_ade": true, "confidence": 1, "drugs": '), drugs, effects, F.lit("}"))
    rows = table(spark, sf, "events").select("event_id", kind.alias("text"), raw.alias("output_json"))
    checked = predict.validate_predictions(rows, staged=True)
    return tidy(
        checked.select(
            "event_id", F.col("error.message").alias("message"), "has_ade",
            F.array_join("drugs", ",").alias("drugs"), "api_calls",
        )
    )


@query(
    "parse_structured_output",
    """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN event_type END AS category,
      CASE WHEN event_type NOT IN ('view', 'click') THEN user_id END AS score,
      CASE WHEN event_type NOT IN ('view', 'click') THEN 'm' || user_id END AS first_milestone,
      event_type IN ('view', 'click') AS corrupt FROM events""",
)
def parse_structured_output(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    answer = F.concat(
        F.lit('thinking\n## Output values\n```json\n{"category": "'), kind, F.lit('", "score": '), user,
        F.lit(', "milestones": [{"name": "m'), user, F.lit('", "due_weeks": 2, "dependencies": ["a"]}]}\n```\nend'),
    )
    raw = F.when(kind == "view", "no block").when(kind == "click", F.translate(answer, "}", "")).otherwise(answer)
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    schema = (
        "category string, score bigint, "
        "milestones array<struct<name:string,due_weeks:int,dependencies:array<string>>>"
    )
    out = predict.parse_structured_output(rows, "raw", schema)
    return out.select(
        "event_id", "output.category", "output.score",
        F.col("output.milestones")[0]["name"].alias("first_milestone"),
        F.col("output_corrupt").isNotNull().alias("corrupt"),
    )


@query(
    "check_domains",
    """SELECT event_id, 'event_type' AS field, event_type AS value, 'in click|view|signup' AS rule FROM events WHERE event_type NOT IN ('click', 'view', 'signup')
    UNION ALL SELECT event_id, 'user_id', user_id::VARCHAR, 'between 1 and 100' FROM events WHERE user_id NOT BETWEEN 1 AND 100""",
)
def check_domains(spark, sf):
    return predict.check_domains(
        table(spark, sf, "events"), "event_id", {"event_type": ("click", "view", "signup")}, {"user_id": (1, 100)}
    )


# --- scoring ---------------------------------------------------------------------------------
# A text is positive when it has at least three of the listed words; the Python scorer and the
# column rule give the same answer.

WORDS = ("the", "der", "la", "de", "of")
WORDS_SQL = f"{word_count_sql('text', WORDS)}"


@query(
    "score_batch",
    f"""WITH c AS (SELECT doc_id, {WORDS_SQL} AS hits FROM documents)
    SELECT doc_id, hits >= 3 AS y_pred, round(least(1, hits / 10.0::DOUBLE), 6) AS confidence, hits FROM c""",
)
def score_batch(spark, sf):
    words = WORDS

    # A closure, so that tasks receive it by value and need not import this package.
    def build():
        import re

        token, wanted = re.compile(r"\w+"), frozenset(words)

        def score(texts: list[str]) -> list[dict]:
            counts = [sum(t.lower() in wanted for t in token.findall(text)) for text in texts]
            return [{"y_pred": n >= 3, "confidence": min(1.0, n / 10), "hits": n} for n in counts]

        return score

    documents = table(spark, sf, "documents")
    scored = predict.score_batch(
        documents, build, "y_pred boolean, confidence double, hits bigint", "doc_id", "text"
    )
    return tidy(scored.select("doc_id", "y_pred", "confidence", "hits"))


@query(
    "stage_pipeline",
    f"""WITH s AS (SELECT doc_id, {MEDS_SQL} AS drugs, {SYMS_SQL} AS effects FROM documents)
    SELECT doc_id, drugs, effects, drugs <> '' AND effects <> '' AS has_ade, 3::BIGINT AS api_calls FROM s""",
)
def stage_pipeline(spark, sf):
    stages = {
        "drugs": lambda: extract_medications(F.col("text"), MEDS),
        "effects": lambda: extract_symptoms(F.col("text"), SYMS),
        "has_ade": lambda: (F.size("drugs") > 0) & (F.col("effects") != ""),
    }
    out = predict.stage_pipeline(table(spark, sf, "documents"), stages)
    return tidy(out.select("doc_id", F.array_join("drugs", ",").alias("drugs"), "effects", "has_ade", "api_calls"))


def _word_scorer(df):
    return df.withColumns({"y_pred": has_word(F.col("text"), ("the", "and")), "confidence": F.lit(0.9)})


@query(
    "evaluate",
    f"""WITH s AS (SELECT toxic = 1 AS t, {word_count_sql('text', ('the', 'and'))} > 0 AS p FROM documents JOIN labels USING (doc_id))
    SELECT count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (NOT t AND NOT p) AS tn,
      count(*) FILTER (t AND NOT p) AS fn, round(avg((t = p)::INT), 6) AS pass_rate, 0.9::DOUBLE AS average_confidence FROM s""",
)
def evaluate(spark, sf):
    examples = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    examples = examples.select(F.col("doc_id").alias("example_id"), "text", (F.col("toxic") == 1).alias("y_true"))
    rows = predict.evaluate(examples, _word_scorer, scoring.metric_comprehensive)
    summary = predict.evaluate_summary(rows)
    return tidy(summary.select("tp", "fp", "tn", "fn", "pass_rate", "average_confidence"))


@query(
    "evaluate_sample",
    f"""WITH x AS (SELECT doc_id, text, toxic = 1 AS t FROM documents JOIN labels USING (doc_id) ORDER BY md5(doc_id || '|42'), doc_id LIMIT 100)
    SELECT doc_id AS example_id, (t = ({word_count_sql('text', ('the', 'and'))} > 0))::INT::DOUBLE AS score FROM x""",
)
def evaluate_sample(spark, sf):
    examples = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    examples = examples.select(F.col("doc_id").alias("example_id"), "text", (F.col("toxic") == 1).alias("y_true"))
    rows = predict.evaluate(examples, _word_scorer, scoring.metric_comprehensive, sample=100)
    return tidy(rows.select("example_id", "score"))


@query(
    "replay_responses",
    """WITH r AS (SELECT text, min(doc_id) AS doc_id FROM documents WHERE lang <> 'es' GROUP BY text)
    SELECT d.doc_id, 'answer ' || r.doc_id AS response_body, CASE WHEN r.doc_id IS NULL THEN 'no recorded response' END AS error
    FROM documents d LEFT JOIN r ON r.text = d.text""",
)
def replay(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", "lang", F.lit("post").alias("method"), F.lit("https://api.openai.com/v1/chat").alias("uri"),
        F.col("text").alias("request_body"),
    )
    recorded = documents.filter(F.col("lang") != "es").withColumns(
        {
            "recorded_at": F.col("doc_id"),
            "response_body": F.concat(F.lit("answer "), F.col("doc_id").cast("string")),
        }
    )
    return replay_responses(documents, recorded).select("doc_id", "response_body", "error")
