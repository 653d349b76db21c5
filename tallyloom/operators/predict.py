"""Turn text into typed, validated predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import Metric
from .metrics import evaluator_summary, require_budget
from .splits import take_first

ERROR = "struct<message:string,type:string,timestamp:timestamp>"
EMPTY_TEXT = "Text cannot be nil or empty"


def parse_structured_output(df: DataFrame, raw: str, schema: str, name: str = "output") -> DataFrame:
    """Decode the fenced JSON that follows ``## Output values`` to a declared schema.

    Adds ``name`` (struct) and ``<name>_corrupt`` (the JSON text when it does not parse, the whole
    answer when it has no such block).
    """
    pattern = r"(?s)## Output values\s*```json\s*(.*?)\s*```"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    found = df.withColumn("_block", F.regexp_extract(F.col(raw), pattern, 1))
    parsed = found.withColumn("_typed", F.from_json("_block", f"{schema}, _corrupt string", options))
    missing = F.length("_block") == 0
    usable = ~missing & F.col("_typed._corrupt").isNull()
    return parsed.withColumns(
        {
            name: F.when(usable, F.col("_typed").dropFields("_corrupt")),
            f"{name}_corrupt": F.when(missing, F.col(raw)).otherwise(F.col("_typed._corrupt")),
        }
    ).drop("_block", "_typed")


def validate_predictions(
    df: DataFrame,
    raw: str = "output_json",
    text: str = "text",
    staged: bool = False,
    strict: bool = False,
    at: Column | None = None,
) -> DataFrame:
    """Check raw JSON predictions and replace unusable ones by a conservative row with an error.

    ``has_ade`` must be a JSON boolean, ``confidence`` a number in [0, 1], ``reasoning`` a string
    (direct form) or ``drugs`` and ``effects`` lists (staged form). Blank text is an error of its
    own: it fails the job in strict mode and marks the row otherwise.
    """
    # Parsed once, then read by name: an expensive expression used twice is not inlined again.
    kinds = {"_has": "has_ade", "_sure": "confidence", "_why": "reasoning", "_drugs": "drugs", "_effects": "effects"}
    parsed = df.withColumn("_value", F.try_parse_json(F.col(raw)))
    parsed = parsed.withColumns(
        {n: F.try_variant_get("_value", f"$.{field}", "variant") for n, field in kinds.items()}
    )

    def kind(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(name), F.lit("VOID"))

    def complaint(field: str) -> Column:
        shown = F.coalesce(F.get_json_object(F.col(raw), f"$.{field}"), F.lit("null"))
        return F.concat(F.lit(f"invalid {field}: "), shown)

    confidence = F.try_variant_get("_sure", "$", "double")
    numeric = kind("_sure").rlike("^(BIGINT|DOUBLE|DECIMAL.*)$")
    fine_confidence = numeric & F.coalesce(confidence.between(0.0, 1.0), F.lit(False))
    blank = F.col(text).isNull() | (F.trim(F.col(text)) == "")
    blank_message = F.lit(EMPTY_TEXT)
    if strict:
        blank_message = F.raise_error(blank_message).cast("string")
    message = F.when(blank, blank_message)
    if staged:
        message = message.when(~kind("_drugs").startswith("ARRAY"), complaint("drugs"))
        message = message.when(~kind("_effects").startswith("ARRAY"), complaint("effects"))
    message = message.when(kind("_has") != "BOOLEAN", complaint("has_ade"))
    message = message.when(~fine_confidence, complaint("confidence"))
    if not staged:
        message = message.when(kind("_why") != "STRING", complaint("reasoning"))
    stamp = F.current_timestamp() if at is None else at
    failed = F.col("_message").isNotNull()
    checked = parsed.withColumn("_message", message)
    columns = {
        "has_ade": F.when(failed, F.lit(False)).otherwise(F.try_variant_get("_has", "$", "boolean")),
        "confidence": F.when(failed, F.lit(0.0)).otherwise(confidence),
        "api_calls": F.lit(3 if staged else 1),
        "error": F.when(
            failed,
            F.struct(
                F.col("_message").alias("message"),
                F.when(blank, "blank_text").otherwise("invalid_output").alias("type"),
                stamp.alias("timestamp"),
            ),
        ),
    }
    if staged:
        none = F.array().cast("array<string>")
        for name, field in (("_drugs", "drugs"), ("_effects", "effects")):
            items = F.try_variant_get(name, "$", "array<string>")
            columns[field] = F.when(failed, none).otherwise(items)
    else:
        said = F.try_variant_get("_why", "$", "string")
        columns["reasoning"] = F.when(failed, F.lit("Error occurred during classification")).otherwise(said)
    return checked.withColumns(columns).drop("_value", "_message", *kinds)


def check_domains(
    df: DataFrame,
    key: str,
    members: Mapping[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One row per value outside its enum or range: ``key, field, value, rule``."""
    found = []
    for field, allowed in (members or {}).items():
        c = F.col(field)
        rule = "in " + "|".join(allowed)
        found.append(
            F.when(
                c.isNotNull() & ~c.isin(*allowed),
                F.struct(F.lit(field).alias("field"), c.cast("string").alias("value"), F.lit(rule).alias("rule")),
            )
        )
    for field, (low, high) in (ranges or {}).items():
        c = F.col(field)
        rule = f"between {low} and {high}"
        found.append(
            F.when(
                c.isNotNull() & ~c.between(low, high),
                F.struct(F.lit(field).alias("field"), c.cast("string").alias("value"), F.lit(rule).alias("rule")),
            )
        )
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("_v")).select(key, "_v.*")


Scorer = Callable[[list[str]], list[dict]]
#: Texts scored and sent back at once; a batch of Arrow is cut into pieces of so many.
SCORED_ROWS = 256
#: Types of fields, with Arrow's names, that need no pandas.
PLAIN = {
    "boolean": "bool", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
    "float": "float32", "double": "float64", "string": "string",
}


def score_batch(
    df: DataFrame, build: Callable[[], Scorer], schema: str, key: str = "example_id", text: str = "text"
) -> DataFrame:
    """Run a Python scorer over ``key, text``, ``SCORED_ROWS`` at a time; the scorer is built once per task.

    ``schema`` declares the fields the scorer returns. When a call fails, or does not give one result
    per text, its rows are retried one by one; a failing row gets nulls and its message in
    ``error_message``. A task holds a batch of Arrow and the texts of one call; when a field is not
    ``PLAIN`` or the text is no string, it holds the batch as a pandas frame too.
    """
    fields = T.StructType.fromDDL(schema)
    names, step = [f.name for f in fields], SCORED_ROWS
    out = T.StructType(
        [df.schema[key], df.schema[text], *fields, T.StructField("error_message", T.StringType())]
    )
    kinds = [PLAIN.get(f.dataType.simpleString()) for f in fields]
    safe = df.sparkSession.conf.get("spark.sql.execution.pandas.convertToArrowArraySafely") == "true"

    def calls() -> Callable[[list], list[dict]]:
        scorer = build()

        def scores(values: list[str]) -> list[dict]:
            results = list(scorer(values))
            if len(results) != len(values):
                raise ValueError(f"the scorer gave {len(results)} results for {len(values)} texts")
            return [{**r, "error_message": None} for r in results]

        def one(value: str) -> dict:
            try:
                return scores([value])[0]
            except Exception as failure:  # a bad row must not stop the run
                return {"error_message": str(failure)}

        def call(texts: list[str]) -> list[dict]:
            try:
                return scores(texts)
            except Exception:
                return [one(value) for value in texts]

        return call

    def typed(values: list, kind: str) -> pa.Array:
        to = pa.type_for_alias(kind)
        try:
            return pa.array(values, to, from_pandas=True)
        except pa.ArrowException:  # as 1 for true
            return pa.array(values, from_pandas=True).cast(to, safe=safe)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        call, made = calls(), {**dict(zip(names, kinds)), "error_message": "string"}
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                results = call(rows.column(1).to_pylist())
                scored = [typed([r.get(name) for r in results], kind) for name, kind in made.items()]
                yield pa.RecordBatch.from_arrays([*rows.columns, *scored], [key, text, *made])

    def run_frames(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        call = calls()
        for batch in batches:
            for start in range(0, len(batch), step):
                rows = batch.iloc[start : start + step]
                scored = pd.DataFrame(call(rows[text].tolist()), columns=[*names, "error_message"])
                yield pd.concat([rows[[key, text]].reset_index(drop=True), scored], axis=1)

    texts = df.select(key, text)
    if all(kinds) and df.schema[text].dataType == T.StringType():
        return texts.mapInArrow(run, out)
    return texts.mapInPandas(run_frames, out)


def stage_pipeline(df: DataFrame, stages: Mapping[str, Callable[[], Column]]) -> DataFrame:
    """Chain column stages (each may read the columns before it) and count one call per stage."""
    for name, stage in stages.items():
        df = df.withColumn(name, stage())
    return df.withColumn("api_calls", F.lit(len(stages)))


def evaluate(
    examples: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    metric: Metric,
    sample: int | None = None,
    max_errors: int | None = None,
    key: str = "example_id",
) -> DataFrame:
    """Score examples (``y_true`` present) and attach ``score`` and ``details`` per row."""
    chosen = take_first(examples, sample, key) if sample else examples
    scored = scorer(chosen)
    if max_errors is not None:
        scored = require_budget(scored, max_errors)
    result = metric(F.col("y_true"), F.col("y_pred"), F.col("confidence"))
    return scored.withColumn("_metric", result).select("*", "_metric.score", "_metric.details").drop("_metric")


def evaluate_summary(evaluated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary of evaluated rows; a row passes with a full score."""
    return evaluator_summary(evaluated.withColumn("passed", F.col("score") == 1.0), by, passed="passed")
