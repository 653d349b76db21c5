"""Registry of runnable queries and the stand-in tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, the SQL with the same result."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as long, doubles and decimals rounded: the form the check SQL returns."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


# --- scored rows over labels and documents: three runs, y_true = toxic -----------------------

def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    labels, documents = table(spark, sf, "labels"), table(spark, sf, "documents")
    runs = F.explode(
        F.array(
            F.struct(F.lit("long").alias("run_id"), (F.col("n_chars") >= 2000).alias("y_pred")),
            F.struct(F.lit("quality").alias("run_id"), (F.col("quality") == 0).alias("y_pred")),
            F.struct(F.lit("short").alias("run_id"), (F.col("n_chars") < 800).alias("y_pred")),
        )
    )
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("example_id"),
        (F.col("toxic") == 1).alias("y_true"),
        F.least(F.lit(1.0), F.col("n_chars") / F.lit(4000.0)).alias("confidence"),
        "text",
        "n_chars",
        "quality",
        runs.alias("_run"),
    ).select("_run.*", "example_id", "y_true", "confidence", "text", "n_chars", "quality")


SCORED_SQL = """scored AS (
  SELECT r.run_id, l.doc_id AS example_id, l.toxic = 1 AS y_true,
    CASE r.run_id WHEN 'long' THEN d.n_chars >= 2000 WHEN 'short' THEN d.n_chars < 800
      ELSE l.quality = 0 END AS y_pred,
    least(1.0::DOUBLE, d.n_chars::DOUBLE / 4000.0::DOUBLE) AS confidence, d.text, d.n_chars, l.quality
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id,
    (VALUES ('long'), ('quality'), ('short')) r(run_id))"""


# --- scored rows over line items: three runs, y_true = returned ------------------------------

def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    runs = F.explode(
        F.array(
            F.struct(F.lit("discount").alias("run_id"), (F.col("l_discount") > 0.05).alias("y_pred")),
            F.struct(F.lit("open").alias("run_id"), (F.col("l_linestatus") == "O").alias("y_pred")),
            F.struct(F.lit("quantity").alias("run_id"), (F.col("l_quantity") > 30).alias("y_pred")),
        )
    )
    return lines.select(
        (F.col("l_returnflag") == "R").alias("y_true"),
        (F.col("l_quantity") / 50.0).alias("confidence"),
        F.col("l_linenumber").alias("api_calls"),
        (F.col("l_tax") * 10).alias("latency_s"),
        F.when(F.col("l_tax") == 0.08, F.lit("failed")).alias("error"),
        runs.alias("_run"),
    ).select("_run.*", "y_true", "confidence", "api_calls", "latency_s", "error")


LINES_SQL = """scored AS (
  SELECT r.run_id, l_returnflag = 'R' AS y_true,
    CASE r.run_id WHEN 'discount' THEN l_discount > 0.05::DOUBLE WHEN 'open' THEN l_linestatus = 'O'
      ELSE l_quantity > 30 END AS y_pred,
    l_quantity / 50.0::DOUBLE AS confidence, l_linenumber AS api_calls, l_tax * 10 AS latency_s,
    CASE WHEN l_tax = 0.08::DOUBLE THEN 'failed' END AS error
  FROM lineitem, (VALUES ('discount'), ('open'), ('quantity')) r(run_id))"""

CELLS_SQL = """cells AS (
  SELECT run_id, count(*) FILTER (y_true AND y_pred) AS tp, count(*) FILTER (NOT y_true AND y_pred) AS fp,
    count(*) FILTER (NOT y_true AND NOT y_pred) AS tn, count(*) FILTER (y_true AND NOT y_pred) AS fn
  FROM scored GROUP BY run_id)"""


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::DOUBLE / nullif(({whole})::DOUBLE, 0), 0)"


RATES_SQL = f"""rates AS (
  SELECT *, {ratio('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {ratio('tp', 'tp + fp')} AS prec,
    {ratio('tp', 'tp + fn')} AS rec, {ratio('tn', 'tn + fp')} AS spec, {ratio('fn', 'tp + fn')} AS fnr,
    {ratio('tn', 'tn + fn')} AS npv,
    coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc
  FROM cells),
f1s AS (SELECT *, CASE WHEN prec = 0 OR rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END AS f1 FROM rates)"""

# Columns that repeat under their output names, so that check queries can say SELECT ... FROM runs.
RUNS_SQL = f"""{CELLS_SQL}, {RATES_SQL},
runs AS (SELECT run_id, tp, fp, tn, fn, accuracy, prec AS "precision", rec AS recall, spec AS specificity, f1,
  fnr AS false_negative_rate, prec AS positive_predictive_value, npv AS negative_predictive_value,
  mcc AS matthews_correlation FROM f1s)"""


def pct_sql(value: str, digits: int = 1) -> str:
    scale = 10**digits
    return f"(round(({value}) * 100.0::DOUBLE * {scale}.0::DOUBLE) / {scale}.0::DOUBLE)"


def wilson_sql(hits: str, trials: str, side: str) -> str:
    """One bound of the 95 % interval."""
    n, p, z2 = f"({trials})::DOUBLE", f"(({hits})::DOUBLE / ({trials}))", "(1.96::DOUBLE * 1.96::DOUBLE)"
    middle = f"({p} + {z2} / (2 * {n})) / (1 + {z2} / {n})"
    spread = f"1.96::DOUBLE * sqrt(({p} * (1 - {p}) + {z2} / (4 * {n})) / {n}) / (1 + {z2} / {n})"
    sign = "-" if side == "lo" else "+"
    return f"CASE WHEN ({trials}) = 0 THEN 0 ELSE round(greatest(0, least(1, {middle} {sign} {spread})), 6) END"


def word_count_sql(text: str, words: tuple[str, ...]) -> str:
    """Number of whole words of the list in a text."""
    listed = ", ".join(f"'{w}'" for w in words)
    return (
        rf"len(list_filter(regexp_extract_all({text}, '[\p{{L}}\p{{M}}\p{{N}}_]+'), "
        f"lambda w: lower(w) IN ({listed})))"
    )
