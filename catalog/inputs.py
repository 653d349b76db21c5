"""Sources, profiles, corpus unification and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import status, text, units
from tallyloom.operators import corpus, profile, reports
from tallyloom.plans import flows
from tallyloom.session import scratch_path
from tallyloom.sources import readers, writers

from .base import LINES_SQL, RUNS_SQL, pct_sql, query, scored_lines, table, tidy
from .evaluation import ADVICE_SQL, EFFICIENCY_SELECT, PERFORMANCE_SQL, run_table

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey"


# --- stand-ins -------------------------------------------------------------------------------

def order_corpus(spark, sf):
    """Orders as classification rows, line items as effects, returned line items as dosages."""
    base = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("text"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    # Equal ids only occur for equal pairs, so the order inside a list is well defined.
    row_id = (F.col("l_linenumber").cast("long") * (1 << 56)) + F.col("l_partkey") * (1 << 24) + F.col("l_suppkey")
    lines = table(spark, sf, "lineitem").select(
        row_id.alias("row_id"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("text"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("drug"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("effect"),
        "l_returnflag",
    )
    dosages = lines.filter(F.col("l_returnflag") == "R").withColumnRenamed("effect", "dosage")
    return base, lines.drop("l_returnflag"), dosages.drop("l_returnflag")


ORDER_CORPUS_SQL = f"""notes AS (SELECT l_orderkey AS k, 'part ' || l_partkey AS drug, 'supplier ' || l_suppkey AS effect,
    l_returnflag, {LINE_ORDER} FROM lineitem),
  e AS (SELECT k, count(*) AS n, string_agg(drug || '>' || effect, ';' ORDER BY {LINE_ORDER}) AS pairs FROM notes GROUP BY k),
  d AS (SELECT k, count(*) AS n, string_agg(drug || '>' || effect, ';' ORDER BY {LINE_ORDER}) AS pairs FROM notes WHERE l_returnflag = 'R' GROUP BY k),
  unified AS (SELECT o_orderkey AS row_id, 'order ' || o_orderkey AS text, o_orderstatus = 'F' AS label,
    coalesce(e.n, 0) AS n_effects, coalesce(d.n, 0) AS n_dosages, coalesce(e.pairs, '') AS effects, coalesce(d.pairs, '') AS dosages
    FROM orders LEFT JOIN e ON e.k = o_orderkey LEFT JOIN d ON d.k = o_orderkey)"""


def document_corpus(spark, sf):
    """Documents (with repeated texts) as rows, labels as effects, short documents as dosages."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    base = documents.select(F.col("doc_id").alias("row_id"), "text", (F.col("lang") == "en").cast("int").alias("label"))
    effects = documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        "text",
        F.concat(F.lit("q"), F.col("quality").cast("string")).alias("drug"),
        F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("effect"),
    )
    dosages = documents.filter(F.col("n_chars") < 500).select(
        F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("drug"), F.col("source").alias("dosage")
    )
    return base, effects, dosages


DOCUMENT_CORPUS_SQL = """e AS (SELECT text, count(*) AS n, string_agg('q' || quality || '>t' || toxic, ';' ORDER BY doc_id) AS pairs
    FROM documents JOIN labels USING (doc_id) GROUP BY text),
  d AS (SELECT text, count(*) AS n, string_agg(lang || '>' || source, ';' ORDER BY doc_id) AS pairs FROM documents WHERE n_chars < 500 GROUP BY text),
  unified AS (SELECT doc_id AS row_id, documents.text, lang = 'en' AS label, coalesce(e.n, 0) AS n_effects, coalesce(d.n, 0) AS n_dosages,
    coalesce(e.pairs, '') AS effects, coalesce(d.pairs, '') AS dosages
    FROM documents LEFT JOIN e ON e.text = documents.text LEFT JOIN d ON d.text = documents.text)"""


def shown_pairs(column: str, second: str):
    return F.array_join(F.transform(column, lambda p: F.concat(p["drug"], F.lit(">"), p[second])), ";")


def _unified(df):
    return tidy(
        df.select(
            "row_id", F.md5("text").alias("text_md5"), "label", "part", "n_effects", "n_dosages",
            shown_pairs("drug_effect_pairs", "effect").alias("effects"),
            shown_pairs("drug_dosage_pairs", "dosage").alias("dosages"),
        )
    )


UNIFIED_SELECT = "SELECT row_id, md5(text) AS text_md5, label, 0::BIGINT AS part, n_effects, n_dosages, effects, dosages FROM unified"


# --- sources and sinks -----------------------------------------------------------------------

def three_configs(spark, sf):
    paths = {n: f"{sf}/{n}.parquet" for n in ("documents", "benchmark", "conversations")}
    schemas = {
        "documents": "doc_id bigint, text string, lang string",
        "benchmark": "item_id bigint, text string",
        "conversations": "conv_id bigint, turn bigint, text string",
    }
    return readers.read_corpus(spark, paths, schemas)


@query(
    "read_corpus",
    """SELECT 'documents' AS config, count(*) AS n_rows, count(*) AS n_positions, sum(length(text))::BIGINT AS n_chars FROM documents
    UNION ALL SELECT 'benchmark', count(*), count(*), sum(length(text))::BIGINT FROM benchmark
    UNION ALL SELECT 'conversations', count(*), count(*), sum(length(text))::BIGINT FROM conversations""",
)
def read_corpus(spark, sf):
    parts = [
        df.groupBy(F.lit(name).alias("config")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("file_name", "row_index").alias("n_positions"),
            F.sum(F.length("text").cast("long")).alias("n_chars"),
        )
        for name, df in three_configs(spark, sf).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


EXAMPLE_ALIASES = {
    "text": ("text", "sentence", "content"),
    "label": ("label", "ade_label", "turn"),
    "drug": ("drug", "medication", "lang"),
    "effect": ("effect", "symptom", "role"),
}


def first_word_sql(column: str) -> str:
    return (
        rf"list_filter(regexp_extract_all({column}, '[\p{{L}}\p{{M}}\p{{N}}_]+'), "
        "lambda w: lower(w) IN ('the', 'of', 'and', 'with'))[1]"
    )


@query(
    "read_examples",
    f"""SELECT md5(text) AS text_md5, 0::BIGINT AS label, lang AS drug, NULL::VARCHAR AS effect FROM documents
    UNION ALL SELECT md5(text), 0::BIGINT, lower({first_word_sql('text')}), NULL FROM benchmark
    UNION ALL SELECT md5(text), turn::BIGINT, lower({first_word_sql('text')}), role FROM conversations""",
)
def read_examples(spark, sf):
    paths = [f"{sf}/{n}.parquet" for n in ("documents", "benchmark", "conversations")]
    examples = readers.read_examples(spark, paths, EXAMPLE_ALIASES, ("the", "of", "and", "with"))
    return examples.select(F.md5("text").alias("text_md5"), "label", "drug", "effect")


@query(
    "unreadable_examples",
    """SELECT count(*) AS n_rows, sum((label = 1)::BIGINT)::BIGINT AS n_positive, 2::BIGINT AS n_unreadable, 'not a Parquet file' AS reason
    FROM (SELECT quality AS label FROM documents LEFT JOIN labels USING (doc_id))""",
)
def unreadable_examples(spark, sf):
    """Noted documents read from a folder that also holds two files of another format."""
    path = scratch_path(spark, "examples")
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    noted.select("text", F.col("quality").alias("label")).write.parquet(path)
    for name in ("region", "nation"):
        table(spark, sf, name).coalesce(1).select(F.col(f"{name[0]}_name")).write.mode("append").text(path)
    read = readers.read_examples(spark, [path], names="part-*")
    read = read.agg(F.count("text").alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_positive"))
    bad = readers.unreadable_examples(spark, [path], names="part-*", whole=True)
    bad = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_unreadable"))
    return read.withColumn("_k", F.lit(1)).join(bad.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query(
    "read_pull_requests",
    "SELECT page_id AS pr, url AS title, md5(html) AS description, '' AS ellipsis_summary FROM pages",
)
def read_pull_requests(spark, sf):
    """Whole pages written as JSON lines and read back as pull requests."""
    path = scratch_path(spark, "pull-requests")
    table(spark, sf, "pages").select(
        F.col("page_id").alias("pr"),
        F.col("url").alias("title"),
        F.col("html").alias("description"),
        F.lit(None).cast("string").alias("ellipsis_summary"),
    ).write.json(path)
    back = readers.read_pull_requests(spark, path, multi_line=False)
    return back.withColumn("description", F.md5("description"))


@query(
    "run_registry",
    """WITH e AS (SELECT event_type AS run_id, event_id % 3 AS version, arg_max(value, event_id) AS score, max(event_id) AS last, max(ts) AS ts, count(*) AS n
        FROM events GROUP BY ALL)
    SELECT run_id, 'value' AS best_score_name, round(arg_max(score, (ts, version)), 6) AS best_score_value, arg_max(n, (ts, version))::VARCHAR AS n_events,
      '{"last": ' || arg_max(last, (ts, version)) || '}' AS program, count(*) AS versions FROM e GROUP BY run_id""",
)
def run_registry(spark, sf):
    """Three versions of every run saved one after the other, and each run loaded by its id."""
    path = scratch_path(spark, "registry")
    events = table(spark, sf, "events")
    for version in range(3):
        rows = events.where(F.col("event_id") % 3 == version).groupBy(F.col("event_type").alias("run_id"))
        made = rows.agg(
            F.max_by("value", "event_id").alias("best_score_value"),
            F.max("event_id").alias("last"),
            # Saved later by a microsecond per version, so that equal times are no ties.
            F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("at"),
            F.count(F.lit(1)).alias("n"),
        )
        writers.save_run(
            made.select(
                "run_id",
                F.lit("value").alias("best_score_name"),
                "best_score_value",
                F.create_map(F.lit("n_events"), F.col("n").cast("string")).alias("metadata"),
                F.concat(F.lit('{"last": '), F.col("last").cast("string"), F.lit("}")).alias("program"),
                F.timestamp_micros(F.col("at") * 10 + version).alias("saved_at"),
            ),
            path,
        )
    # Every event type is a run; an unknown id and a registry that is not there give no rows.
    loaded = writers.load_run(spark, f"{path}-missing", "view").unionByName(writers.load_run(spark, path, "no such run"))
    for run_id in ("view", "click", "purchase", "signup", "error"):
        loaded = loaded.unionByName(writers.load_run(spark, path, run_id))
    return tidy(loaded.select("run_id", "best_score_name", "best_score_value", F.col("metadata")["n_events"].alias("n_events"), "program", "versions"))


@query(
    "write_report_json",
    f"""WITH {LINES_SQL}, {RUNS_SQL} SELECT run_id, tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM runs""",
)
def write_report_json(spark, sf):
    """Written to the shared folder and read back."""
    path = scratch_path(spark, "report")
    metrics = flows.graded_run(scored_lines(spark, sf), ["run_id"]).withColumnRenamed("run_id", "run")
    writers.write_report_json(metrics.select("run", "tp", "fp", "tn", "fn", "accuracy", "f1"), path, "r1")
    back = spark.read.schema(
        "run string, tp bigint, fp bigint, tn bigint, fn bigint, accuracy double, f1 double"
    ).json(path)
    return tidy(back.select(F.col("run").alias("run_id"), "tp", "fp", "tn", "fn", "accuracy", "f1"))


@query(
    "metric_table",
    f"""WITH {LINES_SQL}, {RUNS_SQL}, {PERFORMANCE_SQL},
    t AS (SELECT *, row_number() OVER (ORDER BY run_id) AS rn FROM runs JOIN performance USING (run_id))
    SELECT 1::BIGINT AS section, 1::BIGINT AS line_no, '| Run | F1 | Calls | Dollars | Failed |' AS line
    UNION ALL SELECT 1, 2, '|---|---|---|---|---|'
    UNION ALL SELECT 1, rn + 2, '| ' || upper(run_id[1]) || run_id[2:] || ' | ' || {pct_sql('f1')}::VARCHAR || '% | ' || total_api_calls || ' | $' ||
      printf('%.6f', estimated_cost_usd) || ' | ' || processing_errors || ' |' FROM t""",
)
def metric_table(spark, sf):
    return reports.metric_table(run_table(spark, sf))


@query(
    "write_report_text",
    f"""WITH {ADVICE_SQL}, c AS ({EFFICIENCY_SELECT})
    SELECT line, count(*) AS n FROM (
      SELECT unnest(['# Runs over line items', '', '**Direct run**: quantity', '| Run | F1 | Calls | Dollars | Failed |', '|---|---|---|---|---|']) AS line
      UNION ALL SELECT '| ' || upper(run_id[1]) || run_id[2:] || ' | ' || {pct_sql('f1')}::VARCHAR || '% | ' || total_api_calls || ' | $' ||
        printf('%.6f', estimated_cost_usd) || ' | ' || processing_errors || ' |' FROM run_table
      UNION ALL SELECT '- calls per prediction, staged to direct: ' || api_call_ratio::VARCHAR || ' to 1 (' || cost_savings_pct::BIGINT || ' % saved)' FROM c
      UNION ALL SELECT '- F1 before and after optimising: ' || baseline_f1_pct::VARCHAR || ' %, ' || optimized_f1_pct::VARCHAR || ' % (' || improvement_pct::VARCHAR || ' % change)' FROM c
      UNION ALL SELECT row_number() OVER (ORDER BY k) || '. ' || category || ': ' || recommendation || ' - ' || reasoning || ' [' || lower(confidence) || ' confidence]' FROM a)
    GROUP BY line""",
)
def write_report_text(spark, sf):
    """All sections written to the shared folder and read back."""
    path = scratch_path(spark, "report-text")
    lines = flows.approach_report(run_table(spark, sf), "open", "quantity", "discount", "Runs over line items", {"Direct run": "quantity"})
    writers.write_report_text(lines, path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


# --- profiles --------------------------------------------------------------------------------

@query(
    "profile_shape",
    """SELECT 'documents' AS config, count(*) AS n_rows, 5::BIGINT AS n_columns,
      'doc_id:bigint, text:string, lang:string, source:string, n_chars:bigint' AS types FROM documents
    UNION ALL SELECT 'orders', count(*), 6, 'o_orderkey:bigint, o_custkey:bigint, o_orderstatus:string, o_totalprice:double, o_orderdate:timestamp_ntz, o_orderpriority:string' FROM orders
    UNION ALL SELECT 'events', count(*), 6, 'event_id:bigint, ts:timestamp_ntz, user_id:bigint, event_type:string, value:double, props:string' FROM events""",
)
def profile_shape(spark, sf):
    return profile.profile_shape({n: table(spark, sf, n) for n in ("documents", "orders", "events")})


@query(
    "profile_non_null",
    """SELECT unnest(['doc_id', 'quality', 'toxic']) AS column_name, unnest([count(d.doc_id), count(quality), count(toxic)]) AS non_null
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def profile_non_null(spark, sf):
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return profile.profile_non_null(noted, ["doc_id", "quality", "toxic"])


@query("label_distribution", "SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1")
def label_distribution(spark, sf):
    return profile.label_distribution(table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "label"))


@query(
    "preview_rows",
    """SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 101) || '...' ELSE text END AS text, lang
    FROM documents ORDER BY doc_id LIMIT 3""",
)
def preview_rows(spark, sf):
    return profile.preview_rows(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id", 3)


@query(
    "corpus_stats",
    f"""WITH {ORDER_CORPUS_SQL}, c AS (SELECT count(*) AS total, count(*) FILTER (n_effects > 0) AS with_effects,
      count(*) FILTER (n_dosages > 0) AS with_dosages, count(*) FILTER (label) AS positives FROM unified)
    SELECT *, {pct_sql('with_effects::DOUBLE / total')} AS with_effects_pct, {pct_sql('with_dosages::DOUBLE / total')} AS with_dosages_pct,
      {pct_sql('positives::DOUBLE / total')} AS positives_pct FROM c""",
)
def corpus_stats(spark, sf):
    return tidy(profile.corpus_stats(corpus.unify_counts(*order_corpus(spark, sf))))


@query(
    "annotation_label_crosstab",
    f"""WITH {ORDER_CORPUS_SQL} SELECT count(*) FILTER (n_effects > 0 AND label) AS annotated_positive,
      count(*) FILTER (n_effects > 0 AND NOT label) AS annotated_negative, count(*) FILTER (n_effects = 0 AND label) AS plain_positive,
      count(*) FILTER (n_effects = 0 AND NOT label) AS plain_negative,
      count(*) FILTER (n_effects > 0 AND NOT label) = 0 AS all_annotated_positive FROM unified""",
)
def annotation_label_crosstab(spark, sf):
    return tidy(profile.annotation_label_crosstab(corpus.unify_counts(*order_corpus(spark, sf))))


def text_configs(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return {
        "all": documents.select("text", "lang"),
        "labelled": documents.join(labels, "doc_id").select("text", "quality"),
        "short": documents.filter(F.col("n_chars") < 1500).select("text", "source"),
    }


TEXT_CONFIGS_SQL = """a AS (SELECT DISTINCT text FROM documents),
  l AS (SELECT DISTINCT text FROM documents JOIN labels USING (doc_id)),
  s AS (SELECT DISTINCT text FROM documents WHERE n_chars < 1500)"""


@query(
    "config_alignment",
    f"""WITH {TEXT_CONFIGS_SQL} SELECT 'all' AS configs, count(*) AS n_texts FROM a
    UNION ALL SELECT 'labelled', count(*) FROM l UNION ALL SELECT 'short', count(*) FROM s
    UNION ALL SELECT 'all&labelled', count(*) FROM (FROM a INTERSECT FROM l)
    UNION ALL SELECT 'all&short', count(*) FROM (FROM a INTERSECT FROM s)
    UNION ALL SELECT 'labelled&short', count(*) FROM (FROM l INTERSECT FROM s)
    UNION ALL SELECT 'every', count(*) FROM (FROM a INTERSECT FROM l INTERSECT FROM s)""",
)
def config_alignment(spark, sf):
    return profile.config_alignment(text_configs(spark, sf))


@query(
    "shared_text_annotations",
    f"""WITH {TEXT_CONFIGS_SQL}, k AS (SELECT text FROM (FROM a INTERSECT FROM l INTERSECT FROM s) ORDER BY sha256(text) LIMIT 1)
    SELECT 'all' AS config, '{{"lang":"' || lang || '"}}' AS row FROM documents JOIN k USING (text)
    UNION ALL SELECT 'labelled', '{{"quality":' || quality || '}}' FROM documents JOIN labels USING (doc_id) JOIN k USING (text)
    UNION ALL SELECT 'short', '{{"source":"' || source || '"}}' FROM documents JOIN k USING (text) WHERE n_chars < 1500""",
)
def shared_text_annotations(spark, sf):
    shown = {"all": ["lang"], "labelled": ["quality"], "short": ["source"]}
    return profile.shared_text_annotations(text_configs(spark, sf), shown)


@query("intersect", f"WITH {TEXT_CONFIGS_SQL} SELECT md5(text) AS text_md5 FROM (FROM l INTERSECT FROM s)")
def intersect(spark, sf):
    configs = text_configs(spark, sf)
    shared = profile.intersect_texts(configs["labelled"], configs["short"])
    return shared.select(F.md5("text").alias("text_md5"))


@query("except_distinct", f"WITH {TEXT_CONFIGS_SQL} SELECT md5(text) AS text_md5 FROM (FROM a EXCEPT FROM l)")
def except_distinct(spark, sf):
    configs = text_configs(spark, sf)
    return profile.except_texts(configs["all"], configs["labelled"]).select(F.md5("text").alias("text_md5"))


# --- unification and examples ----------------------------------------------------------------

@query(
    "pairs_by_text",
    f"WITH {ORDER_CORPUS_SQL} SELECT 'order ' || k AS text, 0::BIGINT AS part, n AS n_pairs, pairs FROM e",
)
def pairs_by_text(spark, sf):
    _, effects, _ = order_corpus(spark, sf)
    pairs = corpus.pairs_by_text(effects, "text", "drug", "effect", "row_id")
    return tidy(pairs.select("text", "part", F.size("pairs").alias("n_pairs"), shown_pairs("pairs", "effect").alias("pairs")))


@query(
    "long_pairs",
    f"""WITH {ORDER_CORPUS_SQL} SELECT sha256('order ' || k) AS text_key, drug, effect,
      row_number() OVER (PARTITION BY k ORDER BY {LINE_ORDER}) AS pos FROM notes""",
)
def long_pairs(spark, sf):
    _, effects, _ = order_corpus(spark, sf)
    return corpus.long_pairs(effects, "text", "drug", "effect", "row_id").select("text_key", "drug", "effect", "pos")


@query("unify_corpus", f"WITH {DOCUMENT_CORPUS_SQL} {UNIFIED_SELECT}")
def unify_corpus(spark, sf):
    return _unified(corpus.unify_corpus(*document_corpus(spark, sf)))


@query("unify_corpus_orders", f"WITH {ORDER_CORPUS_SQL} {UNIFIED_SELECT}")
def unify_corpus_orders(spark, sf):
    return _unified(corpus.unify_corpus(*order_corpus(spark, sf)))


@query("label_to_bool", "SELECT d.doc_id, coalesce(toxic = 1, false) AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def label_to_bool(spark, sf):
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return noted.select("doc_id", status.label_to_bool(F.col("toxic")).alias("label"))


@query(
    "label_to_status",
    """SELECT d.doc_id, CASE WHEN quality + toxic = 1 THEN 'mild_adverse_event' ELSE 'no_adverse_event' END AS ade_status
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def label_to_status(spark, sf):
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return noted.select("doc_id", status.label_to_status(F.col("quality") + F.col("toxic")).alias("ade_status"))


@query(
    "parse_status",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'no_adverse_event' WHEN 'click' THEN 'mild_adverse_event'
      WHEN 'error' THEN 'severe_adverse_event' WHEN 'signup' THEN 'mild_adverse_event' ELSE 'no_adverse_event' END AS ade_status FROM events""",
)
def parse_status(spark, sf):
    said = (
        F.when(F.col("event_type") == "view", "None")
        .when(F.col("event_type") == "click", "MILD")
        .when(F.col("event_type") == "error", "SevereADE")
        .when(F.col("event_type") == "signup", "mild_adverse_event")
        .otherwise("perhaps")
    )
    return table(spark, sf, "events").select("event_id", status.parse_status(said).alias("ade_status"))


@query(
    "valid_items",
    "SELECT event_id FROM events WHERE event_type IN ('view', 'click', 'signup')",
)
def valid_items(spark, sf):
    raw = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('{"text": "a", "label": '), F.col("user_id").cast("string"), F.lit("}")))
        .when(F.col("event_type") == "click", F.lit('{"text": null, "label": null}'))
        .when(F.col("event_type") == "signup", F.lit('{"label": 0, "text": "b", "more": [1]}'))
        .when(F.col("event_type") == "error", F.col("props"))
        .otherwise(F.lit('{"text": "no label"}'))
    )
    rows = table(spark, sf, "events").withColumn("raw", raw)
    return corpus.valid_items(rows, "raw").select("event_id")


@query(
    "to_examples",
    """SELECT d.doc_id, md5(text) AS text_md5, CASE WHEN toxic = 1 THEN 'mild_adverse_event' ELSE 'no_adverse_event' END AS ade_status,
      1.0::DOUBLE AS confidence, 0::BIGINT AS n_pairs FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def to_examples(spark, sf):
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = corpus.to_examples(noted, "text", "toxic").select(
        "doc_id",
        F.md5("input.text").alias("text_md5"),
        "expected.ade_status",
        "expected.confidence",
        F.size("expected.drug_symptom_pairs").alias("n_pairs"),
    )
    return tidy(rows)


@query(
    "extraction_examples",
    f"""WITH notes AS (SELECT l_orderkey AS k, l_returnflag AS drug, l_linestatus AS effect, l_returnflag = 'R' AS dose, {LINE_ORDER}, l_discount FROM lineitem),
    p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {LINE_ORDER}) AS pos FROM notes WHERE NOT dose),
    e1 AS (SELECT k, drug AS item, min(pos) AS pos FROM p GROUP BY ALL), e2 AS (SELECT k, effect AS item, min(pos) AS pos FROM p GROUP BY ALL),
    d1 AS (SELECT DISTINCT k, drug AS item FROM notes WHERE dose AND k NOT IN (SELECT k FROM p))
    SELECT 'order ' || k AS text, 'drugs' AS kind, string_agg(item, ',' ORDER BY pos) AS items FROM e1 WHERE k IN (SELECT o_orderkey FROM orders) GROUP BY k
    UNION ALL SELECT 'order ' || k, 'effects', string_agg(item, ',' ORDER BY pos) FROM e2 WHERE k IN (SELECT o_orderkey FROM orders) GROUP BY k
    UNION ALL SELECT 'order ' || k, 'drugs', string_agg(item, ',') FROM d1 WHERE k IN (SELECT o_orderkey FROM orders) GROUP BY k""",
)
def extraction_examples(spark, sf):
    base, _, _ = order_corpus(spark, sf)
    row_id = (F.col("l_linenumber").cast("long") * (1 << 56)) + F.col("l_partkey") * (1 << 24) + F.col("l_suppkey")
    lines = table(spark, sf, "lineitem").select(
        row_id.alias("row_id"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("text"),
        F.col("l_returnflag").alias("drug"),
        F.col("l_linestatus").alias("effect"),
    )
    dosed = F.col("drug") == "R"
    unified = corpus.unify_corpus(
        base, lines.filter(~dosed), lines.filter(dosed).withColumnRenamed("effect", "dosage")
    )
    examples = corpus.extraction_examples(unified)
    return examples.select("text", "kind", F.array_join("items", ",").alias("items"))


@query(
    "classification_examples",
    f"""WITH {ORDER_CORPUS_SQL}, x AS (SELECT k, string_agg(drug, ';' ORDER BY {LINE_ORDER}) AS drugs,
      string_agg(effect, ';' ORDER BY {LINE_ORDER}) AS effects FROM notes GROUP BY k)
    SELECT text, coalesce(x.drugs, '') AS drugs, coalesce(x.effects, '') AS effects, label AS has_ade,
      CASE WHEN label THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END AS confidence FROM unified LEFT JOIN x ON x.k = row_id""",
)
def classification_examples(spark, sf):
    rows = corpus.classification_examples(corpus.unify_corpus(*order_corpus(spark, sf)))
    return tidy(
        rows.select(
            "text", F.array_join("drugs", ";").alias("drugs"), F.array_join("effects", ";").alias("effects"),
            "has_ade", "confidence",
        )
    )


@query(
    "corpus_scorecard",
    f"""WITH {ORDER_CORPUS_SQL}, ranked AS (SELECT o_orderkey AS k, o_orderstatus = 'F' AS label, row_number() OVER w AS r, count(*) OVER (PARTITION BY o_orderstatus = 'F') AS n
        FROM orders WINDOW w AS (PARTITION BY o_orderstatus = 'F' ORDER BY md5(o_orderkey || '|42'), o_orderkey)),
    test AS (SELECT k, label FROM ranked WHERE r > floor(n * 0.7::DOUBLE + 0.5) + floor(n * 0.15::DOUBLE + 0.5)),
    items AS (SELECT k, count(*) AS n, count(DISTINCT drug) AS d, count(DISTINCT effect) AS e FROM notes GROUP BY k),
    x AS (SELECT test.k, label, coalesce(n, 0) AS n, coalesce(d, 0) AS d, coalesce(e, 0) AS e FROM test LEFT JOIN items USING (k))
    SELECT count(*) AS examples_evaluated, count(*) FILTER (d > 0) AS drug_valid_examples, 1.0::DOUBLE AS drug_f1, sum(d)::BIGINT AS drug_item_tp,
      sum((e > 0)::INT)::BIGINT AS effect_item_tp, sum(e - (e > 0)::INT)::BIGINT AS effect_item_fn, round(avg(1.0::DOUBLE / e) FILTER (e > 0), 6) AS effect_recall,
      count(*) FILTER (label AND n > 3) AS tp, count(*) FILTER (NOT label AND n > 3) AS fp, count(*) FILTER (NOT label AND n <= 3) AS tn,
      count(*) FILTER (label AND n <= 3) AS fn FROM x""",
)
def corpus_scorecard(spark, sf):
    def scorer(df):
        return df.withColumns({"y_pred": F.size("drugs") > 3, "pred_drugs": F.col("drugs"), "pred_effects": F.slice("effects", 1, 1)})

    card = flows.corpus_scorecard(*order_corpus(spark, sf), scorer, "row_id")
    return tidy(
        card.select(
            "examples_evaluated", "drug_valid_examples", "drug_f1", "drug_item_tp", "effect_item_tp", "effect_item_fn", "effect_recall",
            "tp", "fp", "tn", "fn",
        )
    )


@query(
    "clean_input",
    """SELECT event_id, coalesce(CASE WHEN event_type <> 'view' THEN props END, '') AS patient_report,
      CASE WHEN event_type = 'click' THEN '' ELSE event_type END AS medications,
      CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS symptoms FROM events""",
)
def clean_input(spark, sf):
    kind = F.col("event_type")
    raw = table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "view", F.col("props")).alias("patient_report"),
        F.when(kind != "click", kind).alias("medications"),
        F.array(F.lit(None).cast("string"), F.when(kind == "error", "").otherwise(kind)).alias("symptoms"),
    )
    cleaned = corpus.clean_input(raw)
    return cleaned.select(
        "event_id", "patient_report", F.array_join("medications", ",").alias("medications"),
        F.array_join("symptoms", ",").alias("symptoms"),
    )


@query(
    "check_required",
    """SELECT count(*) AS n, min(d.doc_id) FILTER (quality IS NULL) AS first_bad,
      'Invalid training examples: item ' || min(d.doc_id) FILTER (quality IS NULL) || ' missing required fields' AS error
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def check_required(spark, sf):
    noted = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return corpus.check_required(noted, "doc_id", ["text", "quality"])


# --- text functions --------------------------------------------------------------------------

MEDS, SYMS = ("the", "of", "and", "with"), ("en", "der", "la", "de", "in")


def hits_sql(words, expr="text"):
    listed = ", ".join(f"'{w}'" for w in words)
    return rf"list_filter(regexp_extract_all({expr}, '[\p{{L}}\p{{M}}\p{{N}}_]+'), lambda w: lower(w) IN ({listed}))"


def first_seen_sql(hits: str, low: bool) -> str:
    """Distinct list entries in first-seen order."""
    source = f"list_transform({hits}, lambda w: lower(w))" if low else hits
    return f"list_filter({source}, lambda w, i: list_position({source}, w) = i)"


MEDS_SQL = f"array_to_string({first_seen_sql(hits_sql(MEDS), True)}, ',')"
SYMS_SQL = f"array_to_string(list_transform({first_seen_sql(hits_sql(SYMS), False)}, lambda w: lower(w)), ', ')"


@query("extract_medications", f"SELECT doc_id, {MEDS_SQL} AS medications FROM documents")
def extract_medications(spark, sf):
    found = text.extract_medications(F.col("text"), MEDS)
    return table(spark, sf, "documents").select("doc_id", F.array_join(found, ",").alias("medications"))


@query("extract_symptoms", f"SELECT doc_id, {SYMS_SQL} AS symptoms FROM documents")
def extract_symptoms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.extract_symptoms(F.col("text"), SYMS).alias("symptoms"))


PAIRS_SQL = """CASE WHEN medications = '' OR symptoms = '' THEN ''
  ELSE array_to_string(list_transform(string_split(medications, ','), lambda m: m || '>' || trim(string_split(symptoms, ',')[1])), ';') END"""


@query(
    "drug_symptom_pairs",
    f"WITH s AS (SELECT doc_id, {MEDS_SQL} AS medications, {SYMS_SQL} AS symptoms FROM documents) SELECT doc_id, {PAIRS_SQL} AS pairs FROM s",
)
def drug_symptom_pairs(spark, sf):
    scanned = table(spark, sf, "documents").select(
        "doc_id",
        text.extract_medications(F.col("text"), MEDS).alias("m"),
        text.extract_symptoms(F.col("text"), SYMS).alias("s"),
    )
    pairs = text.drug_symptom_pairs(F.col("m"), F.col("s"))
    return scanned.select(
        "doc_id",
        F.array_join(F.transform(pairs, lambda p: F.concat(p["drug"], F.lit(">"), p["symptom"])), ";").alias("pairs"),
    )


@query(
    "synthetic_examples",
    f"""WITH s AS (SELECT d.doc_id, toxic, {MEDS_SQL.replace('text', 'd.text')} AS medications, {SYMS_SQL.replace('text', 'd.text')} AS symptoms
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, medications, symptoms, CASE WHEN toxic = 1 THEN 'mild_adverse_event' ELSE 'no_adverse_event' END AS ade_status,
      CASE WHEN toxic = 1 THEN 0.8::DOUBLE ELSE 0.9::DOUBLE END AS confidence, {PAIRS_SQL} AS pairs FROM s""",
)
def synthetic_examples(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    out = corpus.synthetic_examples(rows, "text", "toxic", MEDS, SYMS)
    return tidy(
        out.select(
            "doc_id", F.array_join("medications", ",").alias("medications"), "symptoms", "ade_status", "confidence",
            F.array_join(
                F.transform("drug_symptom_pairs", lambda p: F.concat(p["drug"], F.lit(">"), p["symptom"])), ";"
            ).alias("pairs"),
        )
    )


@query("approx_tokens", "SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS tokens FROM documents")
def approx_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.approx_tokens(F.col("text")).alias("tokens"))


SECRETS = {r'token = "[0-9a-f]{40}"': 'token = "<TOKEN>"', r"[0-9]{16}": "<NUMBER>"}


@query(
    "redact_secrets",
    """SELECT doc_id, md5(regexp_replace(regexp_replace(text, 'token = "[0-9a-f]{40}"', 'token = "<TOKEN>"', 'g'), '[0-9]{16}', '<NUMBER>', 'g')) AS text_md5
    FROM documents""",
)
def redact_secrets(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.redact_secrets(F.col("text"), SECRETS)).alias("text_md5")
    )


@query(
    "convert_units",
    """WITH u AS (SELECT p_partkey, p_size, ['meters', 'celsius', 'KG', 'miles', 'stone'][p_partkey % 5 + 1] AS a,
      ['feet', 'Fahrenheit', 'pounds', 'km', 'kg'][p_partkey % 5 + 1] AS b FROM part)
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN round(p_size * 3.28084::DOUBLE, 4) WHEN 1 THEN round(p_size * 9.0::DOUBLE / 5.0 + 32, 4)
      WHEN 2 THEN round(p_size * 2.20462::DOUBLE, 4) WHEN 3 THEN round(p_size * 1.60934::DOUBLE, 4) END AS converted,
      CASE WHEN p_partkey % 5 = 4 THEN 'Error: Conversion from ' || a || ' to ' || b || ' not supported' END AS error FROM u""",
)
def convert_units(spark, sf):
    part = table(spark, sf, "part")
    at = (F.col("p_partkey") % 5).cast("int") + 1
    source = F.element_at(F.array(*map(F.lit, ("meters", "celsius", "KG", "miles", "stone"))), at)
    target = F.element_at(F.array(*map(F.lit, ("feet", "Fahrenheit", "pounds", "km", "kg"))), at)
    done = part.select("p_partkey", units.convert_units(F.col("p_size"), source, target).alias("u"))
    return tidy(done.select("p_partkey", "u.converted", "u.error"))


@query(
    "stamp_columns",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS file,
      strftime(make_timestamp((event_id + 1700000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created FROM events""",
)
def stamp_columns(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        units.iso_stamp(F.col("ts")).alias("iso"),
        units.file_stamp(F.col("ts")).alias("file"),
        units.iso_stamp(units.from_epoch(F.col("event_id") + 1700000000)).alias("created"),
    )
