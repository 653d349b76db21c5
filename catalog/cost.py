"""Token and cost analytics. Conversations stand in for recorded calls: one file per conversation,
one call per assistant turn; the turns before it are the prompt of later calls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import pricing
from tallyloom.functions.text import approx_tokens
from tallyloom.operators import costs, rules
from tallyloom.plans import flows
from tallyloom.session import scratch_path
from tallyloom.sources import readers
from tallyloom.streaming import folds

from .base import query, table, tidy

FOLDERS = ("ade_reproducibility/optimization", "baseline", "ade_pipeline_integration", "other")


def interactions(spark, sf):
    """One recorded call per turn: user and system text is prompt, assistant text is completion."""
    turns = table(spark, sf, "conversations")
    tokens = approx_tokens(F.col("text"))
    told = F.when(F.col("role") == "assistant", F.lit(0).cast("long")).otherwise(tokens)
    said = F.when(F.col("role") == "assistant", tokens).otherwise(F.lit(0).cast("long"))
    usage = F.struct(told.alias("prompt_tokens"), said.alias("completion_tokens"))
    folder = F.element_at(F.array(*map(F.lit, FOLDERS)), (F.col("conv_id") % 4).cast("int") + 1)
    body = F.when(F.col("role") == "system", F.lit("not JSON")).otherwise(F.to_json(F.struct(usage.alias("usage"))))
    return turns.select(
        F.concat(folder, F.lit("/conversation_"), F.col("conv_id").cast("string"), F.lit(".yml")).alias("cassette"),
        F.col("turn").alias("idx"),
        F.lit("post").alias("method"),
        F.when(F.col("turn") == 5, "https://datasets-server.example/list")
        .otherwise("https://api.openai.com/v1/chat/completions")
        .alias("uri"),
        body.alias("response_body"),
        "conv_id",
        "role",
    )


CALLS_SQL = """calls AS (SELECT conv_id, role, turn AS idx,
    ['ade_reproducibility/optimization', 'baseline', 'ade_pipeline_integration', 'other'][conv_id % 4 + 1] || '/conversation_' || conv_id || '.yml' AS cassette,
    CASE WHEN role = 'assistant' THEN 0 ELSE ceil(length(text) / 4.0)::BIGINT END AS i,
    CASE WHEN role = 'assistant' THEN ceil(length(text) / 4.0)::BIGINT ELSE 0 END AS o
  FROM conversations WHERE turn <> 5 AND role <> 'system')"""
# Exact prices in billionths of a dollar: 150 per prompt token, 600 per completion token.
NANO = "(i * 150 + o * 600)"


def money(nano: str, digits: int = 6) -> str:
    step = 10 ** (9 - digits)
    return f"((({nano}) + {step // 2}) // {step} / {10 ** digits}.0::DOUBLE)"


FILES_SQL = f"""{CALLS_SQL}, files AS (SELECT cassette, sum(i)::BIGINT AS i, sum(o)::BIGINT AS o, count(*) AS requests,
    (sum(i) * 150 + sum(o) * 600)::BIGINT AS nano FROM calls GROUP BY cassette),
  costs AS (SELECT cassette, i AS input_tokens, o AS output_tokens, i + o AS total_tokens, requests,
    ((nano + 500) // 1000) AS micro, ((nano * 2 + requests * 1000) // (requests * 2000)) AS micro_each FROM files)"""


CALL_COLUMNS = ("cassette", "idx", "input_tokens", "output_tokens", "total_tokens")


@query(
    "read_interactions",
    f"""WITH {CALLS_SQL}, c AS (SELECT cassette, idx, i AS input_tokens, o AS output_tokens, i + o AS total_tokens FROM calls)
    SELECT 'yaml' AS form, * FROM c UNION ALL SELECT 'json lines', * FROM c""",
)
def read_interactions(spark, sf):
    """Recorded calls written and read back: a YAML file per conversation, and JSON lines."""
    out = scratch_path(spark, "recorded")
    rows = interactions(spark, sf)
    rows.select("cassette", "idx", "method", "uri", "response_body").write.json(f"{out}/lines")
    # JSON is YAML, so a file is one line; it lies in a folder named like its conversation.
    call = F.struct(
        F.struct("method", "uri").alias("request"), F.struct(F.struct(F.col("response_body").alias("string")).alias("body")).alias("response")
    )
    every = F.aggregate(
        F.sort_array(F.collect_list(F.struct("idx", call.alias("c")))),
        F.array().cast("array<struct<request:struct<method:string,uri:string>,response:struct<body:struct<string:string>>>>"),
        # The number of a call is its place in the file.
        lambda made, r: F.concat(made, F.array_repeat(F.lit(None), (r["idx"] - F.size(made)).cast("int")), F.array(r["c"])),
    )
    files = rows.groupBy("cassette").agg(every.alias("calls"))
    files = files.select("cassette", F.to_json(F.struct(F.col("calls").alias("http_interactions")), {"ignoreNullFields": "false"}).alias("value"))
    # Each row is a file: they are dealt to all cores, and the tasks put them into place, not the driver one by one.
    files = files.repartition(4 * spark.sparkContext.defaultParallelism)
    files.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("cassette").text(f"{out}/files")
    yaml = readers.read_interactions(spark, f"{out}/files", "*.txt")
    folder = F.url_decode(F.regexp_extract("cassette", "^cassette=([^/]+)/", 1))
    lines = readers.read_interactions_json(spark, f"{out}/lines")
    named = yaml.withColumn("cassette", folder).select(F.lit("yaml").alias("form"), "*").unionByName(lines.select(F.lit("json lines").alias("form"), "*"))
    return costs.calls_with_usage(named).select("form", *CALL_COLUMNS)


@query(
    "read_interactions_split",
    """SELECT 'g=' || conv_id // 500 AS cassette, idx, CASE WHEN role = 'assistant' THEN 0 ELSE n END AS input_tokens,
      CASE WHEN role = 'assistant' THEN n ELSE 0 END AS output_tokens, n AS total_tokens
    FROM (SELECT *, ceil(length(text) / 4.0)::BIGINT AS n, row_number() OVER (PARTITION BY conv_id // 500 ORDER BY conv_id, turn) - 1 AS idx FROM conversations)
    WHERE turn <> 5 AND role <> 'system'""",
)
def read_interactions_split(spark, sf):
    """Recorded calls of five hundred conversations a file, in the recorder's layout, read back call by call."""
    out = scratch_path(spark, "recorded-long")
    rows = interactions(spark, sf).withColumn("g", F.floor(F.col("conv_id") / 500).cast("long"))
    quoted = F.to_json(F.array("response_body"))
    call = F.concat(
        F.lit("- request:\n    method: "), "method", F.lit("\n    uri: "), "uri", F.lit("\n  response:\n    body:\n      string: "),
        F.substring(quoted, F.lit(2), F.length(quoted) - 2),
    )
    heads = rows.select("g", F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("idx"), F.lit("---\nhttp_interactions:").alias("value"))
    lines = rows.select("g", "conv_id", F.col("idx").cast("long").alias("idx"), call.alias("value")).unionByName(heads.distinct())
    lines.repartition("g").sortWithinPartitions("g", "conv_id", "idx").select("g", "value").write.partitionBy("g").text(out)
    calls = readers.read_interactions_split(spark, out, "*.txt").withColumn("cassette", F.regexp_extract("cassette", "^([^/]+)/", 1))
    return costs.calls_with_usage(calls).select(*CALL_COLUMNS)


@query(
    "usage_tokens",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS input, value::BIGINT AS output,
      CASE WHEN event_type = 'click' THEN 7 ELSE CASE WHEN event_type = 'view' THEN 0 ELSE user_id END + value::BIGINT END AS total
    FROM (SELECT event_id, event_type, user_id, floor(value) AS value FROM events)""",
)
def usage_tokens(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    said = F.floor("value").cast("string")
    usage = F.concat(
        F.lit("{"),
        F.when(kind == "view", "").otherwise(F.concat(F.lit('"prompt_tokens": '), user, F.lit(", "))),
        F.when(kind == "click", '"total_tokens": 7, ').otherwise(""),
        F.lit('"completion_tokens": '), said, F.lit("}"),
    )
    return table(spark, sf, "events").select("event_id", pricing.usage_tokens(usage).alias("t")).select("event_id", "t.*")


@query("request_cost", f"WITH {CALLS_SQL} SELECT cassette, idx, {NANO} / 1000000000.0::DOUBLE AS cost FROM calls")
def request_cost(spark, sf):
    calls = costs.calls_with_usage(interactions(spark, sf))
    cost = pricing.request_cost(F.col("input_tokens"), F.col("output_tokens"))
    return calls.select("cassette", "idx", pricing.dollars(cost, 9).alias("cost"))


@query(
    "cassette_costs",
    f"WITH {FILES_SQL} SELECT cassette, input_tokens, output_tokens, total_tokens, requests, micro / 1000000.0::DOUBLE AS total_cost, micro_each / 1000000.0::DOUBLE AS cost_per_request FROM costs",
)
def cassette_costs(spark, sf):
    return tidy(flows.cost_report(interactions(spark, sf))["files"])


@query(
    "cassette_filter",
    f"WITH {FILES_SQL} SELECT cassette, requests FROM costs WHERE regexp_matches(lower(cassette), 'ade|baseline|optimization')",
)
def cassette_filter(spark, sf):
    files = costs.cassette_costs(costs.calls_with_usage(interactions(spark, sf)))
    return costs.cassette_filter(files).select("cassette", "requests")


@query(
    "cost_summary",
    f"""WITH {FILES_SQL}, s AS (SELECT count(*) AS cassettes_analyzed, sum(requests)::BIGINT AS requests, sum(input_tokens)::BIGINT AS input_tokens,
      sum(output_tokens)::BIGINT AS output_tokens, sum(total_tokens)::BIGINT AS total_tokens, sum(micro)::BIGINT AS micro
      FROM costs WHERE regexp_matches(cassette, 'ade|baseline|optimization'))
    SELECT cassettes_analyzed, requests, input_tokens, output_tokens, total_tokens, micro / 1000000.0::DOUBLE AS total_cost,
      {money('input_tokens * 150')} AS input_cost, {money('output_tokens * 600')} AS output_cost,
      round(total_tokens / requests::DOUBLE * 10) / 10 AS avg_tokens_per_request,
      round(micro / 1000000.0::DOUBLE / total_tokens * 1000 * 1000000) / 1000000 AS cost_per_1k_tokens FROM s""",
)
def cost_summary(spark, sf):
    return tidy(flows.cost_report(interactions(spark, sf))["summary"])


@query(
    "cost_rollup",
    f"""WITH {CALLS_SQL} SELECT role, cassette, grouping(role, cassette)::BIGINT AS level, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens,
      count(*) AS requests, {money('sum(i * 150 + o * 600)::BIGINT')} AS total_cost FROM calls GROUP BY ROLLUP (role, cassette)""",
)
def cost_rollup(spark, sf):
    return tidy(costs.cost_rollup(costs.calls_with_usage(interactions(spark, sf)), ["role", "cassette"]))


PHASES_SQL = f"""{FILES_SQL}, p(phase, pattern) AS (VALUES ('baseline', 'baseline_predictor'), ('baseline', 'debug_empty_input'),
    ('optimization', 'ade_reproducibility/optimization'), ('integration', 'ade_pipeline_integration'), ('reproducibility', 'ade_reproducibility')),
  matched AS (SELECT phase, costs.* FROM costs JOIN p ON contains(cassette, pattern)),
  phases AS (SELECT phase, sum(micro)::BIGINT AS micro, sum(requests)::BIGINT AS requests, count(*) AS n_files FROM matched GROUP BY phase)"""


@query("phase_join", f"WITH {PHASES_SQL} SELECT phase, cassette FROM matched")
def phase_join(spark, sf):
    files = costs.cassette_costs(costs.calls_with_usage(interactions(spark, sf)))
    return costs.phase_join(files).select("phase", "cassette")


@query(
    "phase_join_table",
    """WITH p AS (SELECT 'phase ' || page_id % 5 AS phase, substr(url, 9 + (page_id % 20)::INT, 4 + (page_id % 9)::INT) AS pattern FROM pages)
    SELECT phase, cassette, count(*) AS n_patterns FROM p JOIN (SELECT DISTINCT url AS cassette FROM pages) f ON contains(cassette, pattern)
    WHERE pattern <> '' GROUP BY phase, cassette""",
)
def phase_join_table(spark, sf):
    """One pattern cut from each page's address, looked for in all addresses."""
    pages = table(spark, sf, "pages")
    cut = F.expr("substr(url, cast(9 + page_id % 20 as int), cast(4 + page_id % 9 as int))")
    patterns = pages.select(F.concat(F.lit("phase "), (F.col("page_id") % 5).cast("string")).alias("phase"), cut.alias("pattern"))
    # Many pages give the same pattern: it is looked for once and counts as often.
    patterns = patterns.groupBy("phase", "pattern").agg(F.count(F.lit(1)).alias("n"))
    found = rules.match_patterns(pages.select(F.col("url").alias("cassette")).distinct(), patterns, "cassette")
    return found.groupBy("phase", "cassette").agg(F.sum("n").alias("n_patterns"))


@query(
    "phase_costs",
    f"""WITH {PHASES_SQL} SELECT name AS phase, coalesce(micro, 0) / 1000000.0::DOUBLE AS total_cost, coalesce(requests, 0) AS requests,
      coalesce(n_files, 0) AS n_files, coalesce(((micro * 2 + requests) // (requests * 2)) / 1000000.0::DOUBLE, 0) AS cost_per_request
    FROM (SELECT DISTINCT phase AS name FROM p) LEFT JOIN phases ON phase = name""",
)
def phase_costs(spark, sf):
    return tidy(flows.cost_report(interactions(spark, sf))["phases"])


@query(
    "phase_files",
    f"WITH {PHASES_SQL} SELECT phase, cassette, max(requests) AS requests, max(micro) / 1000000.0::DOUBLE AS total_cost, count(*) AS n_matches FROM matched GROUP BY phase, cassette",
)
def phase_files(spark, sf):
    return tidy(flows.cost_report(interactions(spark, sf))["phase_files"])


@query(
    "phase_total",
    f"""WITH {PHASES_SQL}, t AS (SELECT sum(micro)::BIGINT AS m, sum(requests)::BIGINT AS requests, count(*) AS n_files FROM matched)
    SELECT m / 1000000.0::DOUBLE AS total_cost, requests, n_files, ((m * 2 + requests) // (requests * 2)) / 1000000.0::DOUBLE AS cost_per_request FROM t""",
)
def phase_total(spark, sf):
    return tidy(flows.cost_report(interactions(spark, sf))["phase_total"])


@query(
    "cost_recommendations",
    f"""WITH {PHASES_SQL}, t AS (SELECT sum(micro)::BIGINT AS m, max(requests) FILTER (phase = 'reproducibility') AS r FROM phases),
    a AS (SELECT *, regexp_replace(((m + 50) // 100 // 10000) || '.' || lpad(((m + 50) // 100 % 10000)::VARCHAR, 4, '0'), '(\\.[0-9]+?)0+$', '\\1') AS shown FROM t)
    SELECT 1::BIGINT AS rule_no, 'high spending ($' || shown || '): develop on a smaller sample' AS line FROM a WHERE m > 100000
    UNION ALL SELECT 3, r || ' requests repeat earlier runs: record them once' FROM a WHERE r > 20
    UNION ALL SELECT 4, 'spent in all: $' || shown FROM a WHERE m > 0""",
)
def cost_recommendations(spark, sf):
    return flows.cost_report(interactions(spark, sf))["recommendations"]


LEDGER_SQL = """e AS (SELECT *, (props->>'$.k')::BIGINT AS k FROM events)"""


@query(
    "usage_ledger",
    f"""WITH {LEDGER_SQL}, s AS (SELECT event_type, user_id % 2 AS epoch, sum(user_id)::BIGINT AS i, sum(k)::BIGINT AS o, count(*) AS n FROM e GROUP BY ALL)
    SELECT event_type, epoch, i AS input_total, o AS output_total, i + o AS token_total, n AS request_total,
      {money(NANO)} AS cost_total FROM s""",
)
def usage_ledger(spark, sf):
    return tidy(costs.usage_ledger(ledger_calls(spark, sf), ["event_type", "epoch"]))


def ledger_calls(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        (F.col("user_id") % 2).alias("epoch"),
        F.col("user_id").alias("input_tokens"),
        F.get_json_object("props", "$.k").cast("long").alias("output_tokens"),
        F.lit(None).cast("long").alias("total_tokens"),
    )


@query(
    "usage_ledger_running",
    f"""WITH {LEDGER_SQL}, s AS (SELECT event_id, event_type, sum(user_id) OVER w AS i, sum(k) OVER w AS o, count(*) OVER w AS n FROM e
      WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
    SELECT event_id, event_type, i::BIGINT AS input_total, o::BIGINT AS output_total, (i + o)::BIGINT AS token_total, n AS request_total,
      {money(NANO)} AS cost_total FROM s""",
)
def usage_ledger_running(spark, sf):
    running = costs.usage_ledger(ledger_calls(spark, sf), ["event_type"], order="event_id")
    return tidy(
        running.select(
            "event_id", "event_type", "input_total", "output_total", "token_total", "request_total", "cost_total"
        )
    )


def token_events(df, *more):
    return df.select(
        *more,
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("module"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens_input"),
        F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("tokens_output"),
    )


MODULES_SQL = """SELECT CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END AS module, sum((props->>'$.k')::BIGINT)::BIGINT AS input,
  sum(CASE WHEN user_id % 3 > 0 THEN user_id ELSE 0 END)::BIGINT AS output FROM events GROUP BY 1"""


@query("tokens_by_module", MODULES_SQL)
def tokens_by_module(spark, sf):
    return costs.tokens_by_module(token_events(table(spark, sf, "events")))


@query("stream_token_usage", MODULES_SQL)
def stream_token_usage(spark, sf):
    """Events arrive in four files, and a tenth of them a second time."""
    out = scratch_path(spark, "token-usage")
    events = table(spark, sf, "events")
    rows = token_events(events, "event_id", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))).alias("ts"))
    rows.repartition(3).write.parquet(f"{out}/arriving")
    rows.where("event_id % 10 = 3").coalesce(1).write.mode("append").parquet(f"{out}/arriving")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/arriving")
    folds.stream_token_usage(stream, f"{out}/table", f"{out}/checkpoint", horizon="36500 days").awaitTermination()
    return folds.latest_token_usage(spark, f"{out}/table")


@query(
    "stream_late_events",
    """WITH e AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END AS module, (props->>'$.k')::BIGINT AS i,
        CASE WHEN user_id % 3 > 0 THEN user_id ELSE 0 END AS o, ts, event_id % 3 AS b FROM events),
      sent AS (SELECT *, false AS again FROM e UNION ALL SELECT event_id, module, i, o, ts, 2, true FROM e WHERE event_id % 30 = 3),
      cuts AS (SELECT x.b, max(e.ts) - INTERVAL 10 DAY AS cut FROM (VALUES (0), (1), (2)) x(b) LEFT JOIN e ON e.b < x.b GROUP BY x.b),
      judged AS (SELECT s.*, coalesce(s.ts < c.cut, false) AS late FROM sent s JOIN cuts c ON c.b = s.b)
    SELECT module, sum(CASE WHEN NOT late AND (NOT again OR event_id % 7 = 0) THEN i ELSE 0 END)::BIGINT AS input,
      sum(CASE WHEN NOT late AND (NOT again OR event_id % 7 = 0) THEN o ELSE 0 END)::BIGINT AS output,
      count(*) FILTER (late) AS late_events FROM judged GROUP BY module""",
)
def stream_late_events(spark, sf):
    """Three files, ten days of horizon in a month of events; a thirtieth comes again, a seventh has no id."""
    out = scratch_path(spark, "late-events")
    stamp = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))).alias("ts")
    rows = token_events(table(spark, sf, "events"), F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("id"), "event_id", stamp)
    for b in range(3):
        part = rows.where(F.col("event_id") % 3 == b)
        part = part.union(rows.where("event_id % 30 = 3")) if b == 2 else part
        part.drop("event_id").coalesce(1).write.mode("append").parquet(f"{out}/arriving")
    stream = spark.readStream.schema(rows.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/arriving")
    folds.stream_token_usage(stream, f"{out}/table", f"{out}/checkpoint", "10 days", event_id="id").awaitTermination()
    return folds.token_usage_and_late_events(spark, f"{out}/table")


@query(
    "optimizer_cost_estimate",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 50 WHEN 'view' THEN 150 END::BIGINT AS estimated_api_calls,
      CASE event_type WHEN 'click' THEN 0.1::DOUBLE WHEN 'view' THEN 0.3::DOUBLE ELSE 0 END AS estimated_cost,
      CASE event_type WHEN 'click' THEN 'Few-shot optimization' WHEN 'view' THEN 'Bootstrap optimization with candidates' END AS method FROM events""",
)
def optimizer_cost_estimate(spark, sf):
    kind = F.when(F.col("event_type") == "click", "few_shot").when(F.col("event_type") == "view", "bootstrap")
    runs = table(spark, sf, "events").select("event_id", F.coalesce(kind, F.lit("other")).alias("optimizer"))
    return tidy(costs.optimizer_cost_estimate(runs).drop("optimizer"))
