"""Pull-request theming and documents. Parts and documents stand in for pull requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import rules, themes
from tallyloom.plans import flows
from tallyloom.session import scratch_path
from tallyloom.streaming import folds

from .base import query, table


def part_requests(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("pr"),
        F.col("p_name").alias("title"),
        F.lower("p_type").alias("description"),
        F.col("p_brand").alias("ellipsis_summary"),
    )


def document_requests(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("pr"),
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.lit("").alias("ellipsis_summary"),
    )


def rule_sql(text: str, rules: dict, default: str) -> str:
    tokens = rf"list_transform(regexp_extract_all({text}, '[\p{{L}}\p{{M}}\p{{N}}_]+'), lambda w: lower(w))"
    cases = " ".join(
        f"WHEN list_has_any({tokens}, [{', '.join(repr(w) for w in words)}]) THEN '{name}'" for name, words in rules.items()
    )
    return f"CASE {cases} ELSE {default} END"


SERVICES = {"Managed PostgreSQL": ("der", "und"), "GitHub Runners": ("la", "que"), "Compute": ("the", "of")}
CATEGORIES = {"internal_improvement": ("von", "avec", "with"), "bug_fix_maintenance": ("in", "en")}
DOC_TEXT = "source || ' ' || text || ' '"
CATEGORIZED_SQL = f"""categorized AS (SELECT doc_id AS pr, {rule_sql(DOC_TEXT, CATEGORIES, "'customer_facing_available'")} AS category,
    {rule_sql(DOC_TEXT, SERVICES, "'Other'")} AS service FROM documents)"""


@query("categorize", f"WITH {CATEGORIZED_SQL} SELECT pr, category, service FROM categorized")
def categorize(spark, sf):
    return themes.categorize(document_requests(spark, sf), SERVICES, CATEGORIES).select("pr", "category", "service")


WORD_RULES_SQL = r"""tokens AS (SELECT DISTINCT pr, token FROM (SELECT doc_id AS pr, unnest(list_transform(
      regexp_extract_all(source || ' ' || text || ' ', '[\p{L}\p{M}\p{N}_]+'), lambda w: lower(w))) AS token FROM documents)),
  words AS (SELECT DISTINCT token, md5(token) AS h FROM tokens WHERE length(token) >= 4),
  word_rules AS (SELECT 'service' AS kind, token, 'service ' || substr(h, 31, 2) AS value, h AS priority FROM words
    UNION ALL SELECT 'category', token, 'category ' || substr(h, 1, 2), h FROM words WHERE h < '4' AND length(token) >= 6),
  picked AS (SELECT pr, min_by(value, priority) FILTER (kind = 'service') AS service, min_by(value, priority) FILTER (kind = 'category') AS category
    FROM tokens JOIN word_rules USING (token) GROUP BY pr)"""


@query(
    "categorize_table",
    f"""WITH {WORD_RULES_SQL} SELECT doc_id AS pr, coalesce(category, 'customer_facing_available') AS category, coalesce(service, 'Other') AS service
    FROM documents LEFT JOIN picked ON pr = doc_id""",
)
def categorize_table(spark, sf):
    """One rule for each word of at least four letters in the documents, some hundred thousand at sf0.1."""
    requests = document_requests(spark, sf)
    found = F.regexp_extract_all(F.lower(themes.pr_text()), F.lit(rules.TOKEN), 0)
    words = requests.select(F.explode(found).alias("token")).where(F.length("token") >= 4).distinct().withColumn("priority", F.md5("token"))
    services = words.select(F.lit("service").alias("kind"), "token", F.concat(F.lit("service "), F.substring("priority", 31, 2)).alias("value"), "priority")
    categories = words.where("priority < '4' and length(token) >= 6")
    categories = categories.select(F.lit("category"), "token", F.concat(F.lit("category "), F.substring("priority", 1, 2)), "priority")
    defaults = {"category": "customer_facing_available", "service": "Other"}
    return rules.decide(requests, services.union(categories), themes.pr_text(), "pr", defaults).select("pr", "category", "service")


@query(
    "customer_facing",
    f"WITH {CATEGORIZED_SQL} SELECT pr, category FROM categorized WHERE category <> 'internal_improvement'",
)
def customer_facing(spark, sf):
    categorized = themes.categorize(document_requests(spark, sf), SERVICES, CATEGORIES)
    return themes.customer_facing(categorized).select("pr", "category")


PART_SERVICES = {"Compute": ("gear", "bolt"), "Load Balancers": ("ring",), "AI & GPUs": ("widget", "plate")}
VOCABULARY = ("economy", "large", "promo")
PART_TEXT = "p_name || ' ' || lower(p_type) || ' ' || p_brand"


def ids_sql(column: str = "pr") -> str:
    return f"string_agg({column}::VARCHAR, ',' ORDER BY {column})"


@query(
    "group_features",
    f"""WITH c AS (SELECT p_partkey AS pr, {rule_sql(PART_TEXT, PART_SERVICES, "'Other'")} AS service,
      {rule_sql(PART_TEXT, {w: (w,) for w in VOCABULARY}, "'pr ' || p_partkey")} AS feature FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY service, feature ORDER BY pr) - 1 AS n FROM c)
    SELECT service, feature, n // 50 AS part, {ids_sql()} AS pr_ids, 'shared topic: ' || feature || ' in ' || service AS rationale
    FROM r GROUP BY ALL""",
)
def group_features(spark, sf):
    categorized = themes.categorize(part_requests(spark, sf), PART_SERVICES, CATEGORIES)
    groups = themes.group_features(categorized, VOCABULARY, size=50)
    return groups.withColumn("pr_ids", F.array_join("pr_ids", ","))


THEMES = {"Metal Rings": ("ring", "rod"), "Flat Plates": ("plate",), "Widgets": ("widget", "gear")}
THEME_SQL = f"{rule_sql(PART_TEXT, THEMES, chr(39) + 'Other' + chr(39))}"
ASSIGNED_SQL = f"""assigned AS (SELECT p_partkey AS pr, (row_number() OVER (ORDER BY p_partkey) - 1) // 30 AS batch_no, {THEME_SQL} AS theme FROM part)"""


@query(
    "assign_themes",
    f"""WITH {ASSIGNED_SQL} SELECT batch_no, theme, 'Changes to ' || theme AS theme_description, {ids_sql()} AS pr_ids FROM assigned GROUP BY batch_no, theme""",
)
def assign_themes(spark, sf):
    mapping = themes.assign_themes(part_requests(spark, sf), THEMES, 30)
    return themes.batch_theme_lists(mapping).withColumn("pr_ids", F.array_join("pr_ids", ","))


def _older(spark, sf):
    """Themes of suppliers under other spellings of the same names."""
    spelled = (
        F.when(F.col("s_suppkey") % 3 == 0, "Managed Metal Ring")
        .when(F.col("s_suppkey") % 3 == 1, "Plate, Flat Enhancements")
        .otherwise("Widget Cables")
    )
    return table(spark, sf, "supplier").select(
        spelled.alias("theme"), F.lit("older").alias("theme_description"), F.col("s_suppkey").alias("pr")
    )


MERGED_SQL = f"""{ASSIGNED_SQL}, older AS (SELECT s_suppkey AS pr, s_suppkey % 3 AS t FROM supplier),
  both_ AS (SELECT pr, CASE t WHEN 0 THEN 'metal ring' WHEN 1 THEN 'flat plate' ELSE 'cable widget' END AS theme_key FROM older
    UNION SELECT pr, CASE theme WHEN 'Metal Rings' THEN 'metal ring' WHEN 'Flat Plates' THEN 'flat plate' WHEN 'Widgets' THEN 'cable widget' ELSE 'other' END FROM assigned),
  merged AS (SELECT pr, theme_key, CASE theme_key WHEN 'metal ring' THEN 'Managed Metal Ring' WHEN 'flat plate' THEN 'Plate, Flat Enhancements'
    WHEN 'cable widget' THEN 'Widget Cables' ELSE 'Other' END AS theme FROM both_)"""


@query("merge_themes", f"WITH {MERGED_SQL} SELECT theme_key, theme, pr, CASE WHEN theme = 'Other' THEN 'Changes to ' || theme ELSE 'older' END AS theme_description FROM merged")
def merge_themes(spark, sf):
    new = themes.assign_themes(part_requests(spark, sf), THEMES, 30)
    return themes.merge_themes(_older(spark, sf), new)


@query(
    "theme_details",
    f"WITH {MERGED_SQL} SELECT theme_key, pr, p_name AS title FROM merged LEFT JOIN part ON p_partkey = pr",
)
def theme_details(spark, sf):
    new = themes.assign_themes(part_requests(spark, sf), THEMES, 30)
    merged = themes.merge_themes(_older(spark, sf), new)
    return themes.theme_details(merged, part_requests(spark, sf)).select("theme_key", "pr", "title")


SUBTHEMES = {"Economy": ("economy",), "Promotions": ("promo",)}
SUB_SQL = rule_sql(PART_TEXT, SUBTHEMES, "'General'")


@query(
    "subthemes",
    f"""SELECT {THEME_SQL} AS theme, {SUB_SQL} AS subtheme, count(*) AS n_prs, min(p_partkey) AS first_pr FROM part GROUP BY ALL""",
)
def subthemes(spark, sf):
    mapping = themes.assign_themes(part_requests(spark, sf), THEMES, 30)
    themed = themes.subthemes(themes.theme_details(mapping, part_requests(spark, sf)), SUBTHEMES)
    return themed.groupBy("theme", "subtheme").agg(
        F.count(F.lit(1)).alias("n_prs"), F.min("pr").alias("first_pr")
    )


HEAD_SQL = """'---' || chr(10) || 'title: "' || document || '"' || chr(10) || '---' || chr(10) || chr(10) || 'import { PrList } from "@components/PrList"'"""
LIST_SQL = """CASE WHEN part = 0 THEN chr(10) || chr(10) || '### ' || subtheme || chr(10) || chr(10) || '<PrList ids={[' ELSE ', ' END
  || string_agg(pr::VARCHAR, ', ' ORDER BY pr) || CASE WHEN part = last THEN ']}></PrList>' ELSE '' END"""


def blocks_sql(document: str) -> str:
    return f"""t AS (SELECT p_partkey AS pr, {document} AS document, {THEME_SQL} AS theme, {SUB_SQL} AS subtheme FROM part),
  n AS (SELECT *, (row_number() OVER (PARTITION BY document, theme, subtheme ORDER BY pr) - 1) // 1000 AS part FROM t),
  r AS (SELECT *, max(part) OVER (PARTITION BY document, theme, subtheme) AS last FROM n),
  blocks AS (SELECT DISTINCT document, '' AS theme, '' AS subtheme, 0 AS part, {HEAD_SQL} AS block FROM t
    UNION ALL SELECT DISTINCT document, theme, '', 0, chr(10) || chr(10) || '## ' || theme || chr(10) || chr(10) || 'Changes to ' || theme FROM t
    UNION ALL SELECT document, theme, subtheme, part, {LIST_SQL} FROM r GROUP BY document, theme, subtheme, part, last)"""


BLOCKS_SQL = blocks_sql("'May 2025'")
MONTHS = ("January", "February", "March", "April")
MONTH_SQL = "['" + "', '".join(MONTHS) + "'][p_size % 4 + 1] || ' ' || (2024 + p_size % 3)"


def _blocks(spark, sf):
    return flows.changelog(
        part_requests(spark, sf), "May", 2025, THEMES, SUBTHEMES, internal_hidden=False
    )


def _monthly(spark, sf):
    size = table(spark, sf, "part").select(
        F.col("p_partkey").alias("pr"),
        F.element_at(F.array(*map(F.lit, MONTHS)), (F.col("p_size") % 4).cast("int") + 1).alias("month"),
        (F.col("p_size") % 3 + 2024).alias("year"),
    )
    return flows.changelog(part_requests(spark, sf).join(size, "pr"), None, None, THEMES, SUBTHEMES, False)


@query(
    "render_changelog",
    f"WITH {BLOCKS_SQL} SELECT document, theme, subtheme, part::BIGINT AS part, md5(block) AS block_md5 FROM blocks",
)
def render_changelog(spark, sf):
    return _blocks(spark, sf).select("document", "theme", "subtheme", "part", F.md5("block").alias("block_md5"))


TEXT_SQL = """SELECT document, count(*) FILTER (part = 0) AS n_blocks,
      md5(string_agg(block, '' ORDER BY theme, subtheme, part)) AS text_md5 FROM blocks GROUP BY document"""


@query("changelog_text", f"WITH {BLOCKS_SQL} {TEXT_SQL}")
def changelog_text(spark, sf):
    return themes.changelog_text(_blocks(spark, sf)).select("document", "n_blocks", F.md5("text").alias("text_md5"))


@query("monthly_changelogs", f"WITH {blocks_sql(MONTH_SQL)} {TEXT_SQL}")
def monthly_changelogs(spark, sf):
    return themes.changelog_text(_monthly(spark, sf)).select("document", "n_blocks", F.md5("text").alias("text_md5"))


@query(
    "document_coverage",
    f"""WITH {blocks_sql(MONTH_SQL)}, e AS (SELECT DISTINCT document, pr FROM t UNION SELECT 'January 2024', -1000000 * s_suppkey FROM supplier
        UNION SELECT 'April 2026', s_suppkey FROM supplier)
    SELECT e.document, count(*) AS n_expected, count(*) FILTER (t.pr IS NULL) AS n_missing, count(*) FILTER (t.pr IS NULL) = 0 AS covers_all
    FROM e LEFT JOIN t ON t.document = e.document AND t.pr = e.pr GROUP BY e.document""",
)
def document_coverage(spark, sf):
    month = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, MONTHS)), (F.col("p_size") % 4).cast("int") + 1), F.col("p_size") % 3 + 2024)
    supplier = table(spark, sf, "supplier")
    expected = (
        table(spark, sf, "part").select(month.alias("document"), F.col("p_partkey").alias("pr"))
        .union(supplier.select(F.lit("January 2024"), -1_000_000 * F.col("s_suppkey")))
        .union(supplier.select(F.lit("April 2026"), "s_suppkey"))
    )
    return themes.document_coverage(_monthly(spark, sf), expected, text="block")


@query(
    "assemble_document",
    """SELECT conv_id, turn // 10000 AS part, md5(string_agg('## ' || role || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn)) AS text_md5
    FROM conversations GROUP BY ALL""",
)
def assemble_document(spark, sf):
    made = themes.assemble_document(table(spark, sf, "conversations"), ["conv_id"], "turn", "role", "text")
    return made.select("conv_id", "part", F.md5("text").alias("text_md5"))


@query(
    "joined_document",
    """SELECT conv_id, md5(string_agg('## ' || role || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn)) AS text_md5
    FROM conversations GROUP BY ALL""",
)
def joined_document(spark, sf):
    parts = themes.assemble_document(table(spark, sf, "conversations"), ["conv_id"], "turn", "role", "text", sections_per_part=3)
    return themes.join_parts(parts, ["conv_id"]).select("conv_id", F.md5("text").alias("text_md5"))


@query(
    "stream_merge_themes",
    """WITH a AS (SELECT p_partkey AS pr, """
    + THEME_SQL
    + """ AS theme FROM part)
    SELECT theme, 'Changes to ' || theme AS theme_description, pr FROM a""",
)
def stream_merge_themes(spark, sf):
    """Three files arrive one after the other."""
    out = scratch_path(spark, "themes")
    rows = part_requests(spark, sf)
    rows.repartition(3).write.parquet(f"{out}/arriving")
    prs = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/arriving")
    folds.stream_merge_themes(prs, f"{out}/table", f"{out}/checkpoint", THEMES, 30).awaitTermination()
    return folds.accumulated_themes(spark, f"{out}/table").select("theme", "theme_description", "pr")
