"""Pull-request theming: categories, groups, themes, subthemes and changelog documents.

Membership is kept in long form (one row per pull request); lists of ids are only built in
slices of bounded length, so one theme may own any share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import word_hits
from .ranks import id_rank
from .splits import batch_slices

Rules = Mapping[str, Sequence[str]]

SERVICE_RULES: Rules = {
    "Managed PostgreSQL": ("postgresql", "postgres", "database", "firewall"),
    "GitHub Runners": ("runner", "runners", "github"),
    "Ubicloud Kubernetes": ("kubernetes", "k8s", "nodepool"),
    "AI & GPUs": ("gpu", "gpus", "inference", "model", "ai"),
    "Load Balancers": ("balancer", "balancers"),
    "Compute": ("vm", "vms", "compute", "host", "boot"),
    "Developer Experience": ("cli", "sdk", "api"),
    "Platform Improvements": ("platform", "billing", "console"),
}
CATEGORY_RULES: Rules = {
    "internal_improvement": ("internal", "refactor", "refactors", "refactoring", "cleanup"),
    "customer_facing_not_released": ("flag", "preview", "unreleased", "wip"),
    "bug_fix_maintenance": ("fix", "fixes", "bug", "bump", "docs", "documentation"),
}
GENERIC_WORDS = (
    "managed",
    "enhancements",
    "enhancement",
    "improvements",
    "improvement",
    "features",
    "feature",
    "updates",
    "update",
    "new",
)

STOP_WORDS = ("a", "and", "for", "in", "of", "on", "the", "to", "with")
# Least share of common words (Jaccard) of two theme names that mean one theme.
ALIKE = 0.5


def rule_words(text: Column, *rule_sets: Rules) -> Column:
    """Distinct rule words found in a text: one scan, however many rules there are."""
    words = sorted({w.lower() for rules in rule_sets for listed in rules.values() for w in listed})
    if not words:
        return F.array().cast("array<string>")
    return F.array_distinct(F.transform(word_hits(text, words), F.lower))


def rule_value(found: Column, rules: Rules, default: str | None) -> Column:
    """Name of the first rule with a word among the found ones."""
    chosen = F.lit(default).cast("string")
    for name, words in reversed(list(rules.items())):
        listed = F.array(*[F.lit(w.lower()) for w in words])
        chosen = F.when(F.arrays_overlap(found, listed), F.lit(name)).otherwise(chosen)
    return chosen


def pr_text(title: str = "title", description: str = "description", summary: str = "ellipsis_summary") -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in (title, description, summary)])


def categorize(prs: DataFrame, services: Rules = SERVICE_RULES, categories: Rules = CATEGORY_RULES) -> DataFrame:
    """Add ``category`` and ``service`` from ordered word rules: a row-wise scan, no shuffle."""
    found = F.col("_found")
    return (
        prs.withColumn("_found", rule_words(pr_text(), services, categories))
        .withColumns(
            {
                "category": rule_value(found, categories, fixed.CATEGORIES[0]),
                "service": rule_value(found, services, fixed.SERVICES[-1]),
            }
        )
        .drop("_found")
    )


def customer_facing(
    categorized: DataFrame, shown: Sequence[str] = ("customer_facing_available", "bug_fix_maintenance")
) -> DataFrame:
    """Drop internal and unreleased work."""
    return categorized.filter(F.col("category").isin(*shown))


def id_slices(df: DataFrame, by: Sequence[str], pr: str = "pr", size: int = 1000) -> DataFrame:
    """Sorted id lists of at most ``size`` per group: ``by, part, pr_ids``. Ids must be unique in a group."""
    ranked = id_rank(df.select(*by, pr), pr, by, name="_rank")
    part = F.floor((F.col("_rank") - 1) / size).cast("long")
    return ranked.groupBy(*by, part.alias("part")).agg(F.sort_array(F.collect_list(pr)).alias("pr_ids"))


def group_features(categorized: DataFrame, vocabulary: Sequence[str], size: int = 1000) -> DataFrame:
    """Related pull requests of a service as id lists with a rationale.

    The feature of a pull request is the first vocabulary word, in vocabulary order, in its text;
    one without such a word forms a group of its own.
    """
    topics = {w: (w,) for w in vocabulary}
    alone = F.concat(F.lit("pr "), F.col("pr").cast("string"))
    narrow = categorized.select("service", "pr", rule_words(pr_text(), topics).alias("_found"))
    key = F.coalesce(rule_value(F.col("_found"), topics, None), alone)
    groups = id_slices(narrow.withColumn("feature", key), ["service", "feature"], size=size)
    return groups.withColumn(
        "rationale", F.concat(F.lit("shared topic: "), F.col("feature"), F.lit(" in "), F.col("service"))
    )


def themed_rows(
    prs: DataFrame,
    rules: Rules = SERVICE_RULES,
    descriptions: Mapping[str, str] | None = None,
    default: str = fixed.SERVICES[-1],
    sub_rules: Rules | None = None,
) -> DataFrame:
    """Theme of every pull request, decided where its text is read: ``pr, theme, theme_description``.

    With ``sub_rules`` the subtheme is decided in the same scan and kept as ``subtheme``.
    """
    about = F.concat(F.lit("Changes to "), F.col("theme"))
    for name, text in (descriptions or {}).items():
        about = F.when(F.col("theme") == name, F.lit(text)).otherwise(about)
    found = F.col("_found")
    decided = {"theme": rule_value(found, rules, default)}
    if sub_rules is not None:
        decided["subtheme"] = rule_value(found, sub_rules, "General")
    scanned = prs.withColumn("_found", rule_words(pr_text(), rules, sub_rules or {}))
    kept = [c for c in ("month", "year") if c in prs.columns]
    narrow = scanned.select("pr", *kept, *[c.alias(n) for n, c in decided.items()])
    return narrow.withColumn("theme_description", about)


def assign_themes(
    prs: DataFrame,
    rules: Rules = SERVICE_RULES,
    batch_size: int = 5,
    descriptions: Mapping[str, str] | None = None,
    default: str = fixed.SERVICES[-1],
    sub_rules: Rules | None = None,
) -> DataFrame:
    """Map every pull request of every batch to one theme: ``batch_no, theme, theme_description, pr``."""
    narrow = themed_rows(prs, rules, descriptions, default, sub_rules)
    extra = [] if sub_rules is None else ["subtheme"]
    return batch_slices(narrow, "pr", batch_size).select("batch_no", "theme", "theme_description", "pr", *extra)


def batch_theme_lists(mapping: DataFrame) -> DataFrame:
    """Theme id lists per batch; a list is never longer than the batch."""
    return mapping.groupBy("batch_no", "theme", "theme_description").agg(
        F.sort_array(F.collect_list("pr")).alias("pr_ids")
    )


def theme_key(name: Column, generic: Sequence[str] = GENERIC_WORDS) -> Column:
    """Similarity key of a theme name: its distinct specific words, singular and sorted."""
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*STOP_WORDS))
    specific = F.filter(words, lambda w: ~w.isin(*generic))
    kept = F.when(F.size(specific) > 0, specific).otherwise(words)
    singular = F.transform(kept, lambda w: F.regexp_replace(w, "(?<=[^s]{2})s$", ""))
    return F.array_join(F.sort_array(F.array_distinct(singular)), " ")


def theme_names(rows: DataFrame) -> DataFrame:
    """One name and description per theme key: the earliest ``origin`` wins."""
    first = F.min(F.struct("origin", "theme", "theme_description"))
    return rows.groupBy("theme_key").agg(first.alias("_f")).select("theme_key", "_f.*")


def alike_keys(names: DataFrame, alike: float = ALIKE) -> DataFrame:
    """Pairs of different theme keys whose words agree in the share ``alike``: ``theme_key, other``.

    Keys meet by their rarest words only: of n words, n - ceil(alike n) + 1 suffice to miss no pair, so a word
    that most names have forms no block of all of them.
    """
    words = names.select("theme_key", F.explode(F.split("theme_key", " ")).alias("w"))
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # A key has few words: they are listed again beside how common each is.
    ranked = words.join(counts, "w").groupBy("theme_key").agg(F.sort_array(F.collect_list(F.struct("n", "w"))).alias("ws"))
    ws = F.transform("ws", lambda x: x["w"])
    prefix = F.slice(ws, 1, (F.size(ws) - F.ceil(F.size(ws) * F.lit(alike)) + 1).cast("int"))
    keyed = ranked.select("theme_key", ws.alias("ws"), F.explode(prefix).alias("w"))
    a, b = keyed.alias("a"), keyed.alias("b")
    common = F.size(F.array_intersect("a.ws", "b.ws"))
    close = common >= F.lit(alike) * (F.size("a.ws") + F.size("b.ws") - common)
    meet = (F.col("a.w") == F.col("b.w")) & (F.col("a.theme_key") != F.col("b.theme_key")) & close
    return a.join(b, meet).select("a.theme_key", F.col("b.theme_key").alias("other")).distinct()


def theme_leaders(names: DataFrame, alike: float = ALIKE) -> DataFrame:
    """The theme each key belongs to: ``theme_key, leader, theme, theme_description, origin``.

    In the order of ``origin`` and key, a key that is alike no earlier one leads a theme; another one joins
    the earliest leader it is alike, or leads its own if it is only alike keys that joined others. A
    later name therefore never changes an earlier theme. ``names`` is one row per key (``theme_names``).
    """
    place = names.select("theme_key", F.struct("origin", "theme_key").alias("at"))
    pairs = (
        alike_keys(names, alike)
        .join(place, "theme_key")
        .join(place.select(F.col("theme_key").alias("other"), F.col("at").alias("other_at")), "other")
        .where("other_at < at")
    )
    followers = pairs.select("theme_key").distinct()
    leaders = names.select(F.col("theme_key").alias("other")).join(followers.withColumnRenamed("theme_key", "other"), "other", "left_anti")
    joined = pairs.join(leaders, "other").groupBy("theme_key").agg(F.min("other_at").alias("_l"))
    led = names.select("theme_key").join(joined, "theme_key", "left")
    led = led.select("theme_key", F.coalesce("_l.theme_key", "theme_key").alias("leader"))
    return led.join(names.withColumnRenamed("theme_key", "leader"), "leader").select(
        "theme_key", "leader", "theme", "theme_description", "origin"
    )


def merge_themes(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two theme maps (``theme, theme_description, pr``): similar names become one theme.

    The existing name wins, ids are distinct, unrelated themes stay apart:
    ``theme_key, theme, theme_description, pr``.
    """
    rows = existing.select("theme", "theme_description", "pr", F.lit(0).alias("origin")).unionByName(
        new.select("theme", "theme_description", "pr", F.lit(1).alias("origin"))
    )
    return merged_view(rows)


def with_theme_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("theme_key", F.coalesce(theme_key(F.col("theme")), F.lit("")))


def merged_view(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Merged themes from contributions with an ``origin`` order; ``keep`` adds member columns.

    Names are few beside members: AQE broadcasts them when they are small, and else splits the partition
    of a theme that owns most members.
    """
    keyed = with_theme_key(rows)
    return named_members(keyed, theme_leaders(theme_names(keyed)), keep)


def named_members(keyed: DataFrame, leaders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Members under the key and name of their theme, each once."""
    named = keyed.select("theme_key", "pr", *keep).join(leaders, "theme_key")
    return named.select(F.col("leader").alias("theme_key"), "theme", "theme_description", "pr", *keep).distinct()


def theme_details(members: DataFrame, prs: DataFrame) -> DataFrame:
    """Theme members with their pull-request rows; unknown ids keep a null title."""
    return members.join(prs, "pr", "left")


def subthemes(details: DataFrame, rules: Rules, default: str = "General") -> DataFrame:
    """Add a subtheme to every themed pull request; every theme gets at least one."""
    scanned = details.withColumn("_found", rule_words(pr_text(), rules))
    return scanned.withColumn("subtheme", rule_value(F.col("_found"), rules, default)).drop("_found")


def render_changelog(
    themed: DataFrame, month: str | None = None, year: int | None = None, ids_per_list: int = 1000, as_attribute: bool = True
) -> DataFrame:
    """Changelog pieces of every document: ``document, theme, subtheme, part, block``.

    ``themed`` holds ``theme, theme_description, subtheme, pr``, and ``month`` and ``year`` unless one month
    is given. Pieces in the order of the first four columns, one after the other, are the document
    (``changelog_text``): each brings the blank line before it, and the ids of a large subtheme, cut into
    parts of ``ids_per_list``, are one list whatever the size of the parts.
    """
    if month is None:
        themed = themed.withColumn("document", F.concat_ws(" ", "month", "year"))
        names = themed.select("document").distinct()
    else:
        themed = themed.withColumn("document", F.lit(f"{month} {year}"))
        names = themed.sparkSession.range(1).select(F.lit(f"{month} {year}").alias("document"))

    def pieces(df: DataFrame, theme: Column, subtheme: Column, block: Column) -> DataFrame:
        part = F.col("part") if "part" in df.columns else F.lit(0).cast("long")
        return df.select("document", theme.alias("theme"), subtheme.alias("subtheme"), part.alias("part"), block.alias("block"))

    none = F.lit("")
    title = F.concat(F.lit('---\ntitle: "'), F.col("document"), F.lit('"\n---\n\nimport { PrList } from "@components/PrList"'))
    titles = themed.groupBy("document", "theme").agg(F.min("theme_description").alias("about"))
    about = F.concat(F.lit("\n\n## "), F.col("theme"), F.lit("\n\n"), F.col("about"))
    start, end = ("<PrList ids={[", "]}></PrList>") if as_attribute else ("<PrList>{[", "]}</PrList>")
    by = ["document", "theme", "subtheme"]
    slices = id_slices(themed, by, size=ids_per_list)
    slices = slices.withColumn("_last", F.max("part").over(Window.partitionBy(*by)))
    opened = F.concat(F.lit("\n\n### "), F.col("subtheme"), F.lit("\n\n" + start))
    listed = F.concat(
        F.when(F.col("part") == 0, opened).otherwise(", "),
        F.array_join(F.col("pr_ids").cast("array<string>"), ", "),
        F.when(F.col("part") == F.col("_last"), F.lit(end)).otherwise(""),
    )
    head = pieces(names, none, none, title)
    return head.unionByName(pieces(titles, F.col("theme"), none, about)).unionByName(
        pieces(slices, F.col("theme"), F.col("subtheme"), listed)
    )


def changelog_blocks(pieces: DataFrame) -> DataFrame:
    """Whole headings and lists in place of their parts: ``document, theme, subtheme, block``."""
    rows = F.sort_array(F.collect_list(F.struct("part", "block")))
    return pieces.groupBy("document", "theme", "subtheme").agg(
        F.array_join(F.transform(rows, lambda r: r["block"]), "").alias("block")
    )


def changelog_text(pieces: DataFrame) -> DataFrame:
    """Every document as one text: ``document, n_blocks, text``."""
    rows = F.sort_array(F.collect_list(F.struct("theme", "subtheme", "part", "block")))
    return pieces.groupBy("document").agg(
        F.count_if(F.col("part") == 0).alias("n_blocks"),
        F.array_join(F.transform(rows, lambda r: r["block"]), "").alias("text"),
    )


def document_ids(documents: DataFrame, text: str = "text") -> Column:
    """All numbers inside the id lists of a document, distinct and sorted; a list may begin or end at the text's edge."""
    lists = F.regexp_extract_all(F.col(text), F.lit(r"(?:\[|^)([0-9, ]*)(?:\]|$)"), 1)
    numbers = F.flatten(F.transform(lists, lambda s: F.split(s, r"\s*,\s*")))
    kept = F.array_compact(F.transform(numbers, lambda s: s.try_cast("bigint")))
    return F.sort_array(F.array_distinct(kept))


def missing_ids(documents: DataFrame, expected: DataFrame, by: str = "document", pr: str = "pr", text: str = "text") -> DataFrame:
    """Ids of ``expected`` (``by, pr``) that their document does not list, one row each.

    A document may come in pieces; the ids of all its pieces count.
    """
    listed = documents.select(by, F.explode(document_ids(documents, text)).alias(pr))
    return expected.select(by, pr).distinct().join(listed, [by, pr], "left_anti")


def document_coverage(documents: DataFrame, expected: DataFrame, by: str = "document", pr: str = "pr", text: str = "text") -> DataFrame:
    """Per document with expected ids: how many, how many are missing, and whether it has them all."""
    missing = missing_ids(documents, expected, by, pr, text).groupBy(by).agg(F.count(F.lit(1)).alias("n_missing"))
    wanted = expected.select(by, pr).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("n_expected"))
    found = wanted.join(missing, by, "left").withColumn("n_missing", F.coalesce("n_missing", F.lit(0)))
    return found.withColumn("covers_all", F.col("n_missing") == 0)


def assemble_document(
    sections: DataFrame,
    by: Sequence[str],
    pos: str,
    heading: str,
    content: str,
    sections_per_part: int = 10_000,
) -> DataFrame:
    """Sections in order as ``## heading`` blocks joined by blank lines: ``by, part, text``.

    Parts follow the position: storage units of a document of any length, which ``join_parts`` puts together.
    """
    block = F.concat(F.lit("## "), F.col(heading), F.lit("\n\n"), F.col(content))
    part = F.floor(F.col(pos) / sections_per_part).cast("long")
    rows = F.collect_list(F.struct(F.col(pos).alias("p"), block.alias("b")))
    return sections.groupBy(*by, part.alias("part")).agg(
        F.array_join(F.transform(F.sort_array(rows), lambda r: r["b"]), "\n\n").alias("text")
    )


def join_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Whole documents from the parts of ``assemble_document``; the same text whatever the part size."""
    rows = F.sort_array(F.collect_list(F.struct("part", "text")))
    return parts.groupBy(*by).agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n\n").alias("text"))
