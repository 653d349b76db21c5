from collections import Counter

from pyspark.sql import functions as F

from tallyloom.operators import themes
from tallyloom.plans import flows
from tallyloom.sources import writers

from .conftest import collected

PRS = [
    (3170, "Add PostgreSQL metrics dashboard", "Implements built-in metrics", "Added metrics"),
    (3202, "Enhance metrics API endpoints", "New endpoints for PostgreSQL metrics", ""),
    (3248, "Implement firewall rule management", "UI for PostgreSQL firewall rules", ""),
    (3274, "Add IP allowlist validation", "Validates addresses in firewall rules", ""),
    (3312, "GitHub runner performance", "Optimizes runner startup", ""),
    (3366, "Add runner location preferences", "Locations for runners", ""),
    (3001, "Refactor internal logging system", "Refactors the internal logging", ""),
]
SCHEMA = "pr long, title string, description string, ellipsis_summary string"
NAMES = {"Managed PostgreSQL": ("postgresql", "firewall"), "GitHub Runners": ("runner", "runners")}


def prs(rows, data=PRS):
    return rows(data, SCHEMA)


def test_categories_and_services(rows):
    got = {r["pr"]: (r["category"], r["service"]) for r in themes.categorize(prs(rows)).collect()}
    assert got[3170] == ("customer_facing_available", "Managed PostgreSQL")
    assert got[3001][0] == "internal_improvement"
    assert got[3312][1] == "GitHub Runners"
    unclear = themes.categorize(rows([(9999, "Update documentation", "Updates some docs", "")], SCHEMA)).first()
    assert unclear["service"] == "Other"
    shown = {r["pr"] for r in themes.customer_facing(themes.categorize(prs(rows))).collect()}
    assert 3001 not in shown and 3170 in shown


def test_groups(rows):
    data = [
        (3366, "Add inline edit functionality for PostgreSQL firewall rules", "", ""),
        (3367, "Fix PostgreSQL firewall rule validation", "", ""),
        (3400, "PostgreSQL upgrade", "", ""),
    ]
    got = themes.group_features(themes.categorize(rows(data, SCHEMA)), ["firewall", "metrics"])
    assert {tuple(r["pr_ids"]) for r in got.collect()} == {(3366, 3367), (3400,)}


def test_themes_per_batch(rows):
    mapping = themes.assign_themes(prs(rows), NAMES, batch_size=6)
    by_pr = {r["pr"]: r["theme"] for r in mapping.collect()}
    assert by_pr[3170] == by_pr[3202] == by_pr[3248] == by_pr[3274] == "Managed PostgreSQL"
    assert by_pr[3312] == by_pr[3366] == "GitHub Runners" and by_pr[3001] == "Other"
    lists = themes.batch_theme_lists(mapping).filter("theme = 'GitHub Runners'").collect()
    assert sum(len(r["pr_ids"]) for r in lists) == 2
    ten = rows([(i, "t", "", "") for i in range(10)], SCHEMA)
    assert Counter(r["batch_no"] for r in themes.assign_themes(ten, NAMES, 3).collect()) == {0: 3, 1: 3, 2: 3, 3: 1}


THEME = "theme string, theme_description string, pr long"


def test_similar_themes_merge(rows):
    old = rows([("Managed PostgreSQL", "Database management", i) for i in (3000, 3001)], THEME)
    new = rows(
        [("PostgreSQL Enhancements", "New features", i) for i in (3170, 3001)]
        + [("GitHub Runners", "Runner improvements", i) for i in (3312, 3366)],
        THEME,
    )
    merged = themes.merge_themes(old, new).collect()
    assert {r["pr"] for r in merged if r["theme"] == "Managed PostgreSQL"} == {3000, 3001, 3170}
    assert {r["pr"] for r in merged if r["theme"] == "GitHub Runners"} == {3312, 3366}
    assert len(merged) == 5 and {r["theme_description"] for r in merged} == {"Database management", "Runner improvements"}


def test_name_keys(rows):
    names = rows([("GitHub Runner",), ("Runners, GitHub improvements",), ("New Features",), ("Access",)], "n string")
    got = [r[0] for r in names.select(themes.theme_key(F.col("n"))).collect()]
    assert got == ["github runner", "github runner", "feature new", "access"]


def test_changelog_document(rows):
    blocks = flows.changelog(prs(rows), "May", 2025, NAMES, {"Firewall": ("firewall",)})
    text = themes.changelog_text(blocks).first()["text"]
    assert text.startswith('---\ntitle: "May 2025"\n---\n\nimport { PrList }')
    assert "## Managed PostgreSQL" in text and "### Firewall" in text and "### General" in text
    assert "<PrList ids={[3248, 3274]}></PrList>" in text and "3001" not in text
    sections = text.split("\n## ")[1:]
    assert len(sections) == 2 and all("\n### " in s for s in sections)
    wanted = rows([("May 2025", 3170), ("May 2025", 3366), ("June 2025", 1)], "document string, pr long")
    for documents, column in ((themes.changelog_text(blocks), "text"), (blocks, "block")):
        got = collected(themes.document_coverage(documents, wanted, text=column), "document")
        assert got == [("June 2025", 1, 1, False), ("May 2025", 2, 0, True)]
    lacking = themes.missing_ids(blocks, rows([("May 2025", 3170), ("May 2025", 3001)], "document string, pr long"), text="block")
    assert collected(lacking) == [("May 2025", 3001)]


def test_part_size_leaves_no_trace(spark, rows, tmp_path):
    themed = rows([("T", "about", "S", i) for i in range(25)] + [("T", "about", "R", 7)], "theme string, theme_description string, subtheme string, pr long")
    texts, written = [], []
    for size in (3, 10, 1000):
        pieces = themes.render_changelog(themed, "May", 2025, ids_per_list=size, as_attribute=False)
        assert pieces.filter("subtheme = 'S'").count() == -(-25 // size)
        row = themes.changelog_text(pieces).first()
        assert row["n_blocks"] == 4 and row["text"].endswith("### S\n\n<PrList>{[" + ", ".join(map(str, range(25))) + "]}</PrList>")
        texts.append(row["text"])
        writers.write_blocks(pieces, str(tmp_path / f"out{size}"))
        files = sorted((tmp_path / f"out{size}").glob("document=*/part-*.txt"))
        written.append(b"".join(f.read_bytes() for f in files))
        covered = themes.document_coverage(pieces, themed.selectExpr("'May 2025' as document", "pr"), text="block").first()
        assert covered["covers_all"] is True and covered["n_expected"] == 25
    assert len(set(texts)) == len(set(written)) == 1
    assert written[0].decode().rstrip("\n") == texts[0]


def test_one_document_per_month(rows):
    data = [(i, f"t{i}", "", "", ["May", "June"][i % 2], 2025) for i in range(6)]
    blocks = flows.changelog(rows(data, SCHEMA + ", month string, year int"), rules=NAMES, internal_hidden=False)
    got = dict(themes.changelog_text(blocks).select("document", "text").collect())
    assert set(got) == {"May 2025", "June 2025"}
    assert got["May 2025"].endswith("<PrList ids={[0, 2, 4]}></PrList>") and 'title: "June 2025"' in got["June 2025"]


def test_near_names_merge(rows):
    def merged(old, new):
        both = themes.merge_themes(rows([(n, "old", i) for i, n in enumerate(old)], THEME), rows([(n, "new", 100 + i) for i, n in enumerate(new)], THEME))
        return {r["pr"]: r["theme"] for r in both.collect()}

    assert merged(["PostgreSQL Backups"], ["PostgreSQL Backup and Restore"]) == {0: "PostgreSQL Backups", 100: "PostgreSQL Backups"}
    assert merged(["GitHub Runners"], ["GitHub Runner Caching"]) == {0: "GitHub Runners", 100: "GitHub Runners"}
    assert merged(["GitHub Runners"], ["GitHub Login", "Billing Page"])[101] == "Billing Page"
    # A hot word alone brings no names together.
    many = [f"cloud topic{i} item{i}" for i in range(60)]
    assert len(set(merged(many, ["cloud"]).values())) == 61


def test_details_keep_unknown_ids(rows):
    members = rows([("k", 3170), ("k", 1)], "theme_key string, pr long")
    got = collected(themes.theme_details(members, prs(rows)).select("pr", "title"), "pr")
    assert got == [(1, None), (3170, "Add PostgreSQL metrics dashboard")]


def test_documents(rows):
    sections = rows([("d", 1, "B", "two"), ("d", 0, "A", "one"), ("e", 0, "C", "x")], "doc string, pos long, h string, c string")
    got = dict(themes.assemble_document(sections, ["doc"], "pos", "h", "c").select("doc", "text").collect())
    assert got == {"d": "## A\n\none\n\n## B\n\ntwo", "e": "## C\n\nx"}
    parts = themes.assemble_document(sections, ["doc"], "pos", "h", "c", sections_per_part=1)
    assert collected(parts.filter("doc = 'd'").select("part", "text"), "part") == [(0, "## A\n\none"), (1, "## B\n\ntwo")]
    assert dict(themes.join_parts(parts, ["doc"]).collect()) == got
