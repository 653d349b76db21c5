import random
from collections import Counter

from pyspark.sql import functions as F

from tallyloom.operators import costs, rules, themes

from .conftest import collected


def test_a_table_of_rules_decides_like_the_mappings(spark, rows):
    data = [(1, "Fix the Runner", "", None), (2, None, "internal postgres", ""), (3, "nothing", "", ""), (4, "API preview", "refactor gpu", "cli"), (5, None, None, None)]
    prs = rows(data, "pr long, title string, description string, ellipsis_summary string")
    kinds = {"service": themes.SERVICE_RULES, "category": themes.CATEGORY_RULES}
    defaults = {"category": "customer_facing_available", "service": "Other"}
    table = rules.rule_rows(spark, kinds)
    by_table = rules.decide(prs, table, themes.pr_text(), "pr", defaults).select("pr", "category", "service")
    by_mapping = themes.categorize(prs).select("pr", "category", "service")
    assert collected(by_table, "pr") == collected(by_mapping, "pr")
    none = rules.rule_rows(spark, {})
    assert {r.service for r in rules.decide(prs, none, themes.pr_text(), "pr", defaults).collect()} == {"Other"}


def test_many_rules_keep_the_plan_small_and_pick_the_first(spark, rows):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    table = [("k", w, f"v{rng.randrange(40)}", rng.randrange(50)) for w in words for _ in range(3)]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(200)] + [(None, "w1")]
    got = rules.decide(rows(texts, "pr long, t string"), rows(table, "kind string, token string, value string, priority int"), F.col("t"), "pr", {"k": None})

    def best(text):
        found = [(p, v) for _, w, v, p in table if w in text.split()]
        return min(found)[1] if found else None

    want = {(key, None if key is None else best(text)) for key, text in texts}
    assert {(r.pr, r.k) for r in got.collect()} == want


def test_patterns_of_every_length_are_found(rows):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab/é", k=rng.randrange(30))) for _ in range(60)] + ["", None, "Case", "x" * 200]
    patterns = ["".join(rng.choices("ab/é", k=rng.randrange(11))) for _ in range(80)] + ["case", None, "x" * 199, "y"]
    files = rows([(t, i) for i, t in enumerate(texts)], "path string, n long")
    table = rows([(p, i) for i, p in enumerate(patterns)], "pattern string, phase long")
    got = {(r.n, r.phase) for r in rules.match_patterns(files, table, "path").collect()}
    assert got == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(patterns) if t and p and p in t}


def test_phases_by_table_are_those_by_mapping(spark, rows):
    phases = {"one": ["abc", "x"], "two": ["cd/e"]}
    files = rows([("abcd/e", 1), ("x", 2), ("none", 3), ("abcx", 4)], "cassette string, requests long")
    table = spark.createDataFrame([(k, p) for k, ps in phases.items() for p in ps], "phase string, pattern string")
    by_table = rules.match_patterns(files, table, "cassette").select("cassette", "phase")
    assert collected(by_table, "cassette", "phase") == collected(costs.phase_join(files, phases).select("cassette", "phase"), "cassette", "phase")


def test_patterns_meet_texts_by_their_rarest_piece(rows):
    """A beginning that all texts and patterns share brings none together; repeated texts keep their number."""
    texts = rows([(f"http://same.example/{i:04d}",) for i in range(300)] * 2 + [(None,), ("",)], "path string")
    table = rows([(f".example/{i:04d}", i) for i in range(0, 600, 3)] + [("example/000", -1), ("", -2), (None, -3)], "pattern string, no int")
    pieces = texts.distinct().where("length(path) > 0").select(F.explode(rules._pieces(F.col("path"), F.array(F.lit(8), F.lit(4)))).alias("_seed"))
    chosen = {r["pattern"]: r["_seed"] for r in rules._seeds(pieces, table, "pattern").collect()}
    assert chosen[".example/0003"] == "ple/0003" and len(set(chosen.values())) == len(chosen)
    got = Counter((r["path"], r["no"]) for r in rules.match_patterns(texts, table, "path").collect())
    want = {(f"http://same.example/{i:04d}", i): 2 for i in range(0, 300, 3)} | {(f"http://same.example/{i:04d}", -1): 2 for i in range(10)}
    assert got == want
