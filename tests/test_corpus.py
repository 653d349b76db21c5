from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyloom.operators import corpus, profile

from .conftest import collected

BASE = "row_id long, text string, label int"
EFFECTS = "row_id long, text string, drug string, effect string"
DOSAGES = "row_id long, text string, drug string, dosage string"


def small(rows):
    base = rows([(1, "a", 1), (2, "b", 0), (3, "a", None), (4, None, 1), (5, "c", 2)], BASE)
    effects = rows([(1, "a", "d1", "e1"), (2, "a", "d1", None), (3, None, "d2", "e2"), (4, "z", "d3", "e3")], EFFECTS)
    dosages = rows([(1, "b", "d9", "5 mg"), (2, "a", "d8", "1 g")], DOSAGES)
    return base, effects, dosages


def test_unify_keeps_every_row(rows):
    got = {r["row_id"]: r for r in corpus.unify_corpus(*small(rows)).collect()}
    assert len(got) == 5
    pairs = lambda r: [tuple(p) for p in r["drug_effect_pairs"]]
    assert pairs(got[1]) == pairs(got[3]) == [("d1", "e1"), ("d1", None)]
    assert pairs(got[4]) == [("d2", "e2")]  # null text joins null text
    assert got[2]["drug_effect_pairs"] == [] and [tuple(p) for p in got[2]["drug_dosage_pairs"]] == [("d9", "5 mg")]
    assert [got[i]["label"] for i in range(1, 6)] == [True, False, False, True, False]
    assert (got[1]["n_effects"], got[1]["n_dosages"]) == (2, 1)


def test_counts_agree_with_lists(rows):
    keep = ["row_id", "label", "n_effects", "n_dosages"]
    light = corpus.unify_counts(*small(rows)).select(*keep)
    assert collected(light, "row_id") == collected(corpus.unify_corpus(*small(rows)).select(*keep), "row_id")


def test_lists_come_in_parts(rows):
    """One text owns most annotations: its rows come part by part, and nothing is left out."""
    base, _, dosages = small(rows)
    notes = [(i, "a", f"d{i}", f"e{i}") for i in range(50)] + [(100, "b", "x", "y")]
    effects = rows(notes, EFFECTS)
    got = defaultdict(list)
    for r in corpus.unify_corpus(base, effects, dosages, part_size=8).orderBy("row_id", "part").collect():
        got[r["row_id"]].append(r)
    assert [r["part"] for r in got[1]] == list(range(7)) and [r["part"] for r in got[5]] == [0]
    assert [tuple(p) for r in got[3] for p in r["drug_effect_pairs"]] == [(f"d{i}", f"e{i}") for i in range(50)]
    assert all(r["drug_effect_pairs"] is not None and r["n_effects"] == 50 for r in got[1])
    assert [tuple(p) for p in got[1][0]["drug_dosage_pairs"]] == [("d8", "1 g")]
    assert [tuple(p) for p in got[2][0]["drug_effect_pairs"]] == [("x", "y")] and got[2][0]["n_effects"] == 1
    long = corpus.long_pairs(effects, "text", "drug", "effect", "row_id")
    hot = long.filter(F.col("text_key") == F.sha2(F.lit("a"), 256))
    assert [(r["pos"], r["drug"]) for r in hot.orderBy("pos").collect()] == [(i + 1, f"d{i}") for i in range(50)]


def test_pairs_are_cut_into_parts(rows):
    notes = [(i, "a", f"d{i}", f"e{i}") for i in range(25)] + [(100, "b", "x", None), (99, None, "n", "m")]
    parts = corpus.pairs_by_text(rows(notes, EFFECTS), "text", "drug", "effect", "row_id", part_size=10)
    got = defaultdict(list)
    for r in parts.orderBy("part").collect():
        got[r["text"]].append([tuple(p) for p in r["pairs"]])
    assert [len(p) for p in got["a"]] == [10, 10, 5]
    assert sum(got["a"], []) == [(f"d{i}", f"e{i}") for i in range(25)]
    assert got["b"] == [[("x", None)]] and got[None] == [[("n", "m")]]


def test_distinct_items_over_parts(rows):
    """An item of an earlier part is not listed again."""
    base = rows([(1, "a", 1), (2, "a", 0)], BASE)
    effects = rows([(i, "a", f"d{i % 7}", f"e{i % 3}") for i in range(30)], EFFECTS)
    unified = corpus.unify_corpus(base, effects, rows([], DOSAGES), part_size=4)
    got = defaultdict(list)
    for r in corpus.extraction_examples(unified).orderBy("part").collect():
        got[r["row_id"], r["kind"]] += r["items"]
    assert got[1, "drugs"] == got[2, "drugs"] == [f"d{i}" for i in range(7)] and got[1, "effects"] == ["e0", "e1", "e2"]


def test_scorecard_of_a_large_text(spark, rows):
    """25,000 pairs of one text count in full: the figures are those of the plain rows."""
    from tallyloom.operators import metrics

    base = rows([(1, "big", 1), (2, "small", 0), (3, "none", 0)], BASE)
    big = spark.range(25_000).selectExpr("id as row_id", "'big' as text", "concat('d', id % 20000) as drug", "concat('e', id % 300) as effect")
    effects = big.unionByName(rows([(30_000, "small", "x", "y")], EFFECTS))
    examples = corpus.classification_examples(corpus.unify_corpus(base, effects, rows([], DOSAGES)))
    wrong = F.transform("drugs", lambda d: F.when(F.substring(d, -1, 1) == "7", F.concat(F.lit("no"), d)).otherwise(d))
    scored = examples.withColumns(
        {"y_true": F.col("has_ade"), "y_pred": F.col("has_ade"), "true_drugs": F.col("drugs"), "true_effects": F.col("effects"),
         "pred_drugs": wrong, "pred_effects": F.col("effects")}
    )
    card = metrics.pipeline_scorecard_parts(scored, "row_id").first()
    assert (card["drug_item_tp"], card["drug_item_fp"], card["drug_item_fn"]) == (18_001, 2_000, 2_000)
    assert (card["effect_item_tp"], card["effect_item_fn"], card["effect_f1"]) == (301, 0, 1.0)
    assert (card["drug_valid_examples"], card["examples_evaluated"], card["tp"], card["tn"]) == (2, 3, 1, 2)


def test_scorecard_of_parts_equals_the_plain_one(rows):
    from tallyloom.operators import metrics

    lists = "array<string>"
    data = [(1, True, True, ["A", "b"], ["a"], ["x"], ["X", None]), (2, False, None, [], [], None, ["y"]), (3, True, False, ["q", "q"], None, [], [])]
    schema = f"id long, y_true boolean, y_pred boolean, pred_drugs {lists}, true_drugs {lists}, pred_effects {lists}, true_effects {lists}"
    plain = rows(data, schema)
    parts = [(*r, 0) for r in data] + [(1, False, False, ["b"], ["b2"], None, None, 1)]
    whole = [(1, True, True, ["A", "b"], ["a", "b2"], ["x"], ["X", None]), *data[1:]]
    cut = metrics.pipeline_scorecard_parts(rows(parts, schema + ", part long"), "id").first()
    assert cut == metrics.pipeline_scorecard(rows(whole, schema)).first() != metrics.pipeline_scorecard(plain).first()


def test_examples(rows):
    base, effects, dosages = small(rows)
    unified = corpus.unify_corpus(base, effects, dosages)
    got = {(r["row_id"], r["kind"]): r["items"] for r in corpus.extraction_examples(unified).collect()}
    assert got[(1, "drugs")] == ["d1"] and got[(1, "effects")] == ["e1", None]
    assert got[(2, "drugs")] == ["d9"] and (2, "effects") not in got
    assert (5, "drugs") not in got
    examples = {r["row_id"]: r for r in corpus.classification_examples(unified).collect()}
    assert examples[1]["drugs"] == ["d1", "d1"] and examples[1]["confidence"] == 0.8
    assert examples[2]["has_ade"] is False and examples[2]["confidence"] == 0.2


def test_statistics(rows):
    unified = corpus.unify_corpus(*small(rows))
    got = profile.corpus_stats(unified).first()
    assert (got["total"], got["with_effects"], got["with_dosages"], got["positives"]) == (5, 3, 3, 2)
    assert got["positives_pct"] == 40.0
    table = profile.annotation_label_crosstab(unified).first()
    assert table["annotated_positive"] == 2 and table["annotated_negative"] == 1
    assert table["all_annotated_positive"] is False


def test_profiles(rows):
    base, effects, _ = small(rows)
    shape = {r["config"]: r for r in profile.profile_shape({"c": base, "e": effects}).collect()}
    assert shape["c"]["n_rows"] == 5 and shape["e"]["n_columns"] == 4
    counts = dict(collected(profile.profile_non_null(effects, ["text", "effect"])))
    assert counts == {"text": 3, "effect": 3}
    assert dict(collected(profile.label_distribution(base))) == {1: 2, 0: 1, 2: 1, None: 1}
    preview = profile.preview_rows(rows([(2, "x" * 200), (1, "short")], "row_id long, text string"), "row_id", 3)
    assert collected(preview) == [(1, "short"), (2, "x" * 101 + "...")]


def test_alignment_of_configs(rows):
    t = lambda *texts: rows([(x,) for x in texts], "text string")
    configs = {"a": t("1", "1", "2", "3"), "b": t("2", "3", "3"), "c": t("3", "9")}
    got = dict(collected(profile.config_alignment(configs)))
    assert got == {"a": 3, "b": 2, "c": 2, "a&b": 2, "a&c": 1, "b&c": 1, "every": 1}
    shared = profile.shared_text_annotations(configs, {n: ["text"] for n in configs})
    assert Counter(r["config"] for r in shared.collect()) == {"a": 1, "b": 2, "c": 1}
    assert collected(profile.intersect_texts(configs["a"], configs["b"]), "text") == [("2",), ("3",)]
    assert collected(profile.except_texts(configs["a"], configs["b"])) == [("1",)]


def test_valid_items(rows):
    raw = rows([(1, '{"text": "a", "label": 1}'), (2, '{"invalid": "data"}'), (3, '{"text": null, "label": null}'), (4, "x")], "id long, raw string")
    assert collected(corpus.valid_items(raw, "raw").select("id"), "id") == [(1,), (3,)]
    assert corpus.valid_items(raw).count() == 0


def test_to_examples(rows):
    got = corpus.to_examples(rows([(None, 1), ("b", 0)], "text string, label int")).collect()
    assert got[0]["input"]["text"] == "" and got[0]["expected"]["ade_status"] == "mild_adverse_event"
    assert got[1]["expected"]["confidence"] == 1.0 and got[1]["expected"]["drug_symptom_pairs"] == []


def test_synthetic_sentences(rows):
    data = [
        ("Patient took ibuprofen and felt nausea", 1),
        ("Patient took prescribed medication", 0),
        ("Aspirin caused a rash", 1),
        ("The antibiotic was tolerated", 0),
    ]
    got = corpus.synthetic_examples(rows(data, "sentence string, label int")).collect()
    assert [r["medications"] for r in got] == [["ibuprofen"], [], ["aspirin"], []]
    assert [r["ade_status"] for r in got] == ["mild_adverse_event", "no_adverse_event"] * 2
    assert [r["confidence"] for r in got] == [0.8, 0.9, 0.8, 0.9]
    assert [tuple(p) for p in got[0]["drug_symptom_pairs"]] == [("ibuprofen", "nausea")]


def test_clean_input(rows):
    lists = rows([(None, None, ["", "x", None])], "patient_report string, medications array<string>, symptoms array<string>")
    got = corpus.clean_input(lists).first()
    assert tuple(got) == ("", [], ["x"])
    scalars = rows([("r", "one drug", 12345)], "patient_report string, medications string, symptoms int")
    assert tuple(corpus.clean_input(scalars).first()) == ("r", ["one drug"], [])
    blank = rows([("r", None, "")], "patient_report string, medications string, symptoms string")
    assert tuple(corpus.clean_input(blank).first()) == ("r", [], [])


def test_required_fields(rows):
    schema = "idx long, text string, status string"
    check = lambda data: corpus.check_required(rows(data, schema), "idx", ["text", "status"]).first()
    assert check([])["error"] == "Invalid training examples: cannot be empty"
    assert check([(0, "a", "s"), (2, "b", None), (1, None, "s")])["error"] == "Invalid training examples: item 1 missing required fields"
    assert check([(0, "a", "s")])["error"] is None


def moves(df):
    """Shuffles by a key in the plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_notes_of_small_texts_are_ranked_after_one_move(rows):
    long = corpus.long_pairs(small(rows)[1], "text", "drug", "effect", "row_id").select("drug", "pos")
    assert moves(long) == 1 and collected(long, "drug", "pos") == [("d1", 1), ("d1", 2), ("d2", 1), ("d3", 1)]


def many_notes(spark, n=1_500):
    """One text with more notes than a list holds, beside texts with few."""
    big = spark.range(n).selectExpr("id as row_id", "'big' as text", "concat('d', id % 1200) as drug", "concat('e', id % 3) as effect")
    return big.unionByName(spark.range(40).selectExpr("id as row_id", "concat('t', id % 9) as text", "concat('x', id) as drug", "'y' as effect"))


def test_texts_with_few_and_with_many_pairs(spark):
    got = defaultdict(list)
    pairs = corpus.pairs_by_text(many_notes(spark), "text", "drug", "effect", "row_id")
    for r in pairs.orderBy("text", "part").collect():
        got[r["text"]].append([p["drug"] for p in r["pairs"]])
    assert [len(p) for p in got["big"]] == [1000, 500] and sum(got["big"], []) == [f"d{i % 1200}" for i in range(1500)]
    assert len(got) == 10 and all(got[f"t{k}"] == [[f"x{i}" for i in range(k, 40, 9)]] for k in range(9))


def test_unified_rows_tell_the_number_of_parts(spark, rows):
    """The notes of small texts move once: ranks and buckets are for the large ones only."""
    base = rows([(1, "big", 1), (2, "t3", 0), (3, "none", 1), (4, "big", 0), (5, None, 0)], "row_id long, body string, label int")
    effects = many_notes(spark).withColumnRenamed("text", "body")
    unified = corpus.unify_corpus(base, effects, rows([(1, "t3", "p", "q")], "row_id long, body string, drug string, dosage string"), text="body")
    got = defaultdict(list)
    for r in unified.orderBy("row_id", "part").collect():
        got[r["row_id"]].append((r["part"], r["n_parts"], len(r["drug_effect_pairs"]), r["n_effects"], r["n_dosages"]))
    assert got[1] == got[4] == [(0, 2, 1000, 1500, 0), (1, 2, 500, 1500, 0)]
    assert got[2] == [(0, 1, 5, 5, 1)] and got[3] == got[5] == [(0, 1, 0, 0, 0)]


def test_items_of_one_part_need_no_shuffle(spark, rows):
    base = rows([(1, "big", 1), (2, "t3", 0), (3, "t3", 1)], BASE)
    unified = corpus.unify_corpus(base, many_notes(spark), rows([], DOSAGES))
    got = defaultdict(list)
    for r in corpus.extraction_examples(unified).orderBy("part").collect():
        got[r["row_id"], r["kind"]].append(r["items"])
    assert got[1, "drugs"] == [[f"d{i}" for i in range(1000)], [f"d{i}" for i in range(1000, 1200)]] and got[1, "effects"] == [["e0", "e1", "e2"]]
    assert got[2, "drugs"] == got[3, "drugs"] == [[f"x{i}" for i in range(3, 40, 9)]] and got[2, "effects"] == [["y"]]
    few = corpus.unify_corpus(base, effects := many_notes(spark, 20), rows([], DOSAGES)).select("row_id", "text_key", "part", "n_parts", "n_effects", "drug_effect_pairs", "drug_dosage_pairs")
    assert moves(corpus.extraction_examples(few)) == moves(few) and effects.count() == 60
