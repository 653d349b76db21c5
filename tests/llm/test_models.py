import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import licences, ordinal, toxicity


@pytest.fixture(scope="module")
def rated(spark, letters):
    """600 texts: grade 0 has marked words, grade 1 a rude word, grade 2 neither."""
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        words = letters(40, i + 1000).split()
        kind = i % 3
        if kind == 0:
            words = [w + rng.choice(["&&&", "###"]) for w in words]
        if kind == 1:
            words[rng.randrange(40)] = rng.choice(["nastyone", "nastything", "nastyfolk"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind > 0), int(kind == 1)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def rating():
    return F.when(F.col("quality") == 0, 0).when(F.col("quality").isNotNull(), F.when(F.col("toxic") == 1, 1).otherwise(2))


def test_grades_are_found_again(rated):
    docs, labels = rated
    model = ordinal.train(docs, labels.where("doc_id < 400"), rating())
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    rows = ordinal.grade(docs.where("doc_id >= 400"), model).join(labels, "doc_id").collect()
    assert np.mean([(r.tail_probability >= 0.5) == (r.quality == 1) for r in rows]) > 0.98
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)


def test_grades_of_tricky_documents(rated, documents, crowded_columns, no_documents, spark):
    model = ordinal.train(*rated, rating())
    for docs in (documents, crowded_columns):
        got = ordinal.grade(docs, model)
        assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
        scores = {}
        for r in got.select("doc_id", "expected_grade").collect():
            assert r.expected_grade == scores.setdefault(r.doc_id, r.expected_grade)
    assert ordinal.grade(no_documents, model).count() == 0
    docs, labels = rated
    none = ordinal.train(docs, labels.limit(0), rating())
    assert {(r.expected_grade, r.tail_probability) for r in ordinal.grade(documents, none).collect()} == {(0.0, 1.0)}
    one = ordinal.train(docs, labels.where("quality = 1 and toxic = 0"), rating())
    assert {r.expected_grade for r in ordinal.grade(documents, one).collect()} == {2.0}
    odd = labels.union(spark.createDataFrame([(None, 1, 0), (5, None, None), (0, 0, 0)], labels.schema))
    assert len(ordinal.train(docs, odd, rating()).thresholds) == 2


def test_toxic_words_are_learned_by_their_beginning(rated):
    docs, labels = rated
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_are_not_read(rated):
    docs, labels = rated
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, y).collect())) for y in (labels, flipped))
    assert a == b


def test_counterfactual_penalty_evens_out_groups(spark, letters, monkeypatch):
    """A group named mostly in toxic texts; with the penalty naming it moves the score less."""
    docs, labels = [], []
    for i in range(500):
        words = letters(30, i + 5000).split()
        toxic = i % 4 == 0
        if toxic:
            words[3] = "nastyone" if i % 8 else words[3]
            words[5] = "muslim"
        elif i % 4 == 1:
            words[5] = "jewish"
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = docs.limit(1).union(spark.createDataFrame([(-1, "a muslim neighbour"), (-2, "a jewish neighbour")], docs.schema))
    gaps = []
    for fairness in (0.0, 5.0):
        monkeypatch.setattr(toxicity, "FAIRNESS", fairness)
        found = toxicity.toxicity(docs.union(probe), labels)
        score = {r.doc_id: r.score for r in found.where("doc_id < 0").collect()}
        gaps.append(abs(score[-1] - score[-2]))
    assert gaps[1] < 0.25 * gaps[0]


def test_toxicity_of_tricky_documents(rated, documents, crowded_columns, no_documents):
    _, labels = rated
    for docs in (documents, crowded_columns):
        got = toxicity.toxicity(docs, labels)
        assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.toxicity(no_documents, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(documents, labels.limit(0)).collect()} == {0.5}


@pytest.fixture(scope="module")
def licence_model(rated):
    return licences.train(rated[0])


def test_licence_notices_are_found(spark, licence_model, letters):
    notices = {
        "Released under the MIT License.": "MIT", "This software is distributed under the MIT license": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "licensed under the APACHE license version 2": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "All rights reserved.": "proprietary", "Redistribution and use in source and binary forms, with or without modification, are permitted": "BSD",
    }
    other = ["The apache helicopter landed.", "He has a fishing license.", letters(20, 1), "", "the public library"]
    rows = [(i, f"{letters(15, i)}\n{line}\n{letters(10, i + 50)}") for i, line in enumerate([*notices, *other])]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).where("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == {(i, 1, f) for i, f in enumerate(notices.values())}
    assert all(r.probability >= licences.CERTAIN and r.similarity >= licences.ALIKE for r in got)


def test_licences_in_tricky_documents(spark, licence_model, documents, crowded_columns, no_documents, tricky):
    for docs in (documents, crowded_columns, no_documents):
        assert licences.scan(docs, licence_model).count() == 0
    noted = spark.createDataFrame([(None, "x\nAll rights reserved."), (1, "All rights reserved."), (1, "All rights reserved.")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.paragraph) for r in licences.scan(noted, licence_model).collect()) == [(0, 1), (1, 0), (1, 0)]
    alone = licences.train(no_documents)
    assert licences.scan(noted, alone).count() == 3


def test_licence_training_on_the_scanned_documents(spark, letters):
    """A notice is found however often the corpus, that the model is also fitted on, has its words."""
    few = [(i, f"{letters(12, i)}\n{'Released under the MIT License.' if i == 4 else letters(9, i + 20)}") for i in range(10)]
    firms = [letters(1, i + 900).title() for i in range(400)]
    many = [(i, f"{letters(12, i)}\n" + (f"Copyright {1980 + i % 40} {firms[i]}. All rights reserved." if i % 3 == 0 else letters(9, i + 500))) for i in range(400)]
    for rows, want in ((few, {(4, 1, "MIT")}), (many, {(i, 1, "proprietary") for i in range(0, 400, 3)})):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = licences.scan(docs, licences.train(docs)).where("confirmed").collect()
        assert {(r.doc_id, r.paragraph, r.family) for r in got} == want


PROSE = [
    "Wir fahren mit dem Zug, und mit uns fahren die Kinder mit.", "Der Mann mit dem Hut ging mit seiner Frau nach Hause.",
    "Le chat et le chien sont dans la maison, avec une copie du texte.", "La licence de pêche est obligatoire pour tous.",
    "El permiso de conducir y la copia de la llave están en la mesa.", "Todos los derechos humanos son del público general.",
]


def test_foreign_prose_is_no_licence(spark, letters):
    """Every row counts: only the notices are returned, whichever sample the model was fitted on."""
    found = []
    for seed in (1, 2):
        rows = [(i, "\n".join([PROSE[i % 6], letters(8, seed * 1000 + i), PROSE[(i + seed) % 6]])) for i in range(120)]
        rows += [(500, f"{PROSE[0]}\nReleased under the MIT License."), (501, "SPDX-License-Identifier: GPL-3.0-or-later"), (502, "the mit license applies: released under the mit license")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found.append({(r.doc_id, r.paragraph, r.family) for r in licences.scan(docs, licences.train(docs, seed=seed)).collect()})
    assert found[0] == found[1] == {(500, 1, "MIT"), (501, 0, "GPL"), (502, 0, "MIT")}


def test_licence_scan_stays_in_the_jvm(licence_model, documents):
    plan = licences.scan(documents, licence_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(5))
def test_middle_tells_labels_apart_as_well_as_any_cut(seed):
    rng = np.random.default_rng(seed)
    label = (rng.random(60) < 0.3).astype(int)
    label[:2] = 0, 1
    margins = np.round(rng.normal(size=60) + label, 1)  # with ties

    def balanced(cut):
        return np.mean(margins[label == 1] >= cut) + np.mean(margins[label == 0] < cut)

    best = max(balanced(c) for c in [*margins, margins.max() + 1])
    assert balanced(toxicity.middle(margins, label)) >= best - 0.08  # the middle of the stretch from the first to the last best cut
    apart = np.where(label == 1, 2.0, -1.0)
    assert toxicity.middle(apart, label) == 0.5


def test_slots_of_few_texts_get_no_weight():
    often, rare = np.array([3], dtype="<i4").tobytes(), np.array([3, 9], dtype="<i4").tobytes()
    sample = [(i % 2, 10, rare if i < toxicity.SEEN - 1 else often, b"") for i in range(20)]
    assert {r[2] for r in toxicity.common_slots(sample)} == {often}
