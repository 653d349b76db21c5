import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import mixing, queries, repeats, simhash
from tallyloom.llm.staging import stage, word_count

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no driver tables")


def test_one_query_per_operator_and_the_pipeline():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(queries.CHECKS) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixture", "packing"]


def test_mixing_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(con.execute(queries.CHECKS["op6_mixing"]).fetchall())
    got = sorted(tuple(r) for r in queries.QUERIES["op6_mixing"](spark, SMALL).collect())
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_each_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SMALL), f"test-{name}")
        kept[name] = docs
        if name == "packing":
            continue
        assert docs.columns == columns
        if name == "quality":
            rated = before.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
            good = rated.where("quality = 1").select("doc_id")
            assert docs.join(good, "doc_id", "left_semi").count() > 0.97 * good.count()
            bad = rated.where("quality = 0").select("doc_id")
            assert docs.join(bad, "doc_id", "left_semi").count() < 0.1 * bad.count()
        if name == "near_duplicates":
            found = simhash.near_duplicates(before)
            want = found.where("doc_id = component_id").select("doc_id").distinct()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in want.collect())
        if name == "repeated_passages":
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in before.collect())
            lost = before.agg(F.sum(F.octet_length("text"))).first()[0] - docs.agg(F.sum(F.octet_length("text"))).first()[0]
            spans = repeats.without_repeats(before).agg(F.sum("n_removed")).first()[0]
            assert spans <= lost <= spans * 1.01 and docs.where("n_chars <> length(text)").count() == 0
        if name == "mixture":
            sized = before.withColumn("words", word_count(F.col("text")))
            copies = {r.doc_id: r.copies for r in mixing.mix(sized, size="words").collect()}
            assert Counter(r.doc_id for r in docs.collect()) == Counter({k: v for k, v in copies.items() if v})
    packed = kept["packing"]
    assert packed.where("piece = 0").count() == kept["mixture"].count()
    sequences = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sequences.where("n > 1024 or n <> end").count() == 0
    whole = corpus_pipeline.run(spark, SMALL)
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(pick).collect())) == sorted(map(tuple, packed.select(pick).collect()))


def test_stages_take_tricky_documents(spark, documents, no_documents, crowded_columns):
    null_keys = documents.select(F.lit(None).cast("long").alias("doc_id"), *documents.columns[1:])
    for docs in (documents, no_documents, null_keys, crowded_columns.withColumn("_size", F.lit(1)).withColumn("_text", F.lit(1))):
        now = docs
        for name, step in corpus_pipeline.STAGES:
            now = stage(step(spark, now, SMALL), f"tricky-{name}")
            assert name == "packing" or now.columns == docs.columns
        assert (now.count() > 0) == (docs.count() > 0)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_hand_on_other_columns_as_they_were(spark, crowded_columns, name):
    """Columns named like those that the operators add keep their values and types."""
    docs = crowded_columns.withColumns({"_size": F.lit(1), "_kept_0": F.lit("mine"), "n_removed": F.lit(2.5)})
    kept = dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL)
    own = [c for c in docs.columns if c not in corpus_pipeline.OWN]
    assert kept.columns == docs.columns and [kept.schema[c].dataType for c in docs.columns] == [docs.schema[c].dataType for c in docs.columns]
    assert set(kept.select(own).distinct().collect()) == set(docs.select(own).distinct().collect())


def test_near_duplicates_leave_one_row_of_repeated_rows(spark, documents):
    kept = Counter(r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents, SMALL).collect())
    assert set(kept.values()) == {1} and 6 not in kept and 5 in kept
