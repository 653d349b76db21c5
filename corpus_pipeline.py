"""Documents to packed training sequences: five stages, each reading what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import mixing, ordinal, packing, repeats, simhash
from tallyloom.llm.queries import quality_model, tokenizer_path
from tallyloom.llm.staging import ship, spare, stage, word_count


#: Columns that stages read or change; all others pass through them under names of no operator.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(docs: DataFrame) -> tuple[DataFrame, list]:
    """The documents with other columns renamed, and the columns that undo it."""
    inner = {c: c if c in OWN else f"_kept_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]), [F.col(n).alias(c) for c, n in inner.items()]


#: Least probability of being above the lowest grade.
QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated ones, does not put into the lowest grade."""
    ship(spark)
    inner, outer = shielded(docs)
    graded = ordinal.grade(inner, quality_model(spark, inner, sf_dir))
    return graded.where(F.col("tail_probability") >= QUALITY).select(*outer)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one whose key is the component's.

    Of rows with that key and one text, one stays; rows without key stay if their group has no key.
    """
    ship(spark)
    found = simhash.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    chosen = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    (text,) = spare(docs, "_text")
    return chosen.withColumn(text, F.xxhash64("text")).dropDuplicates(["doc_id", text]).drop(text)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier; ``n_chars`` is counted anew."""
    ship(spark)
    inner, outer = shielded(docs)
    return repeats.without_repeats(inner).withColumn("n_chars", F.length("text").cast("long")).select(*outer)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and fractional repetitions of every document, as rows."""
    inner, outer = shielded(docs)
    sized = inner.withColumn("_size", word_count(F.col("text")))
    return mixing.repeated(mixing.mix(sized, size="_size")).select(*outer)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("packing", packed),
]

#: Fitted weights, suffix arrays and token ids are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
