"""Rules given as a table: any number of words or patterns decides about texts by equi joins.

A plan of these operators has one size, whatever the number of rules; small rule tables are broadcast by AQE,
large ones meet the texts' tokens in a shuffle, and of each text only the best rule found so far travels on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import null_safe_join

TOKEN = r"[\p{L}\p{M}\p{N}_]+"
#: Lengths of the pieces by which patterns and paths meet; every pattern holds one of them.
SEEDS = (8, 4, 2, 1)


def rule_rows(spark: SparkSession, kinds: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Ordered word rules as a table: ``kind, token, value, priority`` (the position of the rule)."""
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(w.lower()).alias("token"), F.lit(value).alias("value"), F.lit(i).cast("long").alias("priority"))
        for kind, rules in kinds.items()
        for i, (value, words) in enumerate(rules.items())
        for w in words
    ]
    if not rows:
        return spark.createDataFrame([], "kind string, token string, value string, priority long")
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def decide(df: DataFrame, rules: DataFrame, text: Column, key: str, defaults: Mapping[str, str | None]) -> DataFrame:
    """``df`` with one column per kind in ``defaults``: the value of the rule with the least priority.

    ``rules`` has ``kind, token, value, priority``; a rule applies to a row whose text has its token as a whole
    word, in any case. Of rules with equal priority the least value counts. A row without a match, with a null
    text or with a null key gets the default. ``key`` must be unique.
    """
    rows = df.select(F.col(key).alias("_key"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0))).alias("token"))
    best = rows.where("_key is not null").join(rules.where(F.col("kind").isin(*defaults)), "token").groupBy("_key").agg(
        *[F.min(F.when(F.col("kind") == kind, F.struct("priority", "value"))).alias(f"_{kind}") for kind in defaults]
    )
    found = df.join(best, F.col(key) == F.col("_key"), "left")
    chosen = {kind: F.coalesce(F.col(f"_{kind}.value"), F.lit(default)) for kind, default in defaults.items()}
    return found.withColumns(chosen).drop("_key", *[f"_{kind}" for kind in defaults])


def _pieces(text: Column, sizes: Column) -> Column:
    """Every distinct piece of the given sizes."""
    starts = F.sequence(F.lit(1), F.length(text))
    pieces = F.flatten(F.transform(starts, lambda i: F.transform(sizes, lambda n: F.substring(text, i, n))))
    return F.array_distinct(pieces)


def _seeds(found: DataFrame, patterns: DataFrame, pattern: str) -> DataFrame:
    """``pattern, _seed``: of each distinct pattern the piece that the fewest texts have.

    Pieces have the longest seed length that the pattern has. ``found`` has a row per text and piece.
    """
    size = F.lit(None).cast("int")
    for n in reversed(SEEDS):
        size = F.when(F.length(pattern) >= n, F.lit(n)).otherwise(size)
    wanted = patterns.select(pattern).where(F.length(pattern) > 0).distinct().withColumn("_size", size)
    pieces = F.filter(_pieces(F.col(pattern), F.array("_size")), lambda p: F.length(p) == F.col("_size"))
    wanted = wanted.select(pattern, F.explode(pieces).alias("_seed"))
    texts = found.groupBy("_seed").agg(F.count(F.lit(1)).alias("_n"))
    rated = wanted.join(texts, "_seed", "left").groupBy(pattern).agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_seed")).alias("_s")
    )
    return rated.where(F.col("_s.n") > 0).select(pattern, F.col("_s._seed").alias("_seed"))


def match_patterns(df: DataFrame, patterns: DataFrame, text: str, pattern: str = "pattern") -> DataFrame:
    """One row per (row of ``df``, row of ``patterns``) whose pattern lies in the text; exact and case-sensitive.

    Each pattern is found by its rarest piece of 8, 4, 2 or 1 characters among the pieces of a distinct text, then
    compared in full; no text meets a pattern that shares no such piece with it, and common beginnings of many
    patterns bring none together. Empty and null patterns match nothing.
    """
    texts = df.where(F.length(text) > 0).groupBy(text).agg(F.count(F.lit(1)).alias("_copies"))
    # A short list of texts grows manyfold here, so it is dealt to as many tasks as a large one; without a key, as
    # the rows lie by their key already.
    texts = texts.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = texts.withColumn("_seed", F.explode(_pieces(F.col(text), F.array(*map(F.lit, SEEDS)))))
    seeds = _seeds(found.select("_seed"), patterns, pattern)
    # Dealt by piece, as the size of a short list says nothing about the pieces that it grows to.
    matched = found.join(patterns.join(seeds, pattern).hint("merge"), "_seed").where(F.contains(F.col(text), F.col(pattern))).drop("_seed")
    if df.columns == [text]:  # nothing to fetch from the rows but their number
        rows = matched.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        return rows.select(text, *patterns.columns)
    return null_safe_join(df, matched.drop("_copies"), [text])
