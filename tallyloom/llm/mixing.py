"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Native: DataFrame functions only.

Sources share ``share`` times all words by weight. A source's target stops at ``max_epochs`` times its own
words; what it cannot take is shared anew among the others by weight until no target is above its cap. With
``r = target / words`` every document of the source is repeated ``floor(r)`` times, and a seeded part of the
documents once more. The part is made of whole hash buckets in seeded order; a bucket with more words than are
still wanted is passed over and later ones go on filling. At the end the smallest bucket left out is added if at
least half of it is still wanted, so the words taken miss the target by at most half of the smallest bucket left
out (and a word for rounding).

The water level is found in rounds over one row per source; only three numbers a round reach the driver.
Documents are never sorted or grouped as such: they fall into ``BUCKETS`` seeded hash buckets per source,
whose word sums decide which buckets repeat once more. Up to the first bucket that is too large this is a running
sum; the at most ``BUCKETS`` sums after it are one array per source. A source with a third of all rows is summed
map-side like any other.

Edge cases: a null source is a source of its own and comes last; a null text or size counts 0 words and is
taken 0 times; repeated rows (same key) fall into one bucket and share its fate; an empty table gives no
rows; further columns pass through, names that start with ``_mix`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import numbered, stage

BUCKETS = 4096


def bucket_of(key: Column, seed: int) -> Column:
    """Seeded hash bucket from 0 to ``BUCKETS`` - 1: the first three hex digits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 3), 16, 10).cast("long")


def source_targets(
    docs: DataFrame, size: str, source: str, weights: Sequence[int], share: float, max_epochs: float
) -> DataFrame:
    """One row per source: ``source, source_size, weight, target`` by capped water-filling."""
    sums = docs.groupBy(source).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("source_size"))
    ranked = numbered(sums, F.col(source).asc_nulls_last(), name="_mix_place", label="sources")
    pick = F.array(*[F.lit(float(w)) for w in weights])
    table = stage(
        ranked.select(
            source,
            "source_size",
            F.element_at(pick, (F.col("_mix_place") % len(weights) + 1).cast("int")).alias("weight"),
            (F.lit(float(max_epochs)) * F.col("source_size")).alias("_mix_cap"),
        ),
        "mix-sources",
    )
    total, all_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    goal, level, full = share * (total or 0), 0.0, -1
    if all_weight:
        level = goal / all_weight
    while True:
        above = F.col("weight") * F.lit(level) > F.col("_mix_cap")
        capped, n, rest = table.agg(
            F.sum(F.when(above, F.col("_mix_cap"))), F.count_if(above), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == full or not rest:
            break
        full, level = n, (goal - (capped or 0.0)) / rest
    return table.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("_mix_cap"))).drop("_mix_cap")


def _fill(sums: DataFrame, planned: DataFrame, source: str) -> DataFrame:
    """Per source the last bucket of the running sum, ``_mix_cut``, and the later ones that are taken, ``_mix_later``.

    ``sums`` holds ``_mix_from`` (the source), ``_mix_bucket`` and ``_mix_words``.
    """
    wanted = F.floor("_mix_more")
    up_to = F.sum("_mix_words").over(Window.partitionBy("_mix_from").orderBy("_mix_bucket"))
    found = (
        sums.where(F.col("_mix_words") > 0)
        .withColumn("_mix_up_to", up_to)
        .join(planned, F.col("_mix_from").eqNullSafe(F.col(source)))
        .withColumn("_mix_fits", F.col("_mix_up_to") <= wanted)
    )
    later = F.struct(F.col("_mix_bucket").alias("bucket"), F.col("_mix_words").cast("long").alias("words"))
    totals = found.groupBy("_mix_from").agg(
        F.max(F.when(F.col("_mix_fits"), F.col("_mix_bucket"))).alias("_mix_cut"),
        F.first(wanted).alias("_mix_wanted"),
        F.coalesce(F.max(F.when(F.col("_mix_fits"), F.col("_mix_up_to"))), F.lit(0)).cast("long").alias("_mix_had"),
        F.sort_array(F.collect_list(F.when(~F.col("_mix_fits"), later))).alias("_mix_rest"),
    )
    nothing = F.struct(
        (F.col("_mix_wanted") - F.col("_mix_had")).alias("left"),
        F.array().cast("array<bigint>").alias("taken"),
        F.lit(None).cast("struct<words:bigint,bucket:bigint>").alias("least"),
    )

    def step(state: Column, row: Column) -> Column:
        fits = row["words"] <= state["left"]
        passed = F.struct(row["words"].alias("words"), row["bucket"].alias("bucket"))
        return F.struct(
            F.when(fits, state["left"] - row["words"]).otherwise(state["left"]).alias("left"),
            F.when(fits, F.array_append(state["taken"], row["bucket"])).otherwise(state["taken"]).alias("taken"),
            F.when(fits, state["least"]).otherwise(F.least(state["least"], passed)).alias("least"),
        )

    def finish(state: Column) -> Column:
        closer = state["least"]["words"] <= 2 * state["left"]
        return F.when(closer, F.array_append(state["taken"], state["least"]["bucket"])).otherwise(state["taken"])

    totals = totals.select(
        "_mix_from", "_mix_cut", F.aggregate("_mix_rest", nothing, step, finish).alias("_mix_later")
    )
    return planned.join(totals, F.col(source).eqNullSafe(F.col("_mix_from")), "left").select(
        F.col(source).alias("_mix_source"), "source_size", "target", "_mix_whole", "_mix_cut", "_mix_later"
    )


def mix(
    docs: DataFrame,
    size: str = "size",
    key: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` (of the row's source), ``copies`` and ``taken`` words."""
    targets = source_targets(docs, size, source, weights, share, max_epochs)
    words = F.coalesce(F.col(size), F.lit(0))
    sums = docs.groupBy(source, bucket_of(F.col(key), seed).alias("_mix_bucket")).agg(F.sum(words).alias("_mix_words"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = targets.withColumn("_mix_whole", F.floor(rate)).withColumn(
        "_mix_more", F.col("target") - F.col("_mix_whole") * F.col("source_size")
    )
    plan = stage(_fill(sums.withColumnRenamed(source, "_mix_from"), planned, source), "mix-plan")
    bucket = bucket_of(F.col(key), seed)
    extra = F.coalesce(((bucket <= F.col("_mix_cut")) | F.array_contains("_mix_later", bucket)).cast("long"), F.lit(0))
    clash = [c for c in ("source_size", "target", "copies", "taken") if c in docs.columns]
    return (
        docs.drop(*clash)
        .join(plan, F.col(source).eqNullSafe(F.col("_mix_source")))
        .withColumn("copies", F.when(words > 0, F.col("_mix_whole") + extra).otherwise(F.lit(0)))
        .withColumn("taken", F.col("copies") * words)
        .drop("_mix_source", "_mix_whole", "_mix_cut", "_mix_later")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``mix`` as many times as its ``copies`` say."""
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.where(F.col("copies") > 0).withColumn("_mix_copy", F.explode(times)).drop("_mix_copy")
