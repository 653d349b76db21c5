"""Splits, samples, slices and demonstration sets."""

from __future__ import annotations

from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join
from .ranks import hash_cuts, hash_key, id_rank

RATIOS = (0.7, 0.15, 0.15)
# Most groups, by the types of their columns, whose cut points are held as one value beside every row.
FEW_GROUPS = 1000


def _rounded(total: Column, ratio: float) -> Column:
    return F.floor(total * F.lit(float(ratio)) + 0.5).cast("long")


def _check(ratios: Sequence[float]) -> None:
    if abs(sum(ratios) - 1.0) >= 0.001:
        raise ValueError(f"ratios must sum to 1, got {sum(ratios)}")


def _name_split(h: Column, cut_train: Column, cut_val: Column) -> Column:
    return F.when(h <= cut_train, "train").when(h <= cut_val, "val").otherwise("test")


def _group_name(by: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(n).cast("string").alias(f"g{i}") for i, n in enumerate(by)]))


def _few_groups(df: DataFrame, by: Sequence[str]) -> bool:
    """Whether the types of the group columns allow at most ``FEW_GROUPS`` groups."""
    values = [{"boolean": 3, "tinyint": 257}.get(df.schema[n].dataType.simpleString(), FEW_GROUPS + 1) for n in by]
    return prod(values) <= FEW_GROUPS


def _with_cuts(df: DataFrame, cuts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the cut points of a row's group as struct ``_cuts``, null for a group without any.

    Without groups, or where their types leave few of them, the cut points are one value of the query and
    the rows are not shuffled; otherwise the cut table, one row per group, is joined on the group.
    """
    points = F.struct(*[c for c in cuts.columns if c.startswith("cut_")])
    if not by:
        return df.withColumn("_cuts", cuts.select(points.alias("p")).scalar())
    if _few_groups(df, by):
        entries = F.collect_list(F.struct(_group_name(by).alias("k"), points.alias("v")))
        table = cuts.agg(F.map_from_entries(entries).alias("m")).scalar()
        return df.withColumn("_cuts", F.try_element_at(table, _group_name(by)))
    return null_safe_join(df, cuts.select(*by, points.alias("_cuts")), by, "left")


def _by_cuts(df: DataFrame, cuts: DataFrame, by: Sequence[str], key: str, seed: int | str) -> DataFrame:
    """Assign every row by comparing its hash with its group's cut points."""
    named = _name_split(hash_key(key, seed), F.col("_cuts.cut_0"), F.col("_cuts.cut_1"))
    return _with_cuts(df, cuts, by).withColumn("split", named).drop("_cuts")


def _up_to_cut(df: DataFrame, cuts: DataFrame, by: Sequence[str], key: str, seed: int | str) -> DataFrame:
    """Rows up to their group's first cut point."""
    return _with_cuts(df, cuts, by).where(hash_key(key, seed) <= F.col("_cuts.cut_0")).drop("_cuts")


def split_stratified(
    df: DataFrame, key: str, label: str, ratios: Sequence[float] = RATIOS, seed: int | str = 42
) -> DataFrame:
    """Add ``split``; inside each label the train and val sizes are exact, test takes the rest.

    ``key`` must be unique. Rows that do share a key always land in the same split.
    """
    _check(ratios)

    def sizes(total: Column) -> list[Column]:
        train = _rounded(total, ratios[0])
        return [train, train + _rounded(total, ratios[1])]

    return _by_cuts(df, hash_cuts(df, key, seed, [label], sizes), [label], key, seed)


def split_plain(
    df: DataFrame, key: str, ratios: Sequence[float] = RATIOS, seed: int | str = 42
) -> DataFrame:
    """Add ``split`` with exact sizes over the whole table, ignoring labels."""
    _check(ratios)

    def sizes(total: Column) -> list[Column]:
        train = _rounded(total, ratios[0])
        return [train, train + _rounded(total, ratios[1])]

    return _by_cuts(df, hash_cuts(df, key, seed, [], sizes), [], key, seed)


def split_tiny(
    df: DataFrame, key: str, ratios: Sequence[float] = RATIOS, seed: int | str = 42
) -> DataFrame:
    """``split_plain``, except that up to three rows give the last row to val and the rest to train."""
    whole = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.max(key).alias("last")).alias("w")).scalar()
    small = F.when(F.col(key) == whole["last"], "val").otherwise("train")
    plain = split_plain(df, key, ratios, seed)
    return plain.withColumn("split", F.when(whole["n"] <= 3, small).otherwise(F.col("split")))


def leakage_check(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """One row: rows, unassigned rows, distinct keys, and keys found in more than one split."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(split).isNull()).alias("open"),
        F.min(split).alias("a"),
        F.max(split).alias("b"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("unassigned"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("a") != F.col("b")).alias("leaking_keys"),
    )


def take_first(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """The first n rows in the seeded order: rows up to one cut hash, so no task gathers them."""
    cuts = hash_cuts(df, key, seed, [], lambda total: [F.least(total, F.lit(n).cast("long"))])
    return _up_to_cut(df, cuts, [], key, seed)


sample_n = take_first


def sample_share(df: DataFrame, share: float, key: str, seed: int | str = 42) -> DataFrame:
    """Each row with probability ``share``, by the seeded hash of its key: a filter, without a count, rank or shuffle.

    Reruns take the same rows, and rows of a smaller share are among those of a larger one. Of n rows with unique
    keys n * share are expected; the size misses that by more than ``sample_bound`` less than once in a million.
    """
    if share >= 1:
        return df
    return df.where(hash_key(key, seed) < F.lit(f"{int(max(share, 0) * 16**15):015x}"))


def sample_bound(n: int, share: float) -> float:
    """Five standard deviations of the size of ``sample_share``."""
    return 5 * (n * share * (1 - share)) ** 0.5


def take_last(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """The last n rows in the seeded order."""
    cuts = hash_cuts(df, key, seed, [], lambda total: [F.greatest(total - F.lit(n), F.lit(0).cast("long"))])
    before = F.coalesce(F.col("_cuts.cut_0"), F.lit(""))  # no cut: all rows
    return _with_cuts(df, cuts, []).where((hash_key(key, seed) > before) & (F.lit(n) > 0)).drop("_cuts")


def train_val_edges(
    df: DataFrame, key: str, train_n: int = 15, val_min: int = 5, seed: int | str = 42
) -> DataFrame:
    """First ``train_n`` rows as train, last ``max(val_min, n - train_n)`` as val; both when they overlap."""

    def edges(total: Column) -> list[Column]:
        tail = F.greatest(F.lit(val_min).cast("long"), total - F.lit(train_n))
        return [F.least(total, F.lit(train_n).cast("long")), total - tail]

    cuts, h = hash_cuts(df, key, seed, [], edges), hash_key(key, seed)
    before_val = F.coalesce(F.col("_cuts.cut_1"), F.lit(""))  # no cut: every row is val
    roles = F.array_compact(
        F.array(
            F.when(h <= F.col("_cuts.cut_0"), F.lit("train")),
            F.when(h > before_val, F.lit("val")),
        )
    )
    return _with_cuts(df, cuts, []).withColumn("role", F.explode(roles)).drop("_cuts")


def cap_splits(
    df: DataFrame,
    key: str,
    size: int,
    ratios: dict[str, float] | None = None,
    split: str = "split",
    seed: int | str = 42,
) -> DataFrame:
    """Keep ``int(size * ratio)`` rows of each split, in the seeded order."""
    ratios = ratios or {"train": 0.7, "val": 0.15, "test": 0.15}
    cap = F.lit(int(size * 0.1))
    for name, ratio in ratios.items():
        cap = F.when(F.col(split) == name, int(size * ratio)).otherwise(cap)
    capped = hash_cuts(
        df.withColumn("_cap", cap), key, seed, [split, "_cap"], lambda n: [F.least(n, F.col("_cap"))]
    )
    return _up_to_cut(df, capped.drop("_cap"), [split], key, seed)


def sequence_ids(
    df: DataFrame, order: str, prefix: str = "ade_example_", name: str = "example_name"
) -> DataFrame:
    """Number rows from 0 in the order of a unique integer id."""
    ranked = id_rank(df, order, name="_rank")
    numbered = ranked.withColumn(name, F.concat(F.lit(prefix), (F.col("_rank") - 1).cast("string")))
    return numbered.drop("_rank")


def batch_slices(df: DataFrame, order: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    """Number consecutive slices of ``size`` rows from 0; the last one may be short."""
    ranked = id_rank(df, order, by, name="_rank")
    return ranked.withColumn("batch_no", F.floor((F.col("_rank") - 1) / size).cast("long")).drop("_rank")


def few_shot_select(
    df: DataFrame, key: str, k: int, by: Sequence[str] = (), seed: int | str = 42
) -> DataFrame:
    """Up to k rows per class in the seeded order: rows up to the class's cut hash."""
    cuts = hash_cuts(df, key, seed, list(by), lambda total: [F.least(total, F.lit(k).cast("long"))])
    return _up_to_cut(df, cuts, list(by), key, seed)


def bootstrap_set_count(candidates: int) -> int:
    """Number of demonstration sets for a candidate count."""
    return max(candidates // 2, 3)


def bootstrap_sets(df: DataFrame, key: str, sets: int, k: int, seed: int | str = 42) -> DataFrame:
    """``sets`` seeded draws of up to k rows each, as columns ``set_no, position`` and the key.

    One scan of the key column; each task keeps k keys per set before the shuffle.
    """
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sets - 1).cast("long")))
    drawn = df.select(key, number.alias("set_no")).withColumn(
        "_hash", F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.concat(F.lit(f"{seed}/"), F.col("set_no").cast("string"))))
    )
    order = Window.partitionBy("set_no").orderBy("_hash", key)
    placed = drawn.withColumn("position", F.row_number().over(order).cast("long"))
    return placed.where(F.col("position") <= k).select(key, "set_no", "position")


def enough_examples(df: DataFrame, needed: int = 3) -> DataFrame:
    """One row: number of examples and a warning text when there are too few to bootstrap."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    text = F.format_string(f"Insufficient training data. Need at least {needed} examples, got %d", F.col("n"))
    return counted.withColumn("warning", F.when(F.col("n") < needed, text))


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """Separate split tables as one table with a ``split`` column."""
    merged = None
    for name, part in splits.items():
        tagged = part.withColumn("split", F.lit(name))
        merged = tagged if merged is None else merged.unionByName(tagged)
    return merged
