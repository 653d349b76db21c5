"""Exact ranks, cut points and running totals without a single-task window, and without a job at build time.

Rows are spread over buckets of the ordering key; a small table of per-bucket sums gives each bucket
its offset, and windows only ever run inside one bucket. Hash order buckets by the leading hex digits
of ``md5(key|seed)``; id order buckets by ``ID_BUCKETS`` quantiles of the ids, read from a sketch inside
the same query, so dense, sparse and packed ids spread alike and no group, however hot, is one task. Ranks use
buckets for groups of many rows only; others are found by counting and ranked in one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join

ID_BUCKETS = 256
HASH_DIGITS = 4
# Groups are counted by cells of their hash. A cell of more rows is spread over buckets, others are ranked in one piece.
CELLS = 1 << 20
HOT_ROWS = 10_000


def hash_key(key: str | Sequence[str], seed: int | str) -> Column:
    """The shuffle order: md5 of the key and the seed; several key columns are told apart, nulls too."""
    if isinstance(key, str):
        text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    else:
        text = F.to_json(F.struct(*[F.col(n).cast("string").alias(f"k{i}") for i, n in enumerate(key)]))
    return F.md5(F.concat_ws("|", text, F.lit(str(seed))))


def hash_bucket() -> Column:
    return F.conv(F.substring("_hash", 1, HASH_DIGITS), 16, 10).cast("long")


def with_id_bucket(df: DataFrame, order: str, name: str = "_bucket") -> DataFrame:
    """Number of quantiles of the whole table below the row's id, as column ``name``."""
    shares = F.array(*[F.lit(i / ID_BUCKETS) for i in range(1, ID_BUCKETS)])
    edges = df.agg(F.percentile_approx(F.col(order).cast("long"), shares).alias("e")).scalar()
    # The edges ascend: halving finds the place in eight compiled steps, one narrow projection each.
    out, step = df.withColumns({"_edges": edges, name: F.lit(0)}), ID_BUCKETS // 2
    while step:
        beyond = F.get("_edges", F.col(name) + F.lit(step - 1)) < F.col(order)
        out = out.withColumn(name, F.col(name) + F.when(beyond, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return out.withColumn(name, F.col(name).cast("long")).drop("_edges")


def split_hot(
    df: DataFrame, counted: DataFrame, group: Sequence[Column], rows: int = HOT_ROWS, cells: int = CELLS
) -> tuple[DataFrame, DataFrame]:
    """``df`` as its cold and its hot rows: those of groups with at most ``rows`` rows in ``counted``, and the rest.

    Groups share ``cells`` cells, so a small group may be hot by chance, but none is cut in two and every cold one
    is as small as promised. Only cell numbers and counts are shuffled; the hot cells, ``cells`` at most, are broadcast.
    """
    cell = F.pmod(F.xxhash64(*group), F.lit(cells))
    hot = counted.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    hot, celled = F.broadcast(hot.select("_cell")), df.withColumn("_cell", cell)
    return celled.join(hot, "_cell", "left_anti").drop("_cell"), celled.join(hot, "_cell", "left_semi").drop("_cell")


def _offsets(buckets: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Exclusive running sums over the bucket table, which has few rows per group."""
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select(
        "_group", "_bucket", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_before_{s}") for s in sums]
    )


def _bucketed(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Inclusive running totals of each value within ``by``, in ``order``, of rows with a ``_bucket``.

    The group is one struct column: never null, so the join needs no null handling and reuses the
    partitioning of the window. The rows are shuffled once.
    """
    names = list(totals)
    group = F.struct(*[F.col(n) for n in by]) if by else F.struct(F.lit(0).alias("all"))
    rows = df.withColumns({"_group": group, **{f"_v_{n}": c for n, c in totals.items()}})
    sums = rows.groupBy("_group", "_bucket").agg(*[F.sum(f"_v_{n}").alias(n) for n in names])
    inside = (
        Window.partitionBy("_group", "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumns({f"_w_{n}": F.sum(f"_v_{n}").over(inside) for n in names})
    return local.join(_offsets(sums, names), ["_group", "_bucket"]).select(
        *[c for c in df.columns if c != "_bucket"], *[(F.col(f"_before_{n}") + F.col(f"_w_{n}")).alias(n) for n in names]
    )


def running_totals(df: DataFrame, order: str, totals: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Running totals along a unique integer id, per group when ``by`` is given."""
    return _bucketed(with_id_bucket(df, order), [F.col(order)], list(by), totals)


def _ranked(
    df: DataFrame, order: Sequence[Column], by: Sequence[str], name: str, bucket: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Rank within ``by``: cold groups move once and are ranked whole, only hot ones fall into buckets."""
    one = {name: F.lit(1).cast("long")}
    if not by:
        return _bucketed(bucket(df), order, by, one)
    cold, hot = split_hot(df, df, [F.col(n) for n in by])
    inside = Window.partitionBy(*by).orderBy(*order)
    whole = cold.withColumn(name, F.row_number().over(inside).cast("long"))
    return whole.unionByName(_bucketed(bucket(hot), order, by, one))


def id_rank(df: DataFrame, order: str, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """1-based rank in the order of a unique integer id."""
    return _ranked(df, [F.col(order)], list(by), name, lambda rows: with_id_bucket(rows, order))


def hash_rank(
    df: DataFrame, key: str | Sequence[str], seed: int | str, by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """1-based rank in the seeded hash order; reproducible on any cluster size."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.withColumn("_hash", hash_key(key, seed))
    order = [F.col("_hash"), *[F.col(k) for k in keys]]
    return _ranked(rows, order, list(by), name, lambda r: r.withColumn("_bucket", hash_bucket())).drop("_hash")


def hash_cuts(
    df: DataFrame,
    key: str,
    seed: int | str,
    by: Sequence[str],
    targets: Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """Hash values at chosen ranks, one row per group: columns ``by``, ``cut_0``, ``cut_1``, …

    ``targets`` maps the group size to the wanted ranks. Two narrow scans: one counts hash
    buckets, one ranks only the buckets that contain a wanted rank (a small table that AQE broadcasts
    when it is). A rank of 0 gives a null cut.
    """
    group = list(by)
    narrow = df.select(*group, F.col(key).alias("_key")).withColumn("_hash", hash_key("_key", seed))
    narrow = narrow.withColumn("_bucket", hash_bucket())
    counts = narrow.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 16^HASH_DIGITS rows per group.
    ordered = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edges = counts.withColumns(
        {
            "_upto": F.sum("_n").over(ordered),
            "_total": F.sum("_n").over(Window.partitionBy(*group)),
        }
    )
    wanted = targets(F.col("_total"))
    ranks = [F.struct(F.lit(i).alias("no"), c.cast("long").alias("rank")) for i, c in enumerate(wanted)]
    rank, upto = F.col("_cut.rank"), F.col("_upto")
    edges = edges.withColumn("_cut", F.explode(F.array(*ranks))).filter(
        (rank <= upto) & (rank > upto - F.col("_n"))
    )
    hit = edges.select(*group, "_bucket", F.col("_cut.no").alias("_no"), (rank - (upto - F.col("_n"))).alias("_nth"))
    candidates = null_safe_join(narrow, hit, [*group, "_bucket"])
    nth = Window.partitionBy(*group, "_bucket", "_no").orderBy("_hash", "_key")
    found = candidates.withColumn("_rn", F.row_number().over(nth)).filter(F.col("_rn") == F.col("_nth"))
    return found.groupBy(*group).agg(
        *[F.max(F.when(F.col("_no") == i, F.col("_hash"))).alias(f"cut_{i}") for i in range(len(wanted))]
    )
