"""Splits, samples, ranks and batches. Keys are unique ids; the order is md5(key|seed)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import ranks, splits

from .base import query, table, tidy


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def rank_sql(by: str = "", key: str = "o_orderkey", seed: str = "42") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5({key} || '|{seed}'), {key})"


def split_sql(rank: str, total: str) -> str:
    train, val = f"floor({total} * 0.7::DOUBLE + 0.5)", f"floor({total} * 0.15::DOUBLE + 0.5)"
    return f"CASE WHEN {rank} <= {train} THEN 'train' WHEN {rank} <= {train} + {val} THEN 'val' ELSE 'test' END"


STRATIFIED_SQL = f"""ranked AS (SELECT *, {rank_sql('o_orderstatus')} AS r, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
  split AS (SELECT *, {split_sql('r', 'n')} AS split FROM ranked)"""
PLAIN_SQL = f"""ranked AS (SELECT *, {rank_sql()} AS r, count(*) OVER () AS n FROM orders),
  split AS (SELECT *, {split_sql('r', 'n')} AS split FROM ranked)"""


@query("stable_rank", f"SELECT o_orderkey, o_orderstatus, {rank_sql('o_orderstatus')} AS rank FROM orders")
def stable_rank(spark, sf):
    return ranks.hash_rank(_orders(spark, sf), "o_orderkey", 42, ["o_orderstatus"]).select(
        "o_orderkey", "o_orderstatus", "rank"
    )


@query("split_stratified", f"WITH {STRATIFIED_SQL} SELECT o_orderkey, o_orderstatus, split FROM split")
def split_stratified(spark, sf):
    out = splits.split_stratified(_orders(spark, sf), "o_orderkey", "o_orderstatus")
    return out.select("o_orderkey", "o_orderstatus", "split")


@query("split_plain", f"WITH {PLAIN_SQL} SELECT o_orderkey, split FROM split")
def split_plain(spark, sf):
    return splits.split_plain(_orders(spark, sf), "o_orderkey").select("o_orderkey", "split")


@query(
    "split_stratified_loader",
    f"""WITH ranked AS (SELECT doc_id, toxic, {rank_sql('toxic', 'doc_id', '7')} AS r, count(*) OVER (PARTITION BY toxic) AS n FROM labels)
    SELECT doc_id, toxic::BIGINT AS toxic, {split_sql('r', 'n').replace('0.7::', '0.8::').replace('0.15::', '0.1::')} AS split FROM ranked""",
)
def split_stratified_loader(spark, sf):
    return tidy(
        splits.split_stratified(table(spark, sf, "labels"), "doc_id", "toxic", (0.8, 0.1, 0.1), 7).select(
            "doc_id", "toxic", "split"
        )
    )


@query(
    "split_tiny",
    f"""WITH ranked AS (SELECT r_regionkey, {rank_sql('', 'r_regionkey')} AS r, count(*) OVER () AS n FROM region)
    SELECT r_regionkey::BIGINT AS r_regionkey, {split_sql('r', 'n')} AS split FROM ranked""",
)
def split_tiny(spark, sf):
    return tidy(splits.split_tiny(table(spark, sf, "region"), "r_regionkey").select("r_regionkey", "split"))


@query(
    "split_three_rows",
    "SELECT o_orderstatus, CASE WHEN o_orderstatus = max(o_orderstatus) OVER () THEN 'val' ELSE 'train' END AS split FROM (SELECT DISTINCT o_orderstatus FROM orders)",
)
def split_three_rows(spark, sf):
    """The three statuses of all orders: too few rows for three splits."""
    return splits.split_tiny(table(spark, sf, "orders").select("o_orderstatus").distinct(), "o_orderstatus")


@query(
    "leakage_check",
    f"""WITH {STRATIFIED_SQL}, c AS (SELECT o_custkey, count(*) AS n, count(DISTINCT split) AS s FROM split GROUP BY 1)
    SELECT sum(n)::BIGINT AS "rows", 0::BIGINT AS unassigned, count(*) AS keys, count(*) FILTER (s > 1) AS leaking_keys FROM c""",
)
def leakage_check(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return splits.leakage_check(splits.split_stratified(orders, "o_orderkey", "o_orderstatus"), "o_custkey")


@query("take_first", "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 100")
def take_first(spark, sf):
    return splits.take_first(_orders(spark, sf), 100, "o_orderkey").select("o_orderkey")


@query(
    "take_last",
    "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || '|42') DESC, o_orderkey DESC LIMIT 100",
)
def take_last(spark, sf):
    return splits.take_last(_orders(spark, sf), 100, "o_orderkey").select("o_orderkey")


@query(
    "train_val_edges",
    f"""WITH ranked AS (SELECT doc_id, {rank_sql('', 'doc_id')} AS r, count(*) OVER () AS n FROM labels)
    SELECT doc_id, 'train' AS role FROM ranked WHERE r <= 15
    UNION ALL SELECT doc_id, 'val' FROM ranked WHERE r > n - greatest(5, n - 15)""",
)
def train_val_edges(spark, sf):
    return splits.train_val_edges(table(spark, sf, "labels"), "doc_id").select("doc_id", "role")


@query("sample_share", f"SELECT event_id, event_type FROM events WHERE md5(event_id || '|s2') < '{int(0.05 * 16**15):015x}'")
def sample_share(spark, sf):
    return splits.sample_share(table(spark, sf, "events"), 0.05, "event_id", "s2").select("event_id", "event_type")


@query("sample_n", "SELECT event_id FROM events ORDER BY md5(event_id || '|s1'), event_id LIMIT 500")
def sample_n(spark, sf):
    return splits.sample_n(table(spark, sf, "events"), 500, "event_id", "s1").select("event_id")


@query(
    "cap_splits",
    f"""WITH {STRATIFIED_SQL}, capped AS (SELECT o_orderkey, split, {rank_sql('split')} AS k FROM split)
    SELECT o_orderkey, split FROM capped WHERE k <= CASE split WHEN 'train' THEN 700 ELSE 150 END""",
)
def cap_splits(spark, sf):
    out = splits.split_stratified(_orders(spark, sf), "o_orderkey", "o_orderstatus")
    return splits.cap_splits(out, "o_orderkey", 1000).select("o_orderkey", "split")


@query(
    "sequence_ids",
    "SELECT event_id, 'ade_example_' || (row_number() OVER (ORDER BY event_id) - 1) AS example_name FROM events",
)
def sequence_ids(spark, sf):
    return splits.sequence_ids(table(spark, sf, "events"), "event_id").select("event_id", "example_name")


@query(
    "batch_slices",
    "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 300 AS batch_no FROM events",
)
def batch_slices(spark, sf):
    return splits.batch_slices(table(spark, sf, "events"), "event_id", 300).select("event_id", "batch_no")


@query(
    "few_shot_select",
    f"""WITH ranked AS (SELECT o_orderkey, o_orderpriority, {rank_sql('o_orderpriority')} AS r FROM orders)
    SELECT o_orderkey, o_orderpriority FROM ranked WHERE r <= 8""",
)
def few_shot_select(spark, sf):
    picked = splits.few_shot_select(_orders(spark, sf), "o_orderkey", 8, ["o_orderpriority"])
    return picked.select("o_orderkey", "o_orderpriority")


@query(
    "bootstrap_sets",
    """WITH d AS (SELECT s AS set_no, doc_id, row_number() OVER (PARTITION BY s ORDER BY md5(doc_id || '|42/' || s), doc_id) AS position
      FROM labels, (SELECT unnest(range(5)) AS s))
    SELECT set_no, doc_id, position FROM d WHERE position <= 4""",
)
def bootstrap_sets(spark, sf):
    sets = splits.bootstrap_set_count(10)
    return splits.bootstrap_sets(table(spark, sf, "labels"), "doc_id", sets, 4).select("set_no", "doc_id", "position")


@query(
    "enough_examples",
    """SELECT count(*) AS n, CASE WHEN count(*) < 10 THEN 'Insufficient training data. Need at least 10 examples, got ' || count(*) END AS warning FROM region""",
)
def enough_examples(spark, sf):
    return splits.enough_examples(table(spark, sf, "region"), 10)


@query(
    "union_splits",
    f"""WITH {STRATIFIED_SQL} SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM split GROUP BY split""",
)
def union_splits(spark, sf):
    out = splits.split_stratified(_orders(spark, sf), "o_orderkey", "o_orderstatus")
    parts = {n: out.filter(F.col("split") == n).drop("split") for n in ("train", "val", "test")}
    merged = splits.union_splits(parts)
    return merged.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))
