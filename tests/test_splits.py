import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import ranks, splits

from .conftest import collected


def numbers(spark, n, positive_share=3):
    return spark.range(n).select(F.col("id").alias("key"), (F.col("id") % positive_share == 0).alias("label"))


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_plain_sizes(spark):
    assert sizes(splits.split_plain(numbers(spark, 100), "key")) == {"train": 70, "val": 15, "test": 15}
    assert sizes(splits.split_plain(numbers(spark, 100), "key", (0.8, 0.1, 0.1))) == {"train": 80, "val": 10, "test": 10}
    assert sizes(splits.split_plain(numbers(spark, 0), "key")) == {}


def test_bad_ratios(spark):
    with pytest.raises(ValueError):
        splits.split_plain(numbers(spark, 10), "key", (0.5, 0.1, 0.1))


def test_stratified_sizes_and_members(spark):
    df = splits.split_stratified(numbers(spark, 1000), "key", "label")
    got = Counter((r["label"], r["split"]) for r in df.collect())
    assert got == {
        (True, "train"): 234, (True, "val"): 50, (True, "test"): 50,
        (False, "train"): 466, (False, "val"): 100, (False, "test"): 100,
    }
    positives = order([k for k in range(1000) if k % 3 == 0])
    train = {r["key"] for r in df.filter("label and split = 'train'").collect()}
    assert train == set(positives[:234])


def test_published_corpus_sizes(spark):
    df = spark.range(23516).select(F.col("id").alias("key"), (F.col("id") < 6821).alias("label"))
    got = Counter((r["label"], r["split"]) for r in splits.split_stratified(df, "key", "label").collect())
    assert (got[(False, "train")], got[(True, "train")]) == (11687, 4775)
    assert got[(False, "test")] + got[(True, "test")] == 3527


def test_split_does_not_depend_on_partitions(spark):
    a = splits.split_stratified(numbers(spark, 300).repartition(1), "key", "label")
    b = splits.split_stratified(numbers(spark, 300).repartition(7), "key", "label")
    assert collected(a, "key") == collected(b, "key")


def test_null_label_is_a_class(rows):
    df = rows([(i, None if i % 2 else "x") for i in range(40)], "key long, label string")
    got = Counter((r["label"], r["split"]) for r in splits.split_stratified(df, "key", "label").collect())
    assert got[(None, "train")] == 14 and got[("x", "test")] == 3 and sum(got.values()) == 40


def test_rows_are_assigned_without_a_shuffle(spark, tmp_path):
    numbers(spark, 1000).write.parquet(str(tmp_path / "t"))
    df = splits.split_stratified(spark.read.parquet(str(tmp_path / "t")), "key", "label")
    plan = df._jdf.queryExecution().executedPlan().toString()
    rows_plan = plan.split("Subquery")[0]  # what follows are the cut points
    assert "Exchange" not in rows_plan and "Join" not in rows_plan


def test_leakage(spark):
    df = splits.split_plain(numbers(spark, 100), "key")
    assert tuple(splits.leakage_check(df, "key").first()) == (100, 0, 100, 0)
    twice = df.union(df.withColumn("split", F.lit("test")))
    assert splits.leakage_check(twice, "key").first()["leaking_keys"] == 85


@pytest.mark.parametrize("n, wanted", [(1, {"val": 1}), (2, {"train": 1, "val": 1}), (3, {"train": 2, "val": 1}), (10, {"train": 7, "val": 2, "test": 1})])
def test_tiny(spark, n, wanted):
    df = splits.split_tiny(numbers(spark, n), "key")
    assert sizes(df) == wanted
    if n <= 3:
        assert df.filter("split = 'val'").first()["key"] == n - 1


def test_capped_splits(spark):
    df = numbers(spark, 1000).withColumn("split", F.when(F.col("key") < 600, "train").when(F.col("key") < 603, "val").otherwise("test"))
    assert sizes(splits.cap_splits(df, "key", 30)) == {"train": 21, "val": 3, "test": 4}


def test_takes(spark):
    df = numbers(spark, 50)
    wanted = order(range(50))
    assert {r["key"] for r in splits.take_first(df, 5, "key").collect()} == set(wanted[:5])
    assert {r["key"] for r in splits.take_last(df, 5, "key").collect()} == set(wanted[-5:])
    assert splits.sample_n(df, 500, "key").count() == 50


def test_edges_overlap(spark):
    got = Counter(r["role"] for r in splits.train_val_edges(numbers(spark, 17), "key").collect())
    assert got == {"train": 15, "val": 5}


def test_batches(spark):
    got = Counter(r["batch_no"] for r in splits.batch_slices(numbers(spark, 10), "key", 3).collect())
    assert got == {0: 3, 1: 3, 2: 3, 3: 1}
    names = {r["key"]: r["example_name"] for r in splits.sequence_ids(numbers(spark, 5), "key").collect()}
    assert names[0] == "ade_example_0" and names[4] == "ade_example_4"


def test_few_shot(spark):
    got = splits.few_shot_select(numbers(spark, 100), "key", 4, ["label"])
    assert Counter(r["label"] for r in got.collect()) == {True: 4, False: 4}
    assert splits.few_shot_select(numbers(spark, 3), "key", 5).count() == 3


def test_bootstrap(spark):
    assert [splits.bootstrap_set_count(n) for n in (1, 6, 10)] == [3, 3, 5]
    got = splits.bootstrap_sets(numbers(spark, 100), "key", 3, 4).collect()
    assert Counter(r["set_no"] for r in got) == {0: 4, 1: 4, 2: 4}
    assert [r["key"] for r in got if r["set_no"] == 1] == order(range(100), "42/1")[:4]
    assert splits.enough_examples(numbers(spark, 2)).first()["warning"].endswith("got 2")
    assert splits.enough_examples(numbers(spark, 3)).first()["warning"] is None


def test_union(spark):
    merged = splits.union_splits({"train": numbers(spark, 3), "val": numbers(spark, 2)})
    assert sizes(merged) == {"train": 3, "val": 2}


def test_ranks_over_many_buckets(spark):
    """Ids far apart fall in many buckets and several upper levels."""
    ids = [-5, 0, 1, 2**20, 2**20 + 1, 2**41, 2**41 + 2**20, 2**60]
    df = spark.createDataFrame([(i, i % 2) for i in ids], "id long, g long")
    assert [r["rank"] for r in ranks.id_rank(df, "id").orderBy("id").collect()] == list(range(1, 9))


def test_running_totals_of_sparse_and_packed_ids(spark):
    """Ids far apart, packed from two fields, and a hot group: every row its exact totals."""
    ids = {"dense": F.col("id"), "sparse": F.xxhash64("id"), "packed": (F.col("id") % 7) * F.lit(1 << 56) + F.col("id")}
    for kind, value in ids.items():
        df = spark.range(500).select(value.alias("id"), F.when(F.col("id") % 5 > 0, "hot").otherwise(F.lit(None)).alias("g"))
        got = ranks.running_totals(df, "id", {"n": F.lit(1).cast("long"), "s": F.col("id") % 1000}, ["g"]).collect()
        seen = {}
        for r in sorted(got, key=lambda r: r["id"]):
            n, s = seen.get(r["g"], (0, 0))
            seen[r["g"]] = n + 1, s + (abs(r["id"]) % 1000) * (1 if r["id"] >= 0 else -1)
            assert (r["n"], r["s"]) == seen[r["g"]], kind
        spread = ranks.with_id_bucket(df, "id", "b").groupBy("b").count().agg(F.max("count"), F.count("*")).first()
        assert spread[0] <= 16 and spread[1] > 100


def test_key_columns_are_told_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")], "p string, q string")
    assert df.select(ranks.hash_key(["p", "q"], 1).alias("h")).distinct().count() == 4


def test_samples_come_from_one_pass_without_a_single_task(spark):
    df = numbers(spark, 200)
    for taken in (splits.take_first(df, 20, "key"), splits.take_last(df, 20, "key"), splits.few_shot_select(df, "key", 3, ["label"])):
        assert "SinglePartition" not in taken._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert splits.take_first(df, 0, "key").count() == splits.take_last(df, 0, "key").count() == 0
    assert splits.take_last(df, 500, "key").count() == splits.take_first(df, 500, "key").count() == 200
    sets = splits.bootstrap_sets(df, "key", 5, 4)
    assert sets._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert sets.count() == 20


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 60), train=st.sampled_from([0.0, 0.3, 0.7, 1.0]))
def test_sizes_are_exact(spark, n, train):
    val = (1 - train) / 2
    got = sizes(splits.split_plain(numbers(spark, n), "key", (train, val, 1 - train - val)))
    t, v = int(n * train + 0.5), int(n * val + 0.5)
    assert got.get("train", 0) == min(n, t) and got.get("val", 0) == min(v, n - min(n, t))
    assert sum(got.values()) == n


def test_any_number_of_groups(spark):
    """Two rows a group and a group of nulls: more groups than one value should hold."""
    groups = 100_050
    df = spark.range(2 * groups + 2).select(F.col("id").alias("key"), F.when(F.col("id") < 2 * groups, F.col("id") % groups).alias("user"))
    got = splits.split_stratified(df, "key", "user", (0.5, 0.5, 0.0))
    assert sizes(got) == {"train": groups + 1, "val": groups + 1}
    assert got.groupBy("user").agg(F.count_distinct("split").alias("n")).where("n = 2").count() == groups + 1
    assert splits.few_shot_select(df, "key", 1, ["user"]).count() == groups + 1


def test_a_share_of_the_rows(spark):
    df = spark.range(20_000)
    small, large = ({r.id for r in splits.sample_share(df, s, "id", 7).collect()} for s in (0.1, 0.3))
    assert small < large
    for share, found in ((0.1, small), (0.3, large)):
        assert abs(len(found) - 20_000 * share) <= splits.sample_bound(20_000, share)
    assert {r.id for r in splits.sample_share(df.repartition(7), 0.1, "id", 7).collect()} == small
    assert splits.sample_share(df, 0, "id").count() == 0 and splits.sample_share(df, 1, "id").count() == 20_000


def test_ranks_of_small_groups_beside_a_hot_one(spark):
    """Groups of few rows are ranked whole, one of many falls into buckets; null groups count as one."""
    g = F.when(F.col("id") < 11_000, "hot").when(F.col("id") % 50 != 0, F.concat(F.lit("g"), (F.col("id") % 300).cast("string")))
    df = spark.range(12_000).select("id", g.alias("g"))
    cold, hot = ranks.split_hot(df, df, [F.col("g")])
    assert {r["g"] for r in hot.select("g").distinct().collect()} == {"hot"} and cold.count() == 1_000
    seen = Counter()
    for r in ranks.id_rank(df, "id", ["g"]).orderBy("id").collect():
        seen[r["g"]] += 1
        assert r["rank"] == seen[r["g"]]
    by_hash = {}
    for r in ranks.hash_rank(df, "id", 7, ["g"]).collect():
        by_hash.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, seen[k] + 1)) for k, v in by_hash.items()) and len(by_hash) == len(seen)
