"""Whitening against the covariance's own eigenvectors."""

import numpy as np
import pytest

from tallyloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def expected(vectors, top=8):
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    sums = x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype(float)
    values, components = np.linalg.eigh(centred.T @ centred / n)
    by = np.argsort(-values)
    values, components = values[by], components[:, by]
    keep = np.flatnonzero(values[:top] > 1e-9 * max(values[0], 1e-300))
    return n, deviation, centred @ components[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def compare(rows, vectors, keys):
    n, deviation, white, explained = expected(vectors)
    assert len(rows) == len(vectors) * len(explained)
    got = {}
    for r in rows:
        assert r.n == n and r.identity_error < 1e-4 and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        got.setdefault(r.vec_id, {})[r.component] = (r.deviation, r.whitened)
    for i, key in enumerate(keys):
        assert {d for d, _ in got[key].values()} == {deviation[i]}
    for c in range(len(explained)):
        mine = np.array([got[k][c + 1][1] for k in keys])
        assert np.abs(np.abs(mine) - np.abs(white[:, c])).max() < 1e-6
        assert abs(abs(mine @ white[:, c]) / n - 1) < 1e-9  # one sign for all rows


@pytest.mark.parametrize("width, n", [(5, 40), (12, 200), (40, 30), (1, 7)])
def test_components_are_the_eigenvectors(spark, width, n):
    rng = np.random.default_rng(width)
    vectors = (rng.standard_normal((n, width)) @ np.diag(1 + np.arange(width)) * 0.3).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(3)
    compare(whitening.whiten(df).collect(), vectors, range(n))


def test_equal_and_missing_deviations(spark):
    """Two pairs of equal deviations, a constant dimension and one that copies another."""
    vectors = [[a, b, c, 0.5, a] for a in (-1.0, 1.0) for b in (-2.0, 2.0) for c in (-2.0, 2.0)]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()
    assert {r.component for r in rows} == {1, 2, 3} and max(r.identity_error for r in rows) < 1e-9
    shares = {r.component: r.explained for r in rows}
    assert [shares[c] for c in (1, 2, 3)] == pytest.approx([0.4, 0.4, 0.2])


def test_rows_that_are_dropped(spark):
    good = [[0.1, 0.2, float(i)] for i in range(5)] + [[1.0, -0.5, 0.25]]
    bad = [None, [], [0.1, None, 0.2], [float("nan"), 1.0, 1.0], [1.0, float("inf"), 1.0], [1.0, float("-inf"), 1.0], [1.0, 2.0]]
    rows = [(i, v, "x", "y") for i, v in enumerate(good)] + [(100 + i, v, "x", "y") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, SCHEMA + ", x string, n string")
    compare(whitening.whiten(df).collect(), good, range(6))


def test_repeated_rows_null_keys_and_empty_tables(spark):
    vectors = [[0.5, 1.0], [0.5, 1.0], [0.25, -1.0], [1.0, 0.0]]
    df = spark.createDataFrame([(7, vectors[0]), (7, vectors[1]), (None, vectors[2]), (3, vectors[3])], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in rows if r.component == 1) == [(False, 3), (False, 7), (False, 7), (True, None)]
    assert rows[0].n == 4
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 7")).collect() == []  # no deviation


def test_deviations_beyond_small_numbers():
    centre = whitening.Centre(3, [3 * 10**12, 3])
    x = np.array([[10**12 + 10**9, 1], [10**12 - 10**9, 1], [10**12, 1]])
    assert centre.deviations(x) == [9 * 10**18, 9 * 10**18, 0]
    centre = whitening.Centre(4, [4 * 10**12, 4])
    assert centre.deviations(np.array([[10**12 + 10**9, 1], [10**12, 1]])) == [None, 0]


def test_query(spark):
    from tallyloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    compare(QUERIES["op13_whitening"](spark, sf).collect(), [r.embedding for r in table], [r.vec_id for r in table])
