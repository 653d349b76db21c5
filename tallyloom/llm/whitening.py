"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, so sums and deviations are exact. The leading components of the centred rows X are
found by bidiagonalisation: ``X v`` and ``Xᵀ u`` alternate, each new direction is made orthogonal to all earlier
ones, and the small bidiagonal matrix's singular value decomposition gives components and deviations.

The long side is never held anywhere: every left vector is a combination of rows, ``u = X z``, so a step keeps the
short ``z`` and one pass over the rows returns ``|X q|²``, ``Uᵀ X q`` and ``Xᵀ X q`` for a trial ``q`` together: what ``u`` shares with earlier left vectors is
taken off ``z`` and off the products alike, and measured again where much was lost. Each
task adds up its own rows; what reaches the driver is a few numbers per dimension and step. Rows are staged once as
whole numbers, so a pass reads nothing else, and a lost executor costs a part of one pass.

Steps go on until the wanted components no longer change (``SETTLED``) or the dimensions are used up; where a direction
vanishes, a fresh one orthogonal to the earlier ones is taken, so equal deviations are found as well.

Edge cases: rows whose vector is null, empty or holds null, NaN or infinite entries are dropped; of vectors of different
length, those with the most frequent length (the longer of equals) remain; repeated rows count and are returned as
rows of their own, null keys too; an empty table gives no rows; components without deviation (constant or dependent
dimensions, a single row) are not returned, so there may be fewer than ``top``; a deviation beyond 64 bits is null;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import drop_staged, stage

SCALE, SHIFT = 1024, 100_000
TOP = 8
#: Relative size of what may still change in a wanted component; and of a deviation that counts as none.
SETTLED, NOTHING = 1e-14, 1e-12
MOST = (1 << 63) - 1


def rounded(df: DataFrame, key: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x`` of the rows that remain, ``x`` being whole numbers."""
    wide = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    good = wide.where(F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", finite))
    return good.select("vec_id", F.transform("c", lambda c: F.floor(c * scale).cast("long") + shift).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Centre:
    """Exact centring: the whole part of the mean is taken off as integers, the rest as a fraction."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n * x - sums) ** 2)`` of each row, exact."""
        rest = np.array([s % self.n for s in self.sums], dtype=object)
        x = x - self.whole
        far = int(np.abs(x).max(initial=0) + 1) * self.n
        if far * far * x.shape[1] <= MOST:
            return ((self.n * x - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return [d if d <= MOST else None for d in ((x.astype(object) * self.n - rest) ** 2).sum(axis=1).tolist()]


def totals(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of the vector ``of(x)`` that each batch of whole-number rows gives.

    Each task sends one number per place; places are added up on Spark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = of(matrix(batch.column(0), width))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

    sums = rows.select("x").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(sums))
    for r in sums:
        out[r["place"]] = r["value"]
    return out


def _trial(centre: Centre, q: np.ndarray, z: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def of(x: np.ndarray) -> np.ndarray:
        x = centre.rows(x)
        p = x @ q
        return np.concatenate([[p @ p], (x @ z).T @ p, x.T @ p])

    return of


def _apart(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` without its part in the columns of ``basis``, taken off twice."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(rows: DataFrame, centre: Centre, top: int = TOP, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Unit components (columns, falling) and their singular values, ``top`` at most."""
    width = len(centre.sums)
    rng = np.random.default_rng(seed)

    def fresh(basis: np.ndarray) -> np.ndarray:
        v = _apart(rng.standard_normal(width), basis)
        return v / np.linalg.norm(v)

    v = fresh(np.zeros((width, 0)))[:, None]
    z = g = np.zeros((width, 0))  # left vectors are X z; g is Xᵀ X z
    alphas: list[float] = []
    betas: list[float] = []
    largest = 0.0
    while True:
        k = len(alphas)
        # u = X q, free of the left vector before by the recurrence and of all of them by what the pass finds.
        q = v[:, k] - (betas[-1] * z[:, k - 1] if k else 0.0)
        for _ in range(3):
            found = totals(rows, width, _trial(centre, q, z))
            shared = found[1 : 1 + k]
            q, back = q - z @ shared, found[1 + k :] - g @ shared
            size = found[0] - float(shared @ shared)
            if size >= found[0] / 2:  # else so much was taken off that rounding shows: measure again
                break
        alpha = float(np.sqrt(max(size, 0.0)))
        largest = max(largest, alpha)
        gone = alpha <= NOTHING * largest or largest == 0.0
        alphas.append(0.0 if gone else alpha)
        z = np.column_stack([z, np.zeros(width) if gone else q / alpha])
        g = np.column_stack([g, np.zeros(width) if gone else back / alpha])
        after = g[:, k] - alphas[k] * v[:, k]
        beta = 0.0
        if k + 1 < width:
            after = _apart(after, v)
            beta = float(np.linalg.norm(after))
            largest = max(largest, beta)
            if beta <= NOTHING * largest:
                beta, after = 0.0, fresh(v)
            else:
                after = after / beta
            v = np.column_stack([v, after])
        small = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(small)
        # What the next step can still change of a component is its share of the last left vector.
        open_ = beta * np.abs(left[-1, :top])
        betas.append(beta)
        if k + 1 == width or (k + 1 >= 2 * top and beta > 0 and (open_ <= SETTLED * values[0]).all()):
            break
    some = values[:top] > NOTHING * max(values[0], 1e-300)
    return v[:, : len(alphas)] @ right[:top][some].T, values[:top][some]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(centre: Centre, components: np.ndarray, deviations: np.ndarray, explained: np.ndarray, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(deviations)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column(1), len(centre.sums))
            value = (centre.rows(x) @ components) / deviations
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), centre.n)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(value.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=[c.split()[0] for c in WHITENED.split(", ")],
            )

    return run


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component."""
    spark = df.sparkSession
    all_rows = stage(rounded(df, key, vector), "vectors")
    widths = all_rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not widths:
        return spark.createDataFrame([], WHITENED)
    width, n = widths[0]
    rows = all_rows.where(F.size("x") == width)
    sums = rows.agg(*[F.sum(F.element_at("x", i + 1).cast("decimal(38,0)")) for i in range(width)]).first()
    centre = Centre(n, [int(s) for s in sums])
    components, values = bidiagonalise(rows, centre, top)
    spread = totals(rows, width, lambda x: np.array([np.square(centre.rows(x)).sum()]))[0]
    if len(values) == 0 or spread == 0:
        return spark.createDataFrame([], WHITENED)
    deviations, explained = values / np.sqrt(n), values**2 / spread

    def flat(x: np.ndarray) -> np.ndarray:
        return centre.rows(x) @ components / deviations

    middle = totals(rows, width, lambda x: flat(x).sum(axis=0)) / n

    def products(x: np.ndarray) -> np.ndarray:
        w = flat(x) - middle
        return (w.T @ w).ravel()

    covariance = totals(rows, width, products).reshape(len(values), -1) / n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    out = stage(rows.select("vec_id", "x").mapInArrow(_whitened(centre, components, deviations, explained, error), WHITENED), "whitened")
    drop_staged(all_rows)
    return out
