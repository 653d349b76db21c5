"""Sparse rows for models fitted on a bounded sample, and the choice of that sample."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rows:
    """Rows of a sparse matrix: slots and values of each row, one after the other; without values all are 1."""

    def __init__(self, slots: list[np.ndarray], width: int, values: list[np.ndarray] | None = None):
        self.width, self.n = width, len(slots)
        sizes = np.array([len(s) for s in slots], dtype=np.int64)
        self.slots = np.concatenate(slots).astype(np.int32) if slots else np.zeros(0, dtype=np.int32)
        self.values = None if values is None else np.concatenate([*values, np.zeros(0)])
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), sizes)

    def _weighted(self, x: np.ndarray) -> np.ndarray:
        if self.values is not None:
            x *= self.values
        return x

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self._weighted(weights[self.slots]), minlength=self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.slots, weights=self._weighted(errors[self.row]), minlength=self.width)

    def norm(self) -> float:
        """Largest eigenvalue of the Gram matrix, nearly: a few power steps from a fixed start."""
        v = np.ones(self.width)
        size = 1.0
        for _ in range(12):
            v = self.back(self.dot(v))
            size = float(np.sqrt(v @ v)) or 1.0
            v /= size
        return size


def slot(token: str, width: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % width


class Memo(dict):
    """Values of words computed at first sight; emptied when it holds ``most`` words."""

    def __init__(self, value: Callable[[str], object], most: int = 200_000):
        super().__init__()
        self.value, self.most = value, most

    def __missing__(self, word: str):
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.value(word)
        return found


def sample_of_labels(labels: DataFrame, docs: DataFrame, key: str, text: str, grade: Column, per_grade: int) -> DataFrame:
    """``doc_id, text, grade, of`` for at most ``per_grade`` labelled documents of each grade.

    The documents with the least seeded hashes are taken; ``of`` is the number of labelled documents of the
    grade. At most grades times ``per_grade`` ids are broadcast, so documents are not shuffled. Rows without
    key or grade are left out; of repeated labels the greatest counts, of repeated documents the least text.
    """
    graded = labels.select(F.col(key).cast("long").alias("doc_id"), grade.alias("grade")).dropna()
    graded = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    sizes = {r["grade"]: r["n"] for r in graded.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for value, n in sorted(sizes.items()):
        part = graded.where(F.col("grade") == F.lit(value)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_grade)
        part = part.withColumn("of", F.lit(n).cast("long"))
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        chosen = graded.withColumn("of", F.lit(0).cast("long"))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    picked = texts.join(F.broadcast(chosen), "doc_id")
    return picked.groupBy("doc_id", "grade", "of").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
