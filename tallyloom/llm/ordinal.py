"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One set of weights over hashed text tokens gives a score, ordered thresholds cut the score into grades:
P(grade > k) = sigmoid(score - threshold k). Expected grade and tail probability follow for selection.

Tokens of a word: its letters, its beginning and its shape (which symbols end or surround it, all capitals,
digits, no letters at all, the same word again). A token's value is its share among the words of the text,
so the score is a mean over words and does not grow with length.

Fitted on the driver from a bounded sample of rated documents (``PER_GRADE`` of each grade, by seeded hash);
every document is scored in place, whole, in one pass without a shuffle.

Edge cases: a null or empty text has the score of the token for "no words"; with fewer than two grades among
the ratings nothing can be told apart: every document gets that grade (0 without ratings) and tail
probability 1, so none is rejected; repeated rows get equal results; rows
without key or rating are not fitted; further columns pass through, of the same name as a result they go.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sparse import Memo, Rows, sample_of_labels, slot

WIDTH = 1 << 16
PER_GRADE = 2000
STEPS = 300
RIDGE = 1e-4
SHAPE_SCALE = 3.0


def word_tokens(word: str) -> list[tuple[str, float]]:
    """Tokens of one word with their weight in the text."""
    letters = "".join(c for c in word if c.isalpha()).lower()
    marks = "".join(sorted({c for c in word if not c.isalnum()} - set(".,'")))
    out = [(f"w {letters}", 1.0), (f"b {letters[:3]}", 1.0)]
    if marks:
        out += [(f"m {marks}", SHAPE_SCALE), ("marked", SHAPE_SCALE)]
    if len(letters) > 1 and word.upper() == word:
        out.append(("capitals", SHAPE_SCALE))
    if not letters:
        out.append(("no letters", SHAPE_SCALE))
    if any(c.isdigit() for c in word):
        out.append(("digits", SHAPE_SCALE))
    if len(letters) > 20:
        out.append(("long", SHAPE_SCALE))
    return out


def word_slots(word: str) -> list[tuple[int, float]]:
    return [(slot(t, WIDTH), v) for t, v in word_tokens(word)]


AGAIN, EMPTY = slot("again", WIDTH), slot("no words", WIDTH)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Memo(word_slots)
    for batch in batches:
        slots, values = [], []
        for text in batch.column(3):
            words = (text.as_py() or "").split()
            dense: Counter = Counter()
            for word, n in Counter(words).items():
                for s, v in memo[word]:
                    dense[s] += v * n / len(words)
            if words:
                dense[AGAIN] += SHAPE_SCALE * sum(map(eq, words, words[1:])) / len(words)
            else:
                dense[EMPTY] += SHAPE_SCALE
            order = sorted(dense)
            slots.append(np.array(order, dtype="<i4").tobytes())
            values.append(np.array([dense[s] for s in order], dtype="<f8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in range(3)], pa.array(slots, pa.binary()), pa.array(values, pa.binary())],
            names=["doc_id", "grade", "of", "slots", "values"],
        )


@dataclass
class Model:
    """Weights of the slots in use and ascending thresholds between ``grades``."""

    slots: np.ndarray
    values: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(sample: list[tuple[int, int, bytes, bytes]]) -> Model:
    """Maximum likelihood of the cumulative-link model, each grade weighing the same, by Adam steps.

    Thresholds are a first one and the logarithms of the gaps, so they stay ordered.
    """
    grades, y = np.unique(np.array([r[0] for r in sample], dtype=float), return_inverse=True)
    if len(grades) < 2:
        return Model(np.zeros(0, dtype=int), np.zeros(0), np.zeros(0), grades if len(grades) else np.zeros(1))
    x = Rows([np.frombuffer(r[2], "<i4") for r in sample], WIDTH, [np.frombuffer(r[3], "<f8") for r in sample])
    sample.clear()  # the matrix holds it now
    weight = 1 / np.bincount(y)[y] / len(grades)
    k = len(grades) - 1
    w, theta = np.zeros(WIDTH), np.concatenate(([-1.0], np.zeros(k - 1)))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, theta)]
    for step in range(1, STEPS + 1):
        cuts = np.cumsum(np.concatenate((theta[:1], np.exp(theta[1:]))))
        score = x.dot(w)
        above = _sigmoid(score[:, None] - cuts[None, :])  # P(grade > j)
        padded = np.column_stack((np.ones(len(y)), above, np.zeros(len(y))))
        rows = np.arange(len(y))
        p = np.maximum(padded[rows, y] - padded[rows, y + 1], 1e-12)
        slope = padded * (1 - padded)
        d_low, d_high = slope[rows, y] / p, slope[rows, y + 1] / p
        d_score = -weight * (d_low - d_high)
        d_cuts = np.zeros(k)
        np.add.at(d_cuts, np.maximum(y - 1, 0), np.where(y > 0, weight * d_low, 0))
        np.add.at(d_cuts, np.minimum(y, k - 1), np.where(y < k, -weight * d_high, 0))
        d_theta = np.cumsum(d_cuts[::-1])[::-1] * np.concatenate(([1.0], np.exp(theta[1:])))
        for (m, v), param, grad in zip(moments, (w, theta), (x.back(d_score) + RIDGE * w, d_theta)):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    used = np.flatnonzero(w)
    return Model(used, w[used], np.cumsum(np.concatenate((theta[:1], np.exp(theta[1:])))), grades)


def train(docs: DataFrame, ratings: DataFrame, grade: Column, key: str = "doc_id", text: str = "text") -> Model:
    sample = sample_of_labels(ratings, docs, key, text, grade.cast("int"), PER_GRADE)
    kept = sample.select("doc_id", "grade", "of", "text").mapInArrow(_features, "doc_id long, grade int, of long, slots binary, values binary")
    rows = [tuple(r) for r in kept.collect()]
    rows.sort(key=lambda r: r[0])
    return fit([r[1:] for r in rows])


def _grades(model: Model, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(WIDTH)
        weights[model.slots] = model.values
        memo = Memo(lambda word: sum(weights[s] * v for s, v in word_slots(word)))
        again, empty = SHAPE_SCALE * weights[AGAIN], SHAPE_SCALE * weights[EMPTY]
        for batch in batches:
            score = np.empty(batch.num_rows)
            for i, value in enumerate(batch.column(batch.schema.get_field_index(text))):
                words = (value.as_py() or "").split()
                if not words:
                    score[i] = empty
                    continue
                total = sum(map(memo.__getitem__, words)) + again * sum(map(eq, words, words[1:]))
                score[i] = total / len(words)
            above = _sigmoid(score[:, None] - model.thresholds[None, :])
            expected = model.grades[0] + above @ np.diff(model.grades)
            tail = above[:, 0] if len(model.thresholds) else np.ones(len(score))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(expected), pa.array(tail)], names=[*names, "expected_grade", "tail_probability"])

    return run


def grade(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``expected_grade`` and ``tail_probability`` = P(grade above the lowest)."""
    names = [c for c in (keep or docs.columns) if c not in ("expected_grade", "tail_probability")]
    schema = T.StructType([docs.schema[c] for c in names]).add("expected_grade", "double").add("tail_probability", "double")
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(_grades(model, text, names), schema)
