"""Toxicity: a counterfactual-regularised linear classifier over hashed words and word beginnings.

A document is the set of its lower-cased words without surrounding punctuation; each word gives a slot for
itself and one for each of its beginnings of 3 to 7 characters, so invented endings still match. The model
is a logistic regression with an L1 penalty and a counterfactual penalty: in every labelled text that names
a group, the group's words are swapped for another group's, and the squared difference of the two scores is
added to the loss. Naming a group then moves the score little whichever labels the groups happened to have.
Slots found in fewer than ``SEEN`` of the sampled texts get no weight, which keeps words that share a slot by
chance from adding up in long texts. The intercept is the middle of the margins that tell a quarter of the sample
apart best, under weights fitted on the other three quarters; the weights then come from the whole sample. ``SEEN``,
``SPARSITY`` and ``STEPS`` were chosen on a quarter of the labels that may be learned from.

Fitted on the driver from a bounded sample of labelled documents (``PER_LABEL`` of each label, by seeded
hash); every document is scored in place, whole, in one pass without a shuffle. The score reads the text
only.

Edge cases: null and empty texts get the score of an empty set; without labels of both kinds every score is
the share of positives (0.5 if there are no labels at all); repeated rows get equal scores; a null key
counts as not held out; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparse import Memo, Rows, sample_of_labels, slot

WIDTH = 1 << 18
PER_LABEL = 2000
STEPS = 300
SEEN = 5
BEGINNINGS = (3, 4, 5, 6, 7)
SPARSITY = 2e-3
FAIRNESS = 1.0
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"

#: Group words by kind; a word is swapped for the next one of its kind.
GROUPS = [
    ["man", "woman"], ["men", "women"], ["boy", "girl"], ["male", "female"], ["he", "she"], ["his", "her"],
    ["husband", "wife"], ["father", "mother"], ["gay", "straight", "lesbian", "bisexual", "queer"],
    ["transgender", "cisgender"], ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"],
    ["black", "white", "asian", "latino", "african", "european", "american", "arab", "indian"],
    ["young", "old", "elderly"], ["blind", "deaf", "disabled"], ["immigrant", "refugee", "native"],
    ["mann", "frau"], ["männer", "frauen"], ["homme", "femme"], ["hommes", "femmes"], ["hombre", "mujer"],
    ["hombres", "mujeres"], ["christ", "moslem", "jude"], ["chrétien", "musulman", "juif"], ["cristiano", "musulmán", "judío"],
]
SWAP = {w: group[(i + 1) % len(group)] for group in GROUPS for i, w in enumerate(group)}


def bare(word: str) -> str:
    return word.strip(PUNCTUATION)


def word_slots(word: str) -> list[int]:
    """Slots of one lower-cased word."""
    word = bare(word)
    if not word:
        return []
    tokens = [f"w {word}"] + [f"b {word[:k]}" for k in BEGINNINGS if len(word) >= k]
    return [slot(t, WIDTH) for t in tokens]


def swapped(words: set[str]) -> set[str] | None:
    """The words with group words exchanged, or nothing if there are none."""
    known = {w: SWAP[bare(w)] for w in words if bare(w) in SWAP}
    return {known.get(w, w) for w in words} if known else None


#: (label, documents of the label, slots, slots of the twin)
Sampled = list[tuple[int, int, bytes, bytes]]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of each sampled text and of its swapped twin (empty where nothing is swapped)."""
    memo = Memo(word_slots)

    def slots(words: set[str]) -> bytes:
        return np.unique(np.array([s for w in words for s in memo[w]], dtype="<i4")).tobytes()

    for batch in batches:
        sets = [set((t.as_py() or "").lower().split()) for t in batch.column(3)]
        twins = [swapped(s) for s in sets]
        columns = [pa.array([slots(s) for s in sets], pa.binary()), pa.array([slots(t) if t else b"" for t in twins], pa.binary())]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], *columns], names=["doc_id", "grade", "of", "slots", "twin"])


def _rows(packed: list[bytes]) -> Rows:
    return Rows([np.frombuffer(p, dtype="<i4") for p in packed], WIDTH)


def fit(sample: Sampled) -> tuple[np.ndarray, float]:
    """Weights and intercept from (label, documents of the label, slots, slots of the twin)."""
    label = np.array([r[0] for r in sample], dtype=float)
    if len(sample) == 0 or label.min() == label.max():
        share = 0.5 if len(sample) == 0 else float(np.clip(label[0], 0.01, 0.99))
        return np.zeros(WIDTH), float(np.log(share / (1 - share)))
    of = np.array([r[1] for r in sample], dtype=float)
    seen = {v: float((label == v).sum()) for v in (0.0, 1.0)}
    weight = of / np.array([seen[v] for v in label])  # each sampled row stands for so many labelled ones
    weight *= np.where(label == 1, 0.5 / weight[label == 1].sum(), 0.5 / weight[label == 0].sum())
    x = _rows([r[2] for r in sample])
    twins = [i for i, r in enumerate(sample) if r[3]]
    a, b = _rows([sample[i][2] for i in twins]), _rows([sample[i][3] for i in twins])

    def slope(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        error = weight * (1 / (1 + np.exp(-np.clip(x.dot(w) + bias, -40, 40))) - label)
        g = x.back(error)
        if twins:
            gap = (a.dot(w) - b.dot(w)) * (2 * FAIRNESS / len(twins))
            g += a.back(gap) - b.back(gap)
        return g, float(error.sum())

    step = 1 / (0.25 * x.norm() * weight.max() + (2 * FAIRNESS / len(twins) * 2 * (a.norm() + b.norm()) if twins else 0))
    w = ahead = np.zeros(WIDTH)
    bias = bias_ahead = 0.0
    t = 1.0
    for _ in range(STEPS):  # accelerated proximal gradient
        g, gb = slope(ahead, bias_ahead)
        new = ahead - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * SPARSITY, 0)
        new_bias, later = bias_ahead - gb, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, bias_ahead = new + (t - 1) / later * (new - w), new_bias
        w, bias, t = new, new_bias, later
    return w, bias


def common_slots(sample: Sampled) -> Sampled:
    """The sample without slots that fewer than ``SEEN`` of its texts have."""
    texts = np.zeros(WIDTH, dtype=np.int64)
    for row in sample:
        texts[np.frombuffer(row[2], dtype="<i4")] += 1

    def cut(packed: bytes) -> bytes:
        slots = np.frombuffer(packed, dtype="<i4")
        return slots[texts[slots] >= SEEN].tobytes()

    return [(label, of, cut(slots), cut(twin)) for label, of, slots, twin in sample]


def middle(margins: np.ndarray, label: np.ndarray) -> float:
    """The margin that tells the labels apart best, both kinds weighing the same: the middle of the best stretch."""
    order = np.argsort(margins, kind="stable")
    sorted_margins, positive = margins[order], label[order] == 1
    # A cut before place i calls i.. toxic.
    right = np.concatenate([[0.0], np.cumsum(~positive)]) / (~positive).sum()
    right += np.concatenate([np.cumsum(positive[::-1])[::-1], [0.0]]) / positive.sum()
    between = np.concatenate([[True], np.diff(sorted_margins) > 0, [True]])  # equal margins are not told apart
    best = np.flatnonzero(between & (right >= right[between].max() - 1e-9))
    edges = np.concatenate([sorted_margins[:1], sorted_margins, sorted_margins[-1:]])
    return float((edges[best[0]] + edges[best[-1] + 1]) / 2)


def fit_centred(sample: Sampled) -> tuple[np.ndarray, float]:
    """``fit`` on the slots that are common enough, the intercept moved to the middle found on rows left out."""
    kept = common_slots(sample)
    aside = [r for i, r in enumerate(kept) if i % 4 == 0]
    rest = [r for i, r in enumerate(kept) if i % 4]
    weights, bias = fit(kept)
    if len({r[0] for r in aside}) < 2 or len({r[0] for r in rest}) < 2:
        return weights, bias
    part, part_bias = fit(rest)
    margins = _rows([r[2] for r in aside]).dot(part) + part_bias
    return weights, bias - middle(margins, np.array([r[0] for r in aside]))


def _scores(slots: np.ndarray, values: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(WIDTH)
        weights[slots] = values
        # A word's slots count once a document, as in the fit; words that share none of the weights need no sets.
        memo = Memo(lambda word: tuple(s for s in set(word_slots(word)) if weights[s]))
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                found: set[int] = set()
                for hit in map(memo.__getitem__, set((text.as_py() or "").lower().split())):
                    if hit:
                        found.update(hit)
                out[i] = bias + sum(weights[s] for s in sorted(found))
            score = 1 / (1 + np.exp(-np.clip(out, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; labels of held-out keys are never read."""
    held_out = F.coalesce(F.crc32(F.col(key).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    sample = sample_of_labels(labels.where(~held_out), docs, key, text, F.col(label).cast("int"), PER_LABEL)
    kept = sample.select("doc_id", "grade", "of", "text").mapInArrow(_features, "doc_id long, grade int, of long, slots binary, twin binary")
    rows = sorted(kept.collect(), key=lambda r: r["doc_id"])
    weights, bias = fit_centred([(int(r["grade"] > 0), r["of"], r["slots"], r["twin"]) for r in rows])
    used = np.flatnonzero(weights)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string"), held_out.alias("held_out")).mapInArrow(
        _scores(used, weights[used], bias), "doc_id long, held_out boolean, score double, predicted int"
    )
