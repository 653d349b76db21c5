"""Quality rules by weak supervision.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0). No labels: the votes of
all documents are counted by pattern, and expectation-maximisation estimates the share of good texts and
each rule's accuracy from how the rules agree. A document's posterior probability of being good follows from
its votes, and it is kept at ``KEEP`` or more: one rule against the others does not reject a text.

One pass over the texts computes the counts (staged); patterns number at most 3 to the power of the rules,
so only that bounded table of counts reaches the driver.

Edge cases: null and empty texts have no words and fail the base rules; with an empty table there are no
rows; a text on which all rules abstain has the estimated share; repeated rows get equal verdicts; further columns
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

WINDOW = 8
ROUNDS = 60
KEEP = 0.5
PRIOR, ACCURACY = 0.8, 0.9  # where EM starts
BOUNDS = (0.55, 0.99)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_again", "n_capitals", "n_lettered", "n_distinct", "n_marked", "n_stops",
)
SYMBOLS = regex.compile(r"[#*$%&|<>]")
LETTER = regex.compile(r"\p{L}")


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more, the first occurrence included.

    Windows are compared exactly: ranks of runs of 1, 2, 4, ... words are paired until they span the window.
    """
    if len(words) <= window:
        return 0
    known: dict[str, int] = {}
    rank = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    if len(known) == len(words):
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)
        pair = rank[:-step] * (len(words) + 1) + rank[step:]
        values, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(values) == len(rank):
            return 0
        size += step
    starts = np.flatnonzero(counts[rank] > 1)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text. Words end at space and the ASCII controls 9 to 13 only."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    chars = sum(len(w.decode("utf-8", "surrogatepass")) for w in words) if len(raw) != len(text) else sum(map(len, words))
    kinds = Counter(words)
    capitals = lettered = marked = stops = 0
    for word, n in kinds.items():
        shown = word.decode("utf-8", "surrogatepass")
        if LETTER.search(shown):
            lettered += n
            capitals += n * (len(shown) > 2 and shown.upper() == shown)
        marked += n * (shown[-1] in "#*$%&|<>!" or shown[0] in "#*$%&|<>")
        stops += n * (shown[-1] in ".?!;:")
    return (
        len(words), chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeat_words(words),
        len(lines), sum(map(eq, words, words[1:])), capitals, lettered, len(kinds), marked, stops,
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [counts_of(t.as_py() or "") for t in batch.column(1)]
        columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[] for _ in COUNTS])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *COUNTS])


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        _counts, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Votes by name. A rule speaks where its count is telling and abstains elsewhere."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))

    def bad(found: Column) -> Column:
        return F.when(found, -1).otherwise(0)

    mean = F.col("word_chars") / n
    again, letters, stops = F.col("n_again") / n, F.col("n_lettered") / n, F.col("n_stops") / n
    plain = (F.col("n_symbols") / n < 0.05) & (F.col("n_marked") / n < 0.05)
    return {
        "symbols": bad(F.col("n_symbols") / n > 0.10),
        "marked_words": bad(F.col("n_marked") / n > 0.20),
        "capitals": bad(F.col("n_capitals") / n > 0.30),
        "same_word_again": bad(again > 0.10),
        "repeated_windows": bad(F.col("n_repeat_words") / n > 0.20),
        "repeated_lines": bad(F.col("n_dup_lines") / lines > 0.30),
        "few_letters": bad(letters < 0.70),
        "word_length": bad((F.col("n_words") > 0) & ((mean < 2) | (mean > 20))),
        "little_variety": bad((F.col("n_words") >= 50) & (F.col("n_distinct") / n < 0.12)),
        "prose": F.when(plain & (letters >= 0.9) & (again < 0.05) & (F.col("n_capitals") / n < 0.2), 1).otherwise(0),
        "sentences": F.when(plain & (stops >= 0.01) & (stops <= 0.34) & (mean >= 3) & (mean <= 15) & (again < 0.05), 1).otherwise(0),
    }


def fit(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Share of good texts and the accuracy of each rule, by EM over counted vote patterns.

    A vote is right with the rule's accuracy, independently of the others given the truth; abstaining says
    nothing. Rules are taken to be better than chance, which settles which class is the good one.
    """
    accuracy, prior = np.full(patterns.shape[1], ACCURACY), PRIOR
    spoken = (patterns != 0) * counts[:, None]
    for _ in range(ROUNDS if len(counts) else 0):
        good = posterior(patterns, prior, accuracy)[:, None]
        prior = float(np.clip((good[:, 0] * counts).sum() / counts.sum(), 0.05, 0.95))
        right = np.where(patterns > 0, good, 1 - good) * spoken
        accuracy = np.clip((right.sum(axis=0) + ACCURACY) / (spoken.sum(axis=0) + 1), *BOUNDS)
    return prior, accuracy


def posterior(patterns: np.ndarray, prior: float, accuracy: np.ndarray) -> np.ndarray:
    """Probability of being good for each row of votes."""
    gap = patterns @ np.log(accuracy / (1 - accuracy)) + np.log(prior / (1 - prior))
    return 1 / (1 + np.exp(-gap))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``good_probability`` and ``kept`` for every row."""
    votes = rules()
    counted = stage(text_counts(docs, key, text).withColumns({f"vote_{k}": v.cast("int") for k, v in votes.items()}), "rule-votes")
    names = [f"vote_{k}" for k in votes]
    grouped = counted.groupBy(*names).count().orderBy(*names).collect()
    patterns = np.array([r[:-1] for r in grouped], dtype=np.int64).reshape(-1, len(names))
    prior, accuracy = fit(patterns, np.array([r[-1] for r in grouped], dtype=float))
    odds = F.lit(float(np.log(prior / (1 - prior))))
    for name, weight in zip(names, np.log(accuracy / (1 - accuracy)).tolist()):
        odds += F.col(name) * F.lit(weight)
    good = 1 / (1 + F.exp(-odds))
    return counted.withColumns({"base_failed": base_failed(), "good_probability": good}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good_probability") >= KEEP)
    )
