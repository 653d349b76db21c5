"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for a text, the modular prefix sums of its code points times powers of a base, for two
bases. The hash of any span is a difference of two entries times an inverse power, so spans at any places
are compared in constant time, and the longest common extension of two places is found by binary search.

The fingerprint of a text is the hash of the whole text and the ``SKETCH`` smallest hashes of its spans of
``SPAN`` code points (of the one whole span, if it is shorter). Two fingerprints are alike as far as their
smallest hashes agree, an estimate of the share of common spans: 1 for equal texts, near 0 for unrelated
ones. The edited text of a document takes the beginning of its successor over its last quarter.

Documents are dealt and sorted by range of key, so each meets its successor in its own task; only the first
and the last document of each task travel on. Texts move once. Long texts are hashed in blocks.

Edge cases: null texts are empty, and two empty texts are alike; a single document is its own successor;
several rows with one key follow each other by a hash of their texts; null keys come first; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

PRIME = (1 << 31) - 1
BASES = (1_000_003, 998_244_353)
SPAN = 24
SKETCH = 64
BLOCK = 1 << 18


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME`` for values below 2 ** 62, by folding the high bits."""
    prime, shift = np.uint64(PRIME), np.uint64(31)
    x = (x & prime) + (x >> shift)
    x = (x & prime) + (x >> shift)
    return x - prime * (x >= prime)


class Powers:
    """Powers of a base, extended by doubling as longer texts come."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), PRIME))
            self.table = np.concatenate((self.table, _mod(self.table * step)))
        return self.table[:n]


POWERS = [Powers(b) for b in BASES]
INVERSES = [Powers(pow(b, -1, PRIME)) for b in BASES]


def points(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


class PrefixHash:
    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = []
        shifted = codes.astype(np.uint64) + np.uint64(1)
        for powers in POWERS:
            terms = _mod(shifted * powers.upto(self.n))
            self.sums.append(np.concatenate((np.zeros(1, dtype=np.uint64), _mod(np.cumsum(terms, dtype=np.uint64)))))

    def spans(self, start: np.ndarray | int, stop: np.ndarray | int) -> np.ndarray:
        """62-bit hashes of spans, the same for equal spans wherever they are."""
        start, stop = np.asarray(start), np.asarray(stop)
        halves = []
        for sums, inverse in zip(self.sums, INVERSES):
            gap = sums[stop] + np.uint64(PRIME) - sums[start]
            halves.append(_mod(_mod(gap) * inverse.upto(self.n + 1)[start]))
        return (halves[0] << np.uint64(31)) | halves[1]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width``, in order."""
        halves = []
        for sums, inverse in zip(self.sums, INVERSES):
            gap = sums[width:] + np.uint64(PRIME) - sums[: self.n - width + 1]
            halves.append(_mod(_mod(gap) * inverse.upto(self.n - width + 1)))
        return (halves[0] << np.uint64(31)) | halves[1]

    def equal(self, i: int, j: int, length: int, other: PrefixHash | None = None) -> bool:
        """Whether the spans of ``length`` from i here and from j in ``other`` (or here) are equal."""
        other = other or self
        return bool(self.spans(i, i + length) == other.spans(j, j + length))

    def common_extension(self, i: int, j: int, other: PrefixHash | None = None) -> int:
        """Length of the longest common beginning of what follows i here and j in ``other``, by binary search."""
        other = other or self
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(i, j, middle, other) else (low, middle - 1)
        return low


def _smallest(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    if len(values) > 4 * SKETCH:
        bound = np.partition(values, 4 * SKETCH)[4 * SKETCH]
        few = np.unique(values[values <= bound])
        values = few if len(few) >= SKETCH else np.unique(values)
    return np.unique(np.concatenate((found, values)))[:SKETCH]


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread hashes over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Print:
    """Fingerprint of a text: 8 bytes of the whole, the first 4 of each of its smallest span hashes.

    Prefix arrays are built block by block, with blocks that overlap by a span; those of a text of one block
    are kept for further comparisons.
    """

    __slots__ = ("key", "text", "codes", "sketch", "name", "prefixes")

    def __init__(self, text: str | None, key: int | None = None):
        self.key, self.text = key, text or ""
        self.codes = codes = points(self.text)
        n, width = len(codes), min(SPAN, len(codes))
        value, smallest, part = n, np.zeros(0, dtype=np.uint64), PrefixHash(codes[:0])
        for at in range(0, n, BLOCK):
            part = PrefixHash(codes[at : at + BLOCK + width - 1])
            value = (value * BASES[0] + int(part.spans(0, min(BLOCK, n - at)))) % ((1 << 61) - 1)
            if part.n >= width:
                smallest = _smallest(smallest, _mix(part.windows(width)))
        self.sketch, self.prefixes = smallest, part if n <= BLOCK else None
        self.name = value.to_bytes(8, "big") + (smallest >> np.uint64(32)).astype(">u4").tobytes()

    def common_prefix(self, other: Print) -> int:
        """Code points both texts begin with: whole blocks by their hashes, the last one by binary search."""
        if self.prefixes is not None and other.prefixes is not None:
            return self.prefixes.common_extension(0, 0, other.prefixes)
        for at in range(0, max(len(self.codes), len(other.codes)), BLOCK):
            x, y = (PrefixHash(c[at : at + BLOCK]) for c in (self.codes, other.codes))
            n = x.common_extension(0, 0, y)
            if n < BLOCK:
                return at + n
        return min(len(self.codes), len(other.codes))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common spans, estimated from the smallest hashes of both; 1 if both are empty."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = np.unique(np.concatenate((a, b)))[:SKETCH]
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True)).mean())


RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, common_prefix long"
)
ROW = RESULT + ", task long, edge string, text string"
NAMES = [part.split()[0] for part in ROW.split(", ")]


def edited(text: str, after: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def compared(doc: Print, after: Print) -> tuple:
    other = Print(edited(doc.text, after.text))
    digest = hashlib.sha256(other.text.encode("utf-8", "surrogatepass")).digest()
    near = likeness(doc.sketch, other.sketch), likeness(doc.sketch, after.sketch)
    return (doc.key, len(doc.codes), digest, doc.name, other.name, *near, doc.common_prefix(other))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=NAMES)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of one task: results for all but the last; the first and the last go on as edges."""
    task, last = TaskContext.get().partitionId(), None

    def edge(doc: Print, kind: str) -> tuple:
        return (doc.key, *[None] * 7, task, kind, doc.text)

    for batch in batches:
        rows: list[tuple] = []
        for key, text in zip(batch.column(0), batch.column(1)):
            doc = Print(text.as_py(), key.as_py())
            rows.append(edge(doc, "first") if last is None else (*compared(last, doc), task, None, None))
            last = doc
        if rows:
            yield _batch(rows)
    if last is not None:
        yield _batch([edge(last, "last")])


def _bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, after_key, after in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            rows.append((*compared(Print(text, key), Print(after, after_key)), None, None, None))
        if rows:
            yield _batch(rows).select(NAMES[:8])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``RESULT`` for every row, bytes as hex digits.

    ``common_prefix`` is what text and edited text begin with alike.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.hash("text")]
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = stage(dealt.mapInArrow(_walk, ROW), "fingerprints")
    done = walked.where("edge is null").select(*NAMES[:8])
    # One row for each end of a task: the last document of a task meets the first of the next one.
    firsts = walked.where("edge = 'first'").select("task", F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    ordered = Window.orderBy("task")
    places = firsts.select("task", F.coalesce(F.lead("task").over(ordered), F.min("task").over(Window.partitionBy())).alias("next_task"))
    lasts = walked.where("edge = 'last'").select("task", "doc_id", "text").join(places, "task")
    pairs = lasts.join(firsts.withColumnRenamed("task", "next_task"), "next_task").select("doc_id", "text", "next_id", "next_text")
    shown = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return done.union(pairs.mapInArrow(_bridge, RESULT)).withColumns(shown)
