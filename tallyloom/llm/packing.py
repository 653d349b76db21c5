"""Best-fit packing by exact-complement hashing.

Every document is tokenised, ended with the ``END`` id and, if longer than the sequence, cut into full
pieces with the shorter remainder first. Packing needs only how many pieces have each length: at most
``limit`` counts, whatever the input. On those counts the planner takes lengths from the longest down and
looks up what fills the gap exactly: one length, a sum of two or a sum of three, each under the number of
pieces still available, and uses the combination as often as the counts allow. What no combination fills
goes to the fullest sequence that has room (best fit), again by counts.

The plan is a list of (lengths, times). Pieces then find their place by their rank within their length: each
task numbers its own pieces, one count per task and length gives the offsets, so no length, however common,
meets in one task.

Edge cases: null and empty texts are the ``END`` id alone; repeated rows are packed as rows of their own; an
empty table gives no rows; other columns than key and text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

LIMIT = 1024
END = 2


@lru_cache(maxsize=2)
def encoder(path: str):
    """Ids of the byte-level BPE vocabulary file at ``path``, by the faster of two equal implementations.

    The file's own library takes twice the time the task allows; its merges are in id order, so the same
    vocabulary read as ranks gives the same ids (tested against the file's library). The file's added tokens
    are found inside a text, as its library does without any setting; ``encode(text, allowed_special="all")``.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary, added = file["model"]["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(map(byte.__getitem__, piece)): i for piece, i in vocabulary.items() if all(c in byte for c in piece)}
    for content in added:
        ranks.pop(content.encode(), None)
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


@lru_cache(maxsize=2)
def named_encoder(path: str):
    """The vocabulary file's own library."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(path: str, text: str) -> list[int]:
    """Ids of a text; one that the faster implementation refuses (long white space) goes to the file's own library."""
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        return named_encoder(path).encode(text, add_special_tokens=False).ids


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"


def _cut(path: str, limit: int, end: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), ("task", pa.int64()), ("place", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = partial(token_ids, path), TaskContext.get().partitionId()
        seen = [0] * (limit + 1)
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0), batch.column(1)):
                key = key.as_py()
                ids = np.array(encode(text.as_py() or ""), dtype="<u4")
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                n = len(ids)
                first = n if n <= limit else n % limit or limit
                start = 0
                for piece in range(1 + (n - first) // limit):
                    length = limit if piece else first
                    rows.append((key, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), task, seen[length]))
                    seen[length] += 1
                    start += length
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END) -> DataFrame:
    """One row per piece with its length, checksum and number among the pieces of that length in its task."""
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(_cut(tokenizer, limit, end), PIECES)


def _complement(counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """The fewest lengths, largest first, that sum to ``gap`` and are all available; three at most."""
    if counts[gap]:
        return (gap,)
    have = np.flatnonzero(counts[: gap + 1])
    have = have[have > 0][::-1]
    left = counts.copy()
    for use in (1, 2):
        for a in have if use == 2 else (0,):
            if use == 2:
                left[a] -= 1
            rest = gap - int(a)
            b = have[(have >= rest - have) & (have < rest) & (have <= (a or gap))]
            c = rest - b
            ok = (left[b] > 0) & (left[c] > (b == c))
            if ok.any():
                i = int(np.argmax(ok))
                found = (int(b[i]), int(c[i]))
                return found if use == 1 else (int(a), *found)
            if use == 2:
                left[a] += 1
                if a * 3 < gap:
                    break
    return None


def plan(counts: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, times) for ``counts[length]`` pieces; every piece is used exactly once."""
    counts = counts.astype(np.int64).copy()
    sequences: list[tuple[tuple[int, ...], int]] = []
    open_: dict[tuple[int, ...], int] = {}
    if counts[limit]:
        sequences.append(((limit,), int(counts[limit])))
        counts[limit] = 0
    for length in range(limit - 1, 0, -1):
        while counts[length]:
            counts[length] -= 1
            fill = _complement(counts, limit - length)
            counts[length] += 1
            if fill is None:
                break
            used = np.bincount((length, *fill), minlength=limit + 1)
            times = int((counts[used > 0] // used[used > 0]).min())
            counts -= used * times
            sequences.append(((length, *fill), times))
    # Best fit of the rest, longest first: open sequences are kept by their free room.
    free: list[dict[tuple[int, ...], int]] = [{} for _ in range(limit + 1)]
    for length in range(limit - 1, 0, -1):
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, limit) if free[r]), None)
            if room is None:
                each = limit // length
                if left >= each:
                    shape, times = (length,) * each, left // each
                else:
                    shape, times = (length,) * left, 1
                left -= len(shape) * times
            else:
                base, there = free[room].popitem()
                fit = min(room // length, left)
                times = min(there, left // fit)
                if there > times:
                    free[room][base] = there - times
                shape, left = base + (length,) * fit, left - fit * times
            gap = limit - sum(shape)
            free[gap][shape] = free[gap].get(shape, 0) + times
    for open_ in free:
        sequences.extend(open_.items())
    return sequences


def slots(sequences: list[tuple[tuple[int, ...], int]], limit: int = LIMIT) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of ranks with the sequence, offset and stride of their first piece."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken = [0] * (limit + 1)
    first = 0
    for shape, times in sequences:
        offset = 0
        for length in shape:
            runs.setdefault(length, []).append((taken[length], first, offset))
            taken[length] += times
            offset += length
        first += times
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in runs.items()}


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _place(where: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                ranks, first, at = where[int(value)]
                run_of = np.searchsorted(ranks, rank[rows], side="right") - 1
                sequence[rows] = first[run_of] + rank[rows] - ranks[run_of]
                offset[rows] = at[run_of]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END) -> DataFrame:
    """Every piece of every document with its sequence and offset; sequences are gapless from offset 0.

    The driver sees one count per length (``limit`` numbers at most) and a plan whose size depends on
    ``limit`` only.
    """
    cut = stage(pieces(docs, tokenizer, key, text, limit, end), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n"))
    counts = np.zeros(limit + 1, dtype=np.int64)
    for length, n in cut.groupBy("length").count().collect():
        counts[length] = n
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("length", "task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    ranked = cut.join(starts, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("_from")).alias("rank")
    )
    return ranked.mapInArrow(_place(slots(plan(counts, limit), limit)), PLACED)
