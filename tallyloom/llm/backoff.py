"""Language-model scoring by a weighted backoff automaton.

The model has n-grams of 1 to ``order`` tokens with modified absolute discounting: from each history's counts
a discount of one of three sizes is taken, and the mass gained is spread by the next shorter history; below
the shortest lies an even share for every known token and one unknown. States are the histories that go on in
the training texts; an arc reads a counted token and carries its log10 probability; a failure arc leads to
the next shorter history and carries the log10 weight of falling back. A text is read once from left to
right: the state is carried, and weights of arcs and failure arcs add up.

The model grows with the corpus and is never whole in one place:

1. Tasks read texts into chunks of at most ``CHUNK`` tokens: numbers of words of the chunk's own vocabulary,
   and 64-bit hashes of these words. Chunks are staged.
2. For each n-gram length every chunk asks once about each of its different n-grams, with its own training
   count. Questions are dealt to blocks by history; a block adds up the counts of all chunks and answers
   each with the totals of its n-grams and histories. Histories with more than one in ``1 / SHARE`` of all
   tokens (fewer than ``SHARE`` at each length), the empty one and the one before a text are dealt by n-gram, and their sums over
   blocks are handed to all tasks.
3. Each chunk meets its answers, builds the part of the automaton that its own texts can reach and reads them.
   Long texts are read in pieces of ``PIECE`` tokens; a piece starts in the state that the tokens before leave.

So a question is a chunk's different n-gram, not an occurrence, and every task holds a chunk or a block.
Words are told apart by their 64-bit hashes (a billion words hold a pair of equal hashes with chance 0.03).

Edge cases: a null text is empty and consists of the end alone; without training texts every token has the
probability 1; a null key is no held-out key; repeated rows are counted and returned as rows of their own; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import pack, steps, unpack
from .staging import drop_staged, stage

ORDER = 2
CHUNK = 1 << 20
PIECE = 2048
BLOCK = 1 << 20
BLOCKS = 512
SHARE = 1024
SLICE = 1 << 18

#: No word holds white space, so these stand for the end and the start of a text.
END, START = b"\n", b" "
ROOT = np.uint64(0)
SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Numbers(dict):
    """Numbers of words in the order of their first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, one ``SLICE`` of text at a time."""
    at = 0
    while at < len(raw):
        cut = SPACE.search(raw, at + SLICE)
        to = cut.end() if cut else len(raw)
        yield raw[at:to].lower().split()
        at = to


CHUNKS = "chunk long, trained long, tokens long, payload binary"


def _chunk_row(chunk: int, vocabulary: Numbers, parts: list[np.ndarray], heads: list[tuple], order: int) -> tuple:
    """Payload: word hashes, the tokens of all pieces (each with the tokens before it), and a row per piece."""
    tokens = np.concatenate(parts).astype(np.uint32)
    # Frequent words get small numbers, which compress well.
    rank = np.argsort(-np.bincount(tokens, minlength=len(vocabulary)), kind="stable")
    number = np.empty(len(rank), dtype=np.uint32)
    number[rank] = np.arange(len(rank), dtype=np.uint32)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), dtype=np.uint64, count=len(vocabulary))
    row, key, missing, held = (np.array(c) for c in zip(*heads))
    sizes = np.array([len(p) for p in parts], dtype=np.uint32)
    trained = int((sizes - (order - 1))[~held].sum())
    payload = pack(hashes[rank], number[tokens], sizes, row.astype(np.int64), key.astype(np.int64), missing, held)
    return chunk, trained, int(sizes.sum()) - (order - 1) * len(sizes), payload


def _chunks(order: int, chunk_size: int, piece_size: int):
    schema = pa.schema([("chunk", pa.int64()), ("trained", pa.int64()), ("tokens", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        vocabulary, parts, heads, size, made, row = Numbers(), [], [], 0, 0, -1

        def done() -> pa.RecordBatch:
            nonlocal vocabulary, parts, heads, size, made
            found = _chunk_row(task + made, vocabulary, parts, heads, order)
            vocabulary, parts, heads, size, made = Numbers(), [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(found, schema)], schema=schema)

        for batch in batches:
            for key, held, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                row += 1
                before = [START] * (order - 1)
                texts = words_of(raw.as_py() or b"")
                words: list[bytes] = []
                more = True
                while more or words:
                    if more and len(words) < piece_size:
                        found = next(texts, None)
                        more = found is not None
                        words += found if more else [END]
                        continue
                    piece, words = words[:piece_size], words[piece_size:]
                    if size + len(piece) > chunk_size and size:
                        yield done()
                    read = before + piece
                    parts.append(np.fromiter(map(vocabulary.__getitem__, read), dtype=np.uint32, count=len(read)))
                    heads.append((task + row, 0 if key is None else key, key is None, held))
                    before = read[len(read) - (order - 1) :]
                    size += len(piece)
        if parts:
            yield done()

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """An invertible mix of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
        return x ^ (x >> np.uint64(32))


def extended(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a history with one more token; the empty history is ``ROOT``."""
    with np.errstate(over="ignore"):
        return mixed(history * np.uint64(0x9E3779B97F4A7C15) + word)


class Grams:
    """The different n-grams of one length in a chunk, in the order in which blocks are asked about them."""

    def __init__(self, history: np.ndarray, word: np.ndarray, hot: np.ndarray, blocks: int):
        self.spread = np.isin(history, hot)
        deal = np.where(self.spread, mixed(history ^ word), mixed(history))
        block = deal % np.uint64(blocks)
        self.order = np.lexsort((word, history, block))
        self.history, self.word, self.block = history[self.order], word[self.order], block[self.order].astype(np.int64)
        new = (self.history[1:] != self.history[:-1]) | (self.block[1:] != self.block[:-1])
        self.first = np.flatnonzero(np.append(True, new)) if len(history) else np.zeros(0, dtype=np.int64)
        self.sizes = np.diff(np.append(self.first, len(history)))


class Chunk:
    """A staged chunk, read back."""

    def __init__(self, payload: bytes, order: int):
        self.order = order
        self.hashes, tokens, sizes, self.row, self.key, self.missing, self.held = unpack(payload)
        self.tokens, self.sizes = tokens.astype(np.int32), sizes.astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        within = np.arange(len(tokens), dtype=np.int32) - np.repeat(self.begins, self.sizes).astype(np.int32)
        self.read = within >= order - 1  # the others only lead to a piece
        self.trained = self.read & ~np.repeat(self.held, self.sizes)
        # Number of the n-gram that ends at each place (-1 where it would start before its piece), by length.
        self.ending = [np.zeros(0, dtype=np.int32), self.tokens]
        self.parts = [(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)), (np.zeros(len(self.hashes), dtype=np.int64), np.arange(len(self.hashes)))]
        self.keys = [np.full(1, ROOT), extended(np.full(len(self.hashes), ROOT), self.hashes)]
        for n in range(2, order + 1):
            here = np.flatnonzero(within >= n - 1)
            whole, at = np.unique(self.ending[-1][here - 1] * np.int64(len(self.hashes)) + self.tokens[here], return_inverse=True)
            ending = np.full(len(tokens), -1, dtype=np.int32)
            ending[here] = at
            history, word = np.divmod(whole, len(self.hashes))
            self.ending.append(ending), self.parts.append((history, word))
            self.keys.append(extended(self.keys[-1][history], self.hashes[word]))

    def grams(self, n: int, hot: np.ndarray, blocks: int) -> Grams:
        history, word = self.parts[n]
        return Grams(self.keys[n - 1][history], self.hashes[word], hot, blocks)

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.ending[n][self.trained], minlength=len(self.parts[n][0]))


ASKED = "chunk long, block long, payload binary"


def _ask(n: int, order: int, hot: np.ndarray, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = Chunk(payload.as_py(), order)
                grams, counts = chunk.grams(n, hot, blocks), chunk.counts(n)
                counts = counts[grams.order].astype(np.uint32)
                edges = np.flatnonzero(np.append(True, grams.block[1:] != grams.block[:-1]))
                ends = np.append(edges[1:], len(grams.block))
                rows = []
                for a, b in zip(edges.tolist(), ends.tolist()):
                    i, j = np.searchsorted(grams.first, (a, b))
                    known = steps(grams.history[grams.first[i:j]])
                    rows.append(pack(known, grams.sizes[i:j].astype(np.uint32), grams.word[a:b], counts[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows), pa.int64()), pa.array(grams.block[edges]), pa.array(rows, pa.binary())],
                    names=["chunk", "block", "payload"],
                )

    return run


#: kind 0: an answer; 1: sums of a history that is dealt by n-gram; 2: numbers of n-grams by count; 3: a history to deal so next.
ANSWER, SUMS, COUNTS, NEXT = range(4)
ANSWERS = "kind int, chunk long, block long, payload binary, history long, n0 long, n1 long, n2 long, n3 long"


def _sums(groups: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each group of n-grams: all counts, and the number of n-grams counted once, twice and more often."""
    of = [count, count == 1, count == 2, count >= 3]
    return np.stack([np.add.reduceat(x.astype(np.int64), groups) for x in of], axis=1)


def answers(asked: list[tuple[int, bytes]], hot: np.ndarray, least: float) -> Iterator[tuple]:
    """Rows (kind, chunk, payload, history, n0 to n3) of one block."""
    read = [unpack(payload) for _, payload in asked]
    history = np.concatenate([np.repeat(np.cumsum(r[0], dtype=np.uint64), r[1]) for r in read])
    word = np.concatenate([r[2] for r in read])
    count = np.concatenate([r[3] for r in read]).astype(np.int64)
    order = np.lexsort((word, history))
    h, w = history[order], word[order]
    new = np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]))
    first = np.flatnonzero(new)
    total = np.add.reduceat(count[order], first)
    groups = np.flatnonzero(np.append(True, h[first][1:] != h[first][:-1]))
    sums, name = _sums(groups, total), h[first][groups]
    of_gram = np.empty(len(order), dtype=np.int64)
    of_gram[order] = np.cumsum(new) - 1
    at = 0
    for (chunk, _), r in zip(asked, read):
        mine = total[of_gram[at : at + len(r[2])]]
        own = sums[np.searchsorted(name, np.cumsum(r[0], dtype=np.uint64))]
        yield ANSWER, chunk, pack(mine, *own.T), None, None, None, None, None
        at += len(r[2])
    for k in np.flatnonzero(np.isin(name, hot)):
        yield SUMS, None, None, int(name[k].astype(np.int64)), *map(int, sums[k])
    yield COUNTS, None, None, None, *(int((total == k).sum()) for k in (1, 2, 3, 4))
    for k in np.flatnonzero(total > least):
        yield NEXT, None, None, int(extended(h[first][k : k + 1], w[first][k : k + 1])[0].astype(np.int64)), *[None] * 4


def _answer(hot: np.ndarray, least: float):
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
    names = [c.split()[0] for c in ANSWERS.split(", ")]

    def flush(block: int, asked: list[tuple[int, bytes]]) -> pa.RecordBatch:
        rows = [(kind, chunk, block, *rest) for kind, chunk, *rest in answers(asked, hot, least)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[int, bytes]] = []
        last = None
        for batch in batches:
            for chunk, block, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if asked and block != last:
                    yield flush(last, asked)
                    asked = []
                last = block
                asked.append((chunk, payload))
        if asked:
            yield flush(last, asked)

    return run


class Level:
    """What is known of one n-gram length: discounts, and sums of the histories that are dealt by n-gram."""

    def __init__(self, hot: np.ndarray, by_count: list[int], sums: dict[int, tuple[int, ...]]):
        self.hot, self.sums = hot, sums
        n = [0, *by_count]
        part = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cut = [i - (i + 1) * part * n[i + 1] / n[i] if n[i] else i * part for i in (1, 2, 3)]
        self.discount = np.array([0.0, *(min(max(d, 0.05), i - 0.05) for i, d in enumerate(cut, 1))])

    def spread(self, history: np.ndarray) -> np.ndarray:
        """Sums of histories in ``hot``, one row each."""
        none = (0, 0, 0, 0)
        return np.array([self.sums.get(k, none) for k in history.astype(np.int64).tolist()], dtype=np.int64).reshape(-1, 4)


class Automaton:
    """States, arcs and failure arcs that the texts of one chunk can reach.

    State 0 is the empty history. ``arc`` holds state * ``width`` + token, ascending, with ``weight`` and
    ``target``; ``fail`` and ``fall`` are the next shorter history of each state and the weight of leaving to it.
    """

    def __init__(self, chunk: Chunk, levels: list[Level], counted: list[np.ndarray], sums: list[np.ndarray]):
        order, self.width = chunk.order, len(chunk.hashes)
        seen = sums[0][0]
        known = int(seen[1:].sum())
        self.train_tokens, self.known = int(seen[0]), known
        lower = np.full(self.width, 1.0 / (known + 1))  # of the word alone, below the shortest history
        states = [np.zeros(1, dtype=np.int64)]  # number of the state of each n-gram of a length, -1 if it is none
        fail, fall, arcs, weights, targets = [np.zeros(1, dtype=np.int64)], [], [], [], []
        made = 1
        ends: list[tuple[np.ndarray, ...]] = []
        self.unknown = math.log10(1.0 / (known + 1))
        for n in range(1, order + 1):
            history, word = chunk.parts[n]
            total, of = sums[n - 1][history, 0], sums[n - 1][:, 0]
            lost = sums[n - 1][:, 1:] @ levels[n - 1].discount[1:]
            rest = np.divide(lost, of, out=np.ones(len(of)), where=of > 0)
            count = counted[n - 1]
            kept = count - levels[n - 1].discount[np.minimum(count, 3)]
            share = np.divide(kept, total, out=np.zeros(len(count)), where=total > 0)
            if n == 1:
                below = lower[word]
                self.unknown += math.log10(rest[0]) if of[0] else 0.0
            else:
                # The n-gram without its first token ends at the same places.
                shorter = np.empty(len(history), dtype=np.int64)
                here = chunk.ending[n] >= 0
                shorter[chunk.ending[n][here]] = chunk.ending[n - 1][here]
                below = probability[shorter]
            probability = np.where(count > 0, share, 0.0) + rest[history] * below
            is_state = states[n - 1] >= 0
            if n > 1:
                fall.append(np.log10(rest[is_state]))
            arc = (count > 0) & is_state[history]
            arcs.append(states[n - 1][history[arc]] * self.width + word[arc])
            weights.append(np.log10(probability[arc]))
            ends.append((np.full(arc.sum(), n), np.flatnonzero(arc)))
            if n < order:
                goes_on = sums[n][:, 0] > 0
                state = np.full(len(history), -1, dtype=np.int64)
                state[goes_on] = made + np.arange(goes_on.sum())
                made += int(goes_on.sum())
                if n == 1:
                    fail.append(np.zeros(goes_on.sum(), dtype=np.int64))
                    longest = np.where(goes_on, state, 0)
                    reached = [longest]
                else:
                    fail.append(reached[-1][shorter[goes_on]])
                    reached.append(np.where(goes_on, state, reached[-1][shorter]))
                states.append(state)
            else:
                shorter_of_last = shorter if n > 1 else None
        self.fail, self.fall = np.concatenate(fail), np.concatenate([np.zeros(1), *fall])
        for n, (_, at) in enumerate(ends, 1):
            if order == 1:
                targets.append(np.zeros(len(at), dtype=np.int64))
            else:
                targets.append(reached[n - 1][at] if n < order else reached[-1][shorter_of_last[at]])
        arc, weight, target = np.concatenate(arcs), np.concatenate(weights), np.concatenate(targets)
        by = np.argsort(arc, kind="stable")
        self.arc, self.weight, self.target = np.append(arc[by], np.iinfo(np.int64).max), weight[by], target[by]
        if order == 1:
            self.start = np.zeros(len(chunk.sizes), dtype=np.int64)
        else:
            self.start = reached[-1][chunk.ending[order - 1][chunk.begins + order - 2]]

    def read(self, tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log10 probability of each piece: all pieces are read from left to right side by side."""
        by = np.argsort(-sizes, kind="stable")
        state, begin, size = self.start[by].copy(), begins[by], sizes[by]
        total = np.zeros(len(by))
        for place in range(int(size[0]) if len(size) else 0):
            open_ = np.arange(np.searchsorted(-size, -place, side="left"))
            word = tokens[begin[open_] + place]
            while len(open_):
                here = state[open_]
                wanted = here * self.width + word[open_]
                at = np.searchsorted(self.arc, wanted)
                found = self.arc[at] == wanted
                hit, lost = open_[found], open_[~found]
                total[hit] += self.weight[at[found]]
                state[hit] = self.target[at[found]]
                from_ = state[lost]
                total[lost] += np.where(from_ == 0, self.unknown, self.fall[from_])
                state[lost] = self.fail[from_]
                open_ = lost[from_ != 0]
        out = np.empty(len(by))
        out[by] = total
        return out


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _joined(chunk: Chunk, level: Level, n: int, blocks: int, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Total counts of the chunk's n-grams, and sums of each of their histories (zero for those never asked about)."""
    grams = chunk.grams(n, level.hot, blocks)
    read = [unpack(p) for p in payloads]
    count = np.empty(len(grams.order), dtype=np.int64)
    count[grams.order] = np.concatenate([r[0] for r in read])
    each = np.concatenate([np.stack(r[1:], axis=1) for r in read])
    spread = grams.spread[grams.order[grams.first]]
    if spread.any():
        each[spread] = level.spread(grams.history[grams.first][spread])
    sums = np.zeros((len(chunk.parts[n - 1][0]), 4), dtype=np.int64)
    sums[chunk.parts[n][0][grams.order[grams.first]]] = each
    return count, sums


def score_chunk(chunk: Chunk, levels: list[Level], replies: list[list[bytes]], blocks: int) -> list[np.ndarray]:
    """Columns of ``SCORED`` for the pieces of a chunk."""
    found = [_joined(chunk, level, n, blocks, replies[n - 1]) for n, level in enumerate(levels, 1)]
    automaton = Automaton(chunk, levels, [f[0] for f in found], [f[1] for f in found])
    lead = chunk.order - 1
    begins, sizes = chunk.begins + lead, chunk.sizes - lead
    score = automaton.read(chunk.tokens, begins, sizes)
    counts = found[0][0][chunk.tokens]
    total = automaton.train_tokens
    base = np.log10((counts + 1) / (total + automaton.known + 1))
    known, base = np.where(chunk.read, counts > 0, 0), np.where(chunk.read, base, 0.0)
    of = chunk.begins
    return [chunk.row, chunk.key, chunk.held, sizes, np.add.reduceat(known, of), np.full(len(of), total), np.add.reduceat(base, of), score]


def _score(order: int, levels: list[Level], blocks: int):
    types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCORED.split(", ")]

    def flush(payload: bytes, replies: list[list[bytes]]) -> pa.RecordBatch:
        chunk = Chunk(payload, order)
        columns = score_chunk(chunk, levels, replies, blocks)
        arrays = [pa.array(c, t, mask=chunk.missing if n == "doc_id" else None) for c, t, n in zip(columns, types, names)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload, replies = None, []
        for batch in batches:
            for step, raw in zip(batch.column(1).to_pylist(), batch.column(3)):
                if step == 0:
                    if payload is not None:
                        yield flush(payload, replies)
                    payload, replies = raw.as_py(), [[] for _ in levels]
                else:
                    replies[step - 1].append(raw.as_py())
        if payload is not None:
            yield flush(payload, replies)

    return run


def scores(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, chunk: int = CHUNK, piece: int = PIECE
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from rows that are not ``held_out``; ``base_score`` is the text's log10 probability under
    single tokens with one added to every count.
    """
    texts = docs.select(F.col(key).cast("long"), F.coalesce(held_out, F.lit(False)), F.col(text).cast("string").cast("binary"))
    chunks = stage(texts.mapInArrow(_chunks(order, chunk, piece), CHUNKS), "lm-chunks")
    trained, tokens = chunks.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    blocks = max(BLOCKS, -(-tokens // BLOCK))
    opening = np.full(1, ROOT)
    hot, levels, parts = opening, [], []
    rows = chunks.select("chunk", F.lit(0).alias("step"), F.lit(0).cast("long").alias("block"), "payload")
    for n in range(1, order + 1):
        asked = chunks.select("chunk", "payload").mapInArrow(_ask(n, order, hot, blocks), ASKED)
        dealt = asked.repartition("block").sortWithinPartitions("block", "chunk")
        # Fewer than SHARE n-grams have that many tokens each.
        found = stage(dealt.mapInArrow(_answer(hot, max(trained / SHARE, 1)), ANSWERS), "lm-answers")
        totals = [F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(4)]
        small = found.where(F.col("kind") > ANSWER).groupBy("kind", "history").agg(*totals).collect()
        by_count = next((list(r[2:]) for r in small if r["kind"] == COUNTS), [0] * 4)
        levels.append(Level(hot, by_count, {r["history"]: tuple(r[2:]) for r in small if r["kind"] == SUMS}))
        often = np.array([r["history"] for r in small if r["kind"] == NEXT], dtype=np.int64).astype(np.uint64)
        opening = extended(opening, np.full(1, xxhash.xxh3_64_intdigest(START), dtype=np.uint64))
        hot = np.append(often, opening)
        rows = rows.union(found.where(F.col("kind") == ANSWER).select("chunk", F.lit(n), "block", "payload"))
        parts.append(found)
    together = rows.repartition("chunk").sortWithinPartitions("chunk", "step", "block")
    scored = together.mapInArrow(_score(order, levels, blocks), SCORED)
    out = stage(
        scored.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.first("train_tokens").alias("train_tokens"),
            F.sum("base_score").alias("base_score"),
            F.sum("score").alias("score"),
        ),
        "lm-scores",
    )
    drop_staged(chunks, *parts)
    return out.drop("row")
