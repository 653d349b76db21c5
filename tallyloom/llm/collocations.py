"""Phrase collocations per language, counted in quotient filters that merge across shards.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and into words at spaces and tabs.
Candidates are phrases of two or three words that occur often enough; a candidate's score is the least over its
cuts of ``1000000 * a * a / (l * r)``, rounded down, with the occurrences of the phrase and of both parts; phrases
that mostly occur inside a longer candidate are dropped; the best of each language are returned.

1. Tasks read texts into chunks of at most ``CHUNK`` words: numbers of the chunk's own vocabulary, and one row
   per different word of the chunk. Chunks are staged.
2. Words that occur often enough themselves get numbers of their own (a word of a language is a word of its
   own). No phrase with another word can be a candidate, so nothing else needs one.
3. Each chunk meets the numbers of its words and builds counting quotient filters of its two- and three-word
   phrases (``quotient.py``), one for each block of the permuted key. Blocks hold about ``BLOCK`` occurrences,
   however frequent a word or a language is. A block's filters are merged, and the n-grams with enough
   occurrences are read back from it.
4. The rest is joins over these n-grams in long form. Candidates are ranked by range partitions of the whole
   order, so no language is one task's work.

Scores are exact: products are decimals of 38 digits, enough for 10^15 occurrences.

Edge cases: null texts are empty; a null language is ``und``; words that are not valid UTF-8 are shown with
replacement characters but told apart by their bytes; repeated rows count as rows of their own; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .backoff import Numbers
from .blobs import pack, unpack
from .quotient import LEAST_BITS, MOST_BITS, Filter, Permutation, filters, merged
from .staging import drop_staged, numbered, stage

CHUNK = 1 << 20
BLOCK = 1 << 19
BLOCK_BITS = 9
SLICE = 1 << 20
UNKNOWN_LANGUAGE = "und"

SEAM = b"."
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_MAP = bytes.maketrans(_SEPARATORS + b"\t", SEAM * len(_SEPARATORS) + b" ").translate(bytes(range(256)).lower())


def pieces_of(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text with ``SEAM`` between pieces, one ``SLICE`` of text at a time."""
    at = 0
    while at < len(raw):
        to = len(raw)
        if at + SLICE < to:
            found = raw.find(b" ", at + SLICE)
            to = to if found < 0 else found + 1
        yield raw[at:to].translate(_MAP).replace(SEAM, b" . ").split()
        at = to


CHUNKS = "chunk long, local int, lang string, word binary, n long, payload binary"


def _chunks(chunk_size: int):
    schema = pa.schema([("chunk", pa.int64()), ("local", pa.int32()), ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 33, 0
        tokens: list[np.ndarray] = []
        size = lead = 0
        known: dict[str, _OfLanguage] = {}
        number = Numbers({SEAM: 0})

        def done() -> pa.RecordBatch:
            """The rows of the chunk; up to two words that a phrase may go on from open the next one."""
            nonlocal made, size, lead, tokens, known, number
            read = np.concatenate(tokens)
            count = np.bincount(read[lead:], minlength=len(number))
            rank = np.argsort(-count[1:], kind="stable") + 1  # 0 stays the seam; frequent words get small numbers
            new = np.zeros(len(number), dtype=np.uint32)
            new[rank] = np.arange(1, len(rank) + 1, dtype=np.uint32)
            names = list(number)
            words, n = [names[i] for i in rank.tolist()], len(rank)
            columns = [
                pa.array(np.append(np.arange(1, n + 1), 0), pa.int32()),
                pa.array([w[0] for w in words] + [None], pa.string()),
                pa.array([w[1] for w in words] + [None], pa.binary()),
                pa.array(np.append(count[rank], 0), pa.int64()),
                pa.array([None] * n + [pack(new[read], np.array([lead]))], pa.binary()),
            ]
            out = pa.RecordBatch.from_arrays([pa.array(np.full(n + 1, task + made)), *columns], schema=schema)
            open_ = [names[i] for i in read[-2:].tolist()]
            open_ = open_[len(open_) - open_[::-1].index(SEAM) :] if SEAM in open_ else open_
            made, size, lead, known, number = made + 1, 0, len(open_), {}, Numbers({SEAM: 0})
            tokens = [np.array([of(lang)[word] for lang, word in open_], dtype=np.uint32)]
            return out

        def of(lang: str) -> _OfLanguage:
            if lang not in known:
                known[lang] = _OfLanguage(lang, number)
            return known[lang]

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in pieces_of(raw.as_py() or b""):
                    for at in range(0, len(words), chunk_size):
                        part = words[at : at + chunk_size]
                        if size and size + len(part) > chunk_size:
                            yield done()
                        tokens.append(np.fromiter(map(of(lang).__getitem__, part), dtype=np.uint32, count=len(part)))
                        size += len(part)
                tokens.append(np.zeros(1, dtype=np.uint32))
        if size:
            yield done()

    return run


class _OfLanguage(dict):
    """Numbers of one language's words, from the chunk's common count."""

    def __init__(self, lang: str, number: Numbers):
        super().__init__({SEAM: 0})
        self.lang, self.number = lang, number

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.number[self.lang, word]
        return n


FILTERS = "block long, payload binary"


def phrase_filters(tokens: np.ndarray, lead: int, bits: int, block_bits: int) -> list[Filter]:
    """Filters of all phrases of two and three numbered words (0 is none); the first ``lead`` words only open phrases."""
    permutation = Permutation(bits)
    known = tokens > 0
    two = np.flatnonzero(known[:-1] & known[1:])
    two = two[two + 1 >= lead]
    three = two[: len(two)][known[np.minimum(two + 2, len(tokens) - 1)] & (two + 2 < len(tokens))]
    if lead:  # a phrase of three may start with two words that are no phrase of this chunk
        opening = np.arange(0, min(lead, len(tokens) - 2))
        opening = opening[known[opening] & known[opening + 1] & known[opening + 2]]
        three = np.union1d(three, opening)
    none = np.zeros(len(two), dtype=np.uint64)
    pairs = permutation.packed(none, tokens[two], tokens[two + 1])
    triples = permutation.packed(tokens[three], tokens[three + 1], tokens[three + 2])
    return filters(np.concatenate([pairs[0], triples[0]]), np.concatenate([pairs[1], triples[1]]), bits, block_bits)


def _count(bits: int, block_bits: int):
    def flush(payload: bytes, local: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        tokens, lead = unpack(payload)
        number = np.zeros(int(tokens.max()) + 1, dtype=np.uint64)
        number[np.concatenate(local)] = np.concatenate(ids)
        found = phrase_filters(number[tokens], int(lead[0]), bits, block_bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([f.block for f in found], pa.int64()), pa.array([f.dump() for f in found], pa.binary())], names=["block", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, payload = None, None
        local, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for batch in batches:
            chunk, place, number = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])).tolist()
            for a, b in zip(edges, [*edges[1:], len(chunk)]):
                if chunk[a] != last:
                    if payload is not None:
                        yield flush(payload, local, ids)
                    last, payload, local, ids = chunk[a], batch.column(3)[a].as_py(), [], []
                local.append(place[a:b]), ids.append(number[a:b])
        if payload is not None:
            yield flush(payload, local, ids)

    return run


GRAMS = "w1 long, w2 long, w3 long, a long"


def _merge(bits: int, least: int):
    def flush(parts: list[Filter]) -> pa.RecordBatch:
        upper, lower, count = merged(parts).entries()
        often = count >= least
        columns = [*Permutation(bits).words(upper[often], lower[often]), count[often]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["w1", "w2", "w3", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Filter] = []
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if parts and parts[-1].block != block:
                    yield flush(parts)
                    parts = []
                parts.append(Filter.load(payload.as_py()))
        if parts:
            yield flush(parts)

    return run


def _score(l: str, r: str) -> Column:  # noqa: E741
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"cast((cast(1000000 as decimal(38,0)) * {wide('a')} * {wide('a')}) div ({wide(l)} * {wide(r)}) as long)")


def scored(grams: DataFrame, words: DataFrame, inside: int) -> DataFrame:
    """``lang, phrase`` (bytes)``, a, l, r, score`` of the candidates that are in no longer one."""
    space = F.lit(b" ")
    first = words.select(F.col("id").alias("w2"), "lang", F.col("word").alias("word1"), F.col("f").alias("f1"))
    second = words.select(F.col("id").alias("w3"), F.col("word").alias("word2"), F.col("f").alias("f2"))
    two = stage(grams.where("w1 = 0").drop("w1").join(first, "w2").join(second, "w3"), "phrase-pairs")
    three = grams.where("w1 > 0")

    longer = three.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    longer = longer.groupBy(F.col("p.w1").alias("w2"), F.col("p.w2").alias("w3")).agg(F.max("a").alias("over"))
    short = two.join(longer, ["w2", "w3"], "left").where(F.col("over").isNull() | (100 * F.col("over") < inside * F.col("a")))
    short = short.select("lang", F.concat("word1", space, "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("f1", "f2").alias("score"))

    head = two.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "lang", "word1", F.col("word2"), F.col("f1").alias("l1"), F.col("a").alias("l2"))
    tail = two.select("w2", "w3", F.col("word2").alias("word3"), F.col("a").alias("r1"), F.col("f2").alias("r2"))
    long_ = three.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    cut = lambda x: F.when(F.col("s1") <= F.col("s2"), F.col(f"{x}1")).otherwise(F.col(f"{x}2"))
    long_ = long_.select(
        "lang", F.concat("word1", space, "word2", space, "word3").alias("phrase"), "a",
        cut("l").alias("l"), cut("r").alias("r"), F.least("s1", "s2").alias("score"),
    )
    return short.union(long_)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, inside: int = 50, top: int = 2000, chunk: int = CHUNK) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` best phrases of each language.

    ``least`` occurrences make a candidate; one is dropped where a longer candidate has ``inside`` percent of its
    occurrences.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE)), F.col(text).cast("string").cast("binary"))
    chunks = stage(texts.mapInArrow(_chunks(chunk), CHUNKS), "phrase-chunks")
    seen = chunks.where("local > 0")
    words = stage(seen.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = numbered(words.where(F.col("f") >= least), F.col("lang"), F.col("word"), name="id", label="phrase-numbers")
    often = stage(often.withColumn("id", F.col("id") + 1), "phrase-dictionary")
    total, most = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0], often.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    bits = max(LEAST_BITS, int(most).bit_length())
    if bits > MOST_BITS:
        raise ValueError(f"more than {1 << MOST_BITS} words occur {least} times")
    block_bits = min(bits, max(BLOCK_BITS, int(2 * total // BLOCK).bit_length()))

    given = seen.select("chunk", "local", "lang", "word").join(often, ["lang", "word"]).select("chunk", "local", "id", F.lit(None).cast("binary").alias("payload"))
    whole = chunks.where("local = 0").select("chunk", "local", F.lit(0).cast("long").alias("id"), "payload")
    together = whole.union(given).repartition("chunk").sortWithinPartitions("chunk", "local")
    dealt = together.mapInArrow(_count(bits, block_bits), FILTERS).repartition("block").sortWithinPartitions("block")
    grams = stage(dealt.mapInArrow(_merge(bits, least), GRAMS), "phrase-grams")

    found = stage(scored(grams, often, inside), "phrase-scores")
    best = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    placed = stage(numbered(found, *best, name="place", label="phrase-places"), "phrase-ranks")
    # One row per language, written: its size is known when the join is planned, so ranked rows are not dealt by language.
    firsts = stage(placed.groupBy("lang").agg(F.min("place").alias("first")).join(sizes, "lang"), "phrase-firsts")
    ranked = placed.join(firsts, "lang").withColumn("rank", F.col("place") - F.col("first") + 1).where(F.col("rank") <= top)
    out = ranked.select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
    out = stage(out, "phrases")
    drop_staged(chunks, grams, found, placed, firsts)
    return out
