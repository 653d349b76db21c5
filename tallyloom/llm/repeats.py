"""Suffix-array dedup: remove every byte covered by a long string that also starts earlier.

Texts are UTF-8 bytes; a match never crosses documents. "Earlier" is a smaller key, or the same document and
an earlier start; strings are judged on the input.

1. Each window of ``length`` bytes has an anchor, its least hashed ``ANCHOR`` bytes (the leftmost of equals):
   equal windows have equal anchors at equal places. Consecutive windows with one anchor are a segment,
   about one per 39 bytes, and only segments travel: anchor, digest of the segment, document, start, windows.
   A segment that a document holds before is a repeat already and travels as a bare span.
2. Segments meet by anchor. One that is alone is dropped. Of equal segments only the first stays; the others
   are repeats as a whole, so copies are gone before any text is shipped.
3. Where an anchor has several different segments, their bytes are fetched and dealt by anchor into shards of
   about ``SHARD`` bytes. Each shard gets a suffix array by induced sorting and its permuted common prefixes;
   suffixes that share ``length`` bytes form a class, and all its windows but the earliest are repeats.
   An anchor with more than ``CROWD`` different segments is not one shard's work: its windows are hashed
   singly and meet in step 2 again, where equal ones are found without bytes.
4. Spans are gathered per document and cut from the text.

Anchors are dealt by hash; a document adds one row per anchor, so an anchor that a third of all documents
share is a small part of all rows, and it is only counted and ordered by a window that spills.

Edge cases: null texts are empty; texts under ``length`` bytes are kept whole; repeated rows (same key and
text) are one document and get the same result; several texts under one key are different documents,
ordered by a hash; null keys come first; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import drop_staged, spare, stage
from .suffixes import common_prefixes, suffix_array

LENGTH = 100
ANCHOR = 24
SHARD = 1 << 20
CROWD = 1000
CHUNK = 1 << 20

SEGMENT = "anchor long, digest long, doc_id long, tie int, start long, windows int, inner boolean"


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Mixed 64-bit hashes of all ``width`` bytes strings of ``data``."""
    base, parts, power, size = 0x9E3779B97F4A7C15 | 1, [], data.astype(np.uint64) + np.uint64(1), 1
    step, done, total = base, 0, None
    with np.errstate(over="ignore"):
        while size <= width:
            if width & size:
                if total is None:
                    total = power
                else:
                    n = len(data) - done - size + 1
                    total = total[:n] + power[done : done + n] * np.uint64(pow(base, done, 1 << 64))
                done += size
            if 2 * size <= width:
                power = power[:-size] + power[size:] * np.uint64(step)
                step = step * step % (1 << 64)
            size *= 2
        total = total ^ (total >> np.uint64(31))
        total = total * np.uint64(0xD6E8FEB86659FD93)
        return total ^ (total >> np.uint64(29))


def segments(data: np.ndarray, length: int, width: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and anchor of each run of windows that share one anchor."""
    hashes = _hashes(data, width)
    span = length - width + 1
    least, size = hashes, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    change = np.flatnonzero((least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1])) + 1
    start = np.append(0, change)
    return start, np.diff(np.append(start, len(least))), least[start]


def _document_segments(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Segments of one text with their digests, long texts in pieces of ``CHUNK`` windows."""
    starts, counts, anchors = [], [], []
    for at in range(0, len(raw) - length + 1, CHUNK):
        s, c, a = segments(np.frombuffer(raw[at : at + CHUNK + length - 1], dtype=np.uint8), length)
        starts.append(s + at), counts.append(c), anchors.append(a)
    start, count, anchor = (np.concatenate(x) for x in (starts, counts, anchors))
    digest = xxhash.xxh3_64_intdigest
    ends = (start + count + length - 1).tolist()
    digests = np.array([digest(raw[a:b]) for a, b in zip(start.tolist(), ends)], dtype=np.uint64)
    inner = np.zeros(len(start), dtype=bool)
    order = np.lexsort((start, digests, anchor))
    same = (digests[order][1:] == digests[order][:-1]) & (anchor[order][1:] == anchor[order][:-1])
    inner[order[1:][same]] = True
    return start, count, anchor, digests, inner


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans merged; ``start`` ascending."""
    if len(start) == 0:
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def _segment_rows(length: int):
    types = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int32()),
                       ("start", pa.int64()), ("windows", pa.int32()), ("inner", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_of, parts = [], []
            for row, text in enumerate(batch.column(2)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if len(raw) < length:
                    continue
                start, count, anchor, digest, inner = _document_segments(raw, length)
                if inner.any():  # repeats inside the document: merged spans, dealt by a hash of their own
                    at, to = _joined(start[inner], (start + count)[inner])
                    spread = np.array([xxhash.xxh64_intdigest(raw[:64], int(x)) for x in at], dtype=np.uint64)
                    start, count = np.append(start[~inner], at), np.append(count[~inner], to - at)
                    anchor, digest = np.append(anchor[~inner], spread), np.append(digest[~inner], spread)
                    inner = np.arange(len(start)) >= len(start) - len(at)
                row_of.append(np.full(len(start), row))
                parts.append((anchor.view(np.int64), digest.view(np.int64), start, count.astype(np.int32), inner))
            if parts:
                anchor, digest, start, count, inner = (np.concatenate(x) for x in zip(*parts))
                rows = pa.array(np.concatenate(row_of))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(digest), batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(start), pa.array(count), pa.array(inner)], schema=types)

    return run


def _shared(rows: DataFrame) -> DataFrame:
    """Rows that repeat earlier ones (``first`` false), and first rows of anchors with several digests."""
    by_anchor, by_digest = Window.partitionBy("anchor"), Window.partitionBy("anchor", "digest").orderBy("doc_id", "tie", "start")
    place = F.struct("doc_id", "tie", "start")
    return (
        rows.withColumns(
            {"n": F.count(F.lit(1)).over(by_anchor), "least": F.min("digest").over(by_anchor), "most": F.max("digest").over(by_anchor)}
        )
        .where("inner or n > 1")
        .withColumn("first", ~F.col("inner") & F.first(place).over(by_digest).eqNullSafe(place))
        .where("not first or least <> most")
        .select("anchor", "doc_id", "tie", "start", "windows", "first")
    )


FETCHED = "anchor long, digest long, doc_id long, tie int, start long, windows int, inner boolean, piece binary"


def _fetch(length: int):
    """Bytes of wanted segments; of crowded anchors the single windows, hashed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for key, tie, text, wanted in zip(pdf["doc_id"], pdf["tie"], pdf["text"], pdf["wanted"]):
                raw = text.encode("utf-8", "surrogatepass")
                key = None if pd.isna(key) else int(key)
                for w in wanted:
                    start, windows = int(w["start"]), int(w["windows"])
                    if not w["crowded"]:
                        out.append((w["anchor"], 0, key, tie, start, windows, False, raw[start : start + windows + length - 1]))
                        continue
                    for at in range(start, start + windows):
                        h = xxhash.xxh3_128_digest(raw[at : at + length])
                        a, b = int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)
                        out.append((a, b, key, tie, at, 1, False, None))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FETCHED.split(", ")]).astype({"doc_id": "Int64"})

    return run


SPAN = "doc_id long, tie int, start long, stop long"


def shard_spans(parts: list[tuple], length: int) -> list[tuple]:
    """Spans of the windows in ``parts`` (doc_id, tie, start, bytes) that occur earlier among ``parts``."""
    parts = sorted(parts, key=lambda p: (p[0] is not None, p[0] or 0, p[1], p[2]))
    data = np.frombuffer(b"".join(p[3] for p in parts), dtype=np.uint8)
    sizes = np.array([len(p[3]) for p in parts])
    begins = np.append(0, np.cumsum(sizes)[:-1])
    within = np.arange(len(data)) - np.repeat(begins, sizes)
    window = within <= np.repeat(sizes, sizes) - length
    order = suffix_array(data)
    prefixes = common_prefixes(data, order, length)
    group = np.cumsum(prefixes[order] < length)
    keep = window[order]
    at, group = order[keep], group[keep]
    if len(at) == 0:
        return []
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    earliest = np.repeat(np.minimum.reduceat(at, edge), np.diff(np.append(edge, len(at))))
    repeats = np.sort(at[at > earliest])
    of = np.searchsorted(begins, repeats, side="right") - 1
    # Runs of repeats within one piece that touch are one span.
    cut = np.append(True, (of[1:] != of[:-1]) | (repeats[1:] > repeats[:-1] + length))[: len(repeats)]
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(repeats)) - 1
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        key, tie, start, _ = parts[of[a]]
        shift = start - int(begins[of[a]])
        out.append((key, tie, int(repeats[a]) + shift, int(repeats[b]) + shift + length))
    return out


def _shards(length: int, shard: int):
    """Anchors in order, gathered to about ``shard`` bytes, each set through one suffix array."""

    def flush(parts: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(shard_spans(parts, length), columns=["doc_id", "tie", "start", "stop"]).astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[tuple] = []
        size, last = 0, None
        for pdf in batches:
            for anchor, key, tie, start, piece in zip(pdf["anchor"], pdf["doc_id"], pdf["tie"], pdf["start"], pdf["piece"]):
                if anchor != last and size >= shard:
                    yield flush(parts)
                    parts, size = [], 0
                last = anchor
                parts.append((None if pd.isna(key) else int(key), tie, int(start), bytes(piece)))
                size += len(piece)
        if parts:
            yield flush(parts)

    return run


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """``doc_id, tie, spans`` for every document that has repeats; ``tie`` is the hash of its text."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.hash(text).alias("tie"), F.col(text).cast("string").alias("text"))
    hits = stage(_shared(texts.mapInArrow(_segment_rows(length), SEGMENT)), "repeats")
    firsts = hits.where("first").distinct()
    crowds = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("anchor", F.lit(True).alias("crowded"))
    wanted = (
        firsts.join(crowds, "anchor", "left")
        .withColumn("crowded", F.coalesce("crowded", F.lit(False)))
        .groupBy("doc_id", "tie")
        .agg(F.collect_list(F.struct("anchor", "start", "windows", "crowded")).alias("wanted"))
    )
    sources = texts.where(F.octet_length("text") >= length).alias("t")
    same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.tie") == F.col("w.tie"))
    fetched = sources.join(wanted.alias("w"), same).select("t.doc_id", "t.tie", "t.text", "w.wanted").mapInPandas(_fetch(length), FETCHED)
    fetched = stage(fetched, "repeat-bytes")
    pieces = fetched.where("piece is not null").dropDuplicates(["doc_id", "tie", "start"])
    sharded = (
        pieces.select("anchor", "doc_id", "tie", "start", "piece")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInPandas(_shards(length, shard), SPAN)
    )
    crowded = _shared(fetched.where("piece is null").drop("piece")).where("not first")
    whole = hits.where("not first")
    spans = sharded
    for part in (whole, crowded):
        spans = spans.union(part.select("doc_id", "tie", "start", (F.col("start") + F.col("windows") + F.lit(length - 1)).alias("stop")))
    out = stage(spans.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "repeat-spans")
    drop_staged(hits, fetched)
    return out


def _cut(names: list[str], text: str, spans_name: str, cut_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            texts, sizes, removed, runs, digests = [], [], [], [], []
            spans = batch.column(at[spans_name])
            for i, value in enumerate(batch.column(at[text])):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                kept, n, lost = raw, 0, 0
                if spans[i].is_valid:
                    inner = spans[i].values
                    start, stop = (inner.field(f).to_numpy() for f in ("start", "stop"))
                    order = np.argsort(start, kind="stable")
                    start, stop = _joined(start[order], stop[order])
                    edges = np.append(0, np.column_stack((start, stop)).ravel()).tolist() + [len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    n, lost = len(start), int((stop - start).sum())
                sizes.append(len(raw)), removed.append(lost), runs.append(n), digests.append(hashlib.sha256(kept).hexdigest())
                if cut_text:
                    texts.append(kept.decode("utf-8", "ignore") if lost else value.as_py())
            columns = [pa.array(texts, pa.string()) if cut_text and c == text else batch.column(at[c]) for c in names]
            columns += [pa.array(x, pa.int64()) for x in (sizes, removed, runs)] + [pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: list[str] | None = None, cut_text: bool = True
) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_bytes, n_removed, n_spans, kept_sha256`` of each row.

    ``cut_text`` replaces the text by what is left; where a cut splits a character, its remaining bytes go too.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    names = [c for c in (keep or docs.columns) if c not in added]
    own_id, own_tie, spans = spare(docs, "_id", "_tie", "_spans")
    found = repeated_spans(docs, key, text, length).toDF(own_id, own_tie, spans)
    same = F.col(key).cast("long").eqNullSafe(F.col(own_id)) & (F.hash(text) == F.col(own_tie))
    joined = docs.select(*dict.fromkeys([*names, key, text])).join(found, same, "left").select(*dict.fromkeys([*names, text]), spans)
    schema = T.StructType([docs.schema[c] for c in names])
    for c in added[:3]:
        schema = schema.add(c, "long")
    return joined.mapInArrow(_cut(names, text, spans, cut_text), schema.add(added[3], "string"))
