import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import repeats, suffixes


def brute(docs, length):
    """(n_bytes, n_removed, n_spans, kept) for (order, text) pairs; equal pairs are one document."""
    seen, out = set(), {}
    for key, text in sorted(set(docs), key=lambda d: (d[0], d[1] or "")):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key, text] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def test_suffix_arrays_of_random_texts():
    rng = np.random.default_rng(1)
    for trial in range(300):
        data = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60)).astype(np.uint8)
        if trial % 4 == 0:
            data = np.tile(data, 3)
        raw = bytes(data)
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        for size in (256, suffixes.FEW_CODES + 1):  # whole buckets, and one suffix at a time
            order = suffixes.suffix_array(data, size)
            assert order.tolist() == want
        prefixes = suffixes.common_prefixes(data, order, 9)
        for a, b in zip(want, want[1:]):
            n = 0
            while n < 9 and b + n < len(raw) and a + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert prefixes[b] == n


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    raw = bytes(rng.choice(b"ab ") for _ in range(900))
    raw += raw[100:400]
    anchor_of = {}
    start, count, anchor = repeats.segments(np.frombuffer(raw, np.uint8), 40, 12)
    assert count.sum() == len(raw) - 40 + 1
    for s, c, a in zip(start, count, anchor):
        for i in range(s, s + c):
            assert anchor_of.setdefault(raw[i : i + 40], a) == a


@pytest.mark.parametrize("crowd", [1000, 1])
def test_operator_equals_brute_force(spark, tricky, crowd, monkeypatch):
    """Both ways of comparing: shards of bytes, and single windows of crowded anchors."""
    spans = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, k, t, n: spans(d, k, t, n, shard=2000, crowd=crowd))
    docs = spark.createDataFrame([(r[0], r[1]) for r in tricky], "doc_id long, text string")
    want = brute([(r[0], r[1]) for r in tricky], 100)
    got = repeats.without_repeats(docs).collect()
    assert len(got) == len(tricky)
    texts = dict((r[0], r[1]) for r in tricky)
    for r in got:
        n, removed, runs, kept = want[r.doc_id, texts[r.doc_id]]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, removed, runs), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert (r.text or "") == kept.decode("utf-8", "ignore")


def test_random_documents_with_short_strings(spark):
    rng = random.Random(4)
    parts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 8)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 40)
    for r in repeats.without_repeats(docs, length=40).join(docs.withColumnRenamed("text", "source_text"), "doc_id").collect():
        n, removed, runs, kept = want[r.doc_id, r.source_text]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, runs, hashlib.sha256(kept).hexdigest())


def test_long_texts_in_pieces(spark, letters, monkeypatch):
    """Pieces of a long text cut segments elsewhere; the result is the same."""
    text = letters(400, 9)
    rows = [(0, text), (1, letters(50, 10) + text[300:1500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = []
    for chunk in (repeats.CHUNK, 500):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        start, count, anchor, digest, inner = repeats._document_segments(text.encode(), 100)
        assert count.sum() == len(text) - 99 and not inner.any()
        kept.append(sorted(map(tuple, repeats.without_repeats(docs).collect())))
    assert kept[0] == kept[1]


def test_empty_table_and_clashing_columns(no_documents, crowded_columns, documents):
    assert repeats.without_repeats(no_documents).count() == 0
    got = repeats.without_repeats(crowded_columns)
    assert set(crowded_columns.columns) - {"n_bytes"} <= set(got.columns)
    same = ["doc_id", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.select(same).collect())) == sorted(map(tuple, repeats.without_repeats(documents).select(same).collect()))
    null_keys = documents.limit(6).selectExpr("cast(null as long) as doc_id", "text")
    assert repeats.without_repeats(null_keys).count() == 6
