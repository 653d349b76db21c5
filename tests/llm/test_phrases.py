"""Phrase mining against counts by plain loops, and the quotient filter against a dictionary."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import collocations
from tallyloom.llm.quotient import Filter, Permutation, filters, merged

SCHEMA = "text string, lang string"


def plain(rows, least=10, inside=50, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            longer = [g for g, n in f.items() if len(g) > len(p) and n >= least and 100 * n >= inside * a]
            if any(g[i : i + len(p)] == p for g in longer for i in range(len(g) - len(p) + 1)):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -s))
    return sorted(out)


def random_rows(seed, n=120):
    rng = np.random.default_rng(seed)
    words = np.array(["the", "The", "of", "é", "ÉÉ", "日本", "x\x1cy", "new", "york", "city", *[f"w{i}" for i in range(12)]])
    share = 1 / np.arange(1, len(words) + 1)
    seams = [" ", " ", " ", "\t", "  ", ". ", "\n", "!?", "\x0b"]
    rows = []
    for _ in range(n):
        chosen = rng.choice(words, size=int(rng.integers(0, 50)), p=share / share.sum())
        rows.append(("".join(w + seams[int(rng.integers(len(seams)))] for w in chosen), [None, "en", "und", "de"][int(rng.integers(4))]))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("one two three " * 30, "fr"), rows[0], ("a a a a " * 20, "fr"), ("z" * 5000 + " zz", "fr")]


@pytest.mark.parametrize("chunk, slices, top", [(1 << 21, 1 << 20, 2000), (7, 40, 2000), (60, 100, 5)])
def test_phrases_are_those_of_plain_counts(spark, monkeypatch, chunk, slices, top):
    monkeypatch.setattr(collocations, "SLICE", slices)
    rows = random_rows(chunk)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs, chunk=chunk, top=top).collect()))
    assert got == plain(rows, top=top) and len(got) > 10


def test_clashing_columns_and_empty_tables(spark):
    rows = [("new york city hall. " * 12, "en", "x", "y", "z")]
    docs = spark.createDataFrame(rows, "text string, lang string, word string, chunk string, a string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == plain([r[:2] for r in rows])
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("one two", "en")], SCHEMA)).collect() == []


@pytest.mark.parametrize("bits", [16, 17, 21, 22, 31, 32])
def test_permutation_is_undone(bits):
    rng = np.random.default_rng(bits)
    most = (1 << bits) - 1
    words = [np.append(rng.integers(0, most, 500, dtype=np.uint64), [0, most]).astype(np.uint64) for _ in range(3)]
    permutation = Permutation(bits)
    back = permutation.words(*permutation.packed(*words))
    assert all((b == w.astype(np.int64)).all() for b, w in zip(back, words))
    upper, lower = permutation.packed(*words)
    assert int(upper.max()) <= most and int(lower.max()) <= (1 << 2 * bits) - 1


@pytest.mark.parametrize("bits, block_bits", [(16, 2), (16, 16), (21, 9), (32, 3)])
def test_filters_count_without_loss_and_merge(bits, block_bits):
    rng = np.random.default_rng(7)
    permutation = Permutation(bits)
    truth, shards = Counter(), []
    for _ in range(4):
        words = rng.integers(1, 9, (3, 400)).astype(np.uint64)
        words[0, ::2] = 0
        truth.update(zip(*words.tolist()))
        shards += filters(*permutation.packed(*words), bits, block_bits)
    by_block = defaultdict(list)
    for f in shards:
        by_block[f.block].append(Filter.load(f.dump()))
    found = Counter()
    for parts in by_block.values():
        one = merged(parts)
        upper, lower, count = one.entries()
        assert (np.diff(upper.astype(np.int64)) >= 0).all()
        for *word, n in zip(*permutation.words(upper, lower), count):
            found[tuple(int(w) for w in word)] += int(n)
        for u, v, n in zip(upper[:20], lower[:20], count[:20]):
            assert one.find(int(u), int(v)) == n
            assert one.find(int(u), int(v) ^ 1) in (0, *count)
    assert found == truth
    missing = permutation.packed(*(np.array([x], dtype=np.uint64) for x in (9, 9, 9)))
    assert all(f.find(int(missing[0][0]), int(missing[1][0])) == 0 for parts in by_block.values() for f in parts)
