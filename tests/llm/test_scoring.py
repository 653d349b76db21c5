"""Language-model scores against a model counted and smoothed by plain loops."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import backoff
from tallyloom.llm.blobs import pack, steps, unpack

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def apart():
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 2


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), "\n"]


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


class Plain:
    """Modified absolute discounting, one probability at a time."""

    def __init__(self, texts, order):
        self.order = order
        self.count = [Counter() for _ in range(order + 1)]
        for words in texts:
            read = [" "] * (order - 1) + words
            for i in range(order - 1, len(read)):
                for n in range(1, order + 1):
                    self.count[n][tuple(read[i - n + 1 : i + 1])] += 1
        self.known = {w for (w,) in self.count[1]}
        self.total = sum(self.count[1].values())
        self.discount, self.after = [None], [None]
        for n in range(1, order + 1):
            of = Counter(self.count[n].values())
            part = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
            cuts = [i - (i + 1) * part * of[i + 1] / of[i] if of[i] else i * part for i in (1, 2, 3)]
            self.discount.append([min(max(d, 0.05), i - 0.05) for i, d in enumerate(cuts, 1)])
            after = defaultdict(list)
            for gram, c in self.count[n].items():
                after[gram[:-1]].append(c)
            cut = lambda c, n=n: self.discount[n][min(c, 3) - 1]
            self.after.append({h: (sum(counts), sum(map(cut, counts))) for h, counts in after.items()})

    def probability(self, history, word):
        n = len(history) + 1
        below = self.probability(history[1:], word) if history else 1 / (len(self.known) + 1)
        if history not in self.after[n]:
            return below
        total, lost = self.after[n][history]
        own = self.count[n][(*history, word)]
        return ((own - self.discount[n][min(own, 3) - 1]) if own else 0) / total + lost / total * below

    def score(self, words):
        read = [" "] * (self.order - 1) + words
        at = range(self.order - 1, len(read))
        return sum(math.log10(self.probability(tuple(read[i - self.order + 1 : i]), read[i])) for i in at)


def expected(rows, order):
    texts = [(key, is_held(key), tokens_of(text)) for key, text in rows]
    model = Plain([t for _, held, t in texts if not held], order)
    out = []
    for key, held, words in texts:
        base = sum(math.log10((model.count[1][(w,)] + 1) / (model.total + len(model.known) + 1)) for w in words)
        out.append((key, held, len(words), sum((w,) in model.count[1] for w in words), model.total, base, model.score(words)))
    return out, model


def random_rows(seed, n):
    rng = np.random.default_rng(seed)
    words = np.array(["the", "THE", "of", "é", "É", "x\x1cy", "a.b", " ", "<s>", *[f"w{i}" for i in range(40)]])
    share = 1 / np.arange(1, len(words) + 1)
    seams = [" ", "\t", "\n", "  ", "\r\n", "\x0b"]
    rows = []
    for key in range(n):
        chosen = rng.choice(words, size=int(rng.integers(0, 60)), p=share / share.sum())
        rows.append((key, "".join(w + seams[int(rng.integers(len(seams)))] for w in chosen)))
    rows += [(n, None), (n + 1, ""), (n + 2, "   "), (None, "the of w1"), (3, rows[3][1]), (5, "the the the of the " * 400), (n + 3, "z" * 3000)]
    return rows


def same(found, wanted):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    found, wanted = sorted(map(tuple, found), key=order), sorted(wanted, key=order)
    assert [r[:5] for r in found] == [tuple(r[:5]) for r in wanted]
    for f, w in zip(found, wanted):
        assert f[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and f[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order, chunk, piece, share", [(2, 1 << 22, 2048, 1024), (2, 300, 7, 20), (3, 200, 11, 8), (1, 500, 50, 1024), (3, 1 << 22, 2048, 1024)])
def test_scores_are_those_of_the_plain_model(spark, monkeypatch, order, chunk, piece, share):
    monkeypatch.setattr(backoff, "SHARE", share)
    monkeypatch.setattr(backoff, "BLOCKS", 5)
    rows = random_rows(order, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted, model = expected(rows, order)
    same(backoff.scores(docs, apart(), order=order, chunk=chunk, piece=piece).collect(), wanted)
    some = [(), ("the",), ("the", "of"), (" ", " "), ("w1", "the")]
    for history in some:
        if len(history) < order:
            sums = sum(model.probability(history, w) for w in [*model.known, "never seen"])
            assert sums == pytest.approx(1)


def test_model_beats_single_tokens_on_held_out_texts(spark):
    from tallyloom.llm.queries import QUERIES

    found = QUERIES["op11_lm_scoring"](spark, SMALL).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_query_on_the_table(spark):
    from tallyloom.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    wanted, _ = expected(rows, backoff.ORDER)
    same(QUERIES["op11_lm_scoring"](spark, SMALL).collect(), wanted)


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    held = [k for k in range(40) if is_held(k)]
    docs = spark.createDataFrame([(k, "a b", "x") for k in held], "doc_id long, text string, score string")
    assert {tuple(r)[2:] for r in backoff.scores(docs, apart()).collect()} == {(3, 0, 0, 0.0, 0.0)}
    assert backoff.scores(docs.limit(0), apart()).collect() == []


def test_arrays_come_back():
    arrays = [np.array([3, 5, 5, 2**63], dtype=np.uint64), np.zeros(0, dtype=np.int32), np.array([True, False]), np.array([1.5, -2.0])]
    back = unpack(pack(*arrays))
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, back, strict=True))
    assert (np.cumsum(steps(arrays[0]), dtype=np.uint64) == arrays[0]).all()
