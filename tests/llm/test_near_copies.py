import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import simhash
from tallyloom.llm.components import components


def brute_bits(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(bits, most=4):
    """Least key reachable, for a list of (key, bits)."""
    least = {k: k for k, _ in bits}
    changed = True
    while changed:
        changed = False
        for a, x in bits:
            for b, y in bits:
                if bin(x ^ y).count("1") <= most and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def unsigned(value):
    return value % (1 << 64)


def test_fingerprints_of_tricky_texts(tricky):
    for _, text, *_ in tricky:
        assert simhash.fingerprint(text) == brute_bits(text)


def test_operator_on_tricky_documents(documents, crowded_columns, tricky):
    want = brute_components([(r[0], brute_bits(r[1])) for r in tricky])
    for docs in (documents, crowded_columns):
        got = simhash.near_duplicates(docs).collect()
        assert sorted((r.doc_id, unsigned(r.bits), r.component_id) for r in got) == sorted((r[0], brute_bits(r[1]), want[r[0]]) for r in tricky)


def test_empty_table_and_null_key(spark, no_documents):
    assert simhash.near_duplicates(no_documents).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "other words here now"), (7, "a b c d e")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}


@pytest.mark.parametrize("blocks", [6, 8])
def test_links_of_crowds_and_chains(spark, blocks):
    """Random fingerprints, a crowd around one of them, and a chain whose ends are far apart."""
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(200)]
    center = values[0]
    for _ in range(150):
        values.append(center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))))
    step = values[1]
    for _ in range(12):
        step ^= sum(1 << b for b in rng.sample(range(64), 4))
        values.append(step)
    values = sorted(set(values))
    want = brute_components(list(enumerate(values)))
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "bits long")
    roots = {unsigned(r.bits): r.root for r in simhash.links(table, 4, blocks).collect()}
    groups, mine = {}, {}
    for i, v in enumerate(values):
        groups.setdefault(want[i], set()).add(v)
        mine.setdefault(roots.get(v, ("alone", v)), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_pivots_discard_only_what_cannot_link(spark):
    """The packed distance tables let every pair within the distance pass, and far pairs rarely."""
    rng = random.Random(5)
    pairs = []
    for i in range(400):
        a = rng.getrandbits(63)
        near = i % 2 == 0
        b = a ^ sum(1 << x for x in rng.sample(range(63), 4)) if near else rng.getrandbits(63)
        pairs.append((a, b, near))
    df = spark.createDataFrame(pairs, "a long, b long, near boolean")
    sides = [simhash._pack([simhash.distance(F.col(c), F.lit(simhash._signed(simhash.pivot(i)))) for i in range(simhash.PIVOTS)]) for c in "ab"]
    passed = F.lit(True)
    for x, y in zip(*sides):
        passed &= simhash._within(x, y, 4)
    counts = {(r["near"], r["passed"]): r["count"] for r in df.withColumn("passed", passed).groupBy("near", "passed").count().collect()}
    assert counts.get((True, False), 0) == 0
    assert counts.get((False, True), 0) < 10


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((30, 20), (60, 80), (2, 1), (5, 0)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 140)]
        got = {r.a: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "test").collect()}
        root = {v: v for e in edges for v in e}
        for _ in root:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        alone = {v for v in root if all(a == b for a, b in edges if v in (a, b))}
        assert got == {v: r for v, r in root.items() if v not in alone}
