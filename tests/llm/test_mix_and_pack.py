import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, packing
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.staging import spare, word_count


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Water-filling by the rule: cap what is above, reshare the rest by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        rest = goal - sum(most * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in sizes if s not in capped)
        level = rest / open_ if open_ else 0.0
        above = {s for s in sizes if s not in capped and weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in sizes}
        capped |= above


def mixed_rows(docs):
    (size,) = spare(docs, "words_of_row")
    return mixing.mix(docs.withColumn(size, word_count(F.col("text"))), size=size), size


def test_mix_of_tricky_documents(documents, crowded_columns, tricky):
    sizes = defaultdict(int)
    for _, text, _, source, _ in tricky:
        sizes[source] += len((text or "").encode().split())
    want = targets(sizes)
    for docs in (documents, crowded_columns):
        out, size = mixed_rows(docs)
        rows = out.collect()
        assert len(rows) == len(tricky)
        for r in rows:
            assert r[size] == len((r.text or "").encode().split())
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
            assert r.taken == r.copies * r[size] <= 2 * r[size]


def test_taken_words_come_near_targets_and_repeat(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), None if i % 9 == 0 else f"s{i % 4 if i % 3 else 0}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out, size = mixed_rows(docs)
    by = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(size).alias("largest")).collect()
    for r in by:
        assert abs(r.taken - r.target) <= 2 * r.largest
    again, _ = mixed_rows(docs.repartition(7))
    pick = ["doc_id", "taken"]
    assert sorted(map(tuple, out.select(pick).collect())) == sorted(map(tuple, again.select(pick).collect()))
    assert mixing.repeated(out).groupBy().agg(F.sum(size)).first()[0] == sum(r.taken for r in by)


def test_fill_goes_on_behind_a_long_document(spark):
    """One document of 600 words among short ones: the words wanted are found wherever it stands."""
    for seed in range(6):
        rows = [(0, "a", 600)] + [(i, "a", 1 + i % 3) for i in range(1, 201)] + [(1000 + i, "b", 50) for i in range(40)]
        docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
        out = mixing.mix(docs, seed=seed, share=1.2, weights=(5, 7)).collect()
        for name in "ab":
            mine = [r for r in out if r.source == name]
            left_out = [r["size"] for r in mine if r.copies == min(x.copies for x in mine)]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= min(left_out) + 1
            assert all(r.taken <= 2 * r["size"] for r in mine)


def test_nothing_is_wanted_beyond_whole_repetitions(spark):
    docs = spark.createDataFrame([(i, "a", 3) for i in range(50)], "doc_id long, source string, size long")
    assert {r.copies for r in mixing.mix(docs, share=2.0).collect()} == {2}
    assert {r.copies for r in mixing.mix(docs, share=1.0).collect()} == {1}


def test_water_filling_in_many_rounds(spark):
    sizes = {f"s{i:02}": 3**i for i in range(10)} | {None: 5, "": 0}
    docs = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(docs, "size", "source", (5, 2, 1), 1.5, 2.0).collect()}
    want = targets(sizes)
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_of_nothing(no_documents, documents):
    assert mixed_rows(no_documents)[0].count() == 0
    blank = documents.withColumn("text", F.lit(None).cast("string"))
    assert {(r.taken, r.target) for r in mixed_rows(blank)[0].collect()} == {(0, 0.0)}


def check_plan(counts):
    used, sequences = Counter(), 0
    for shape, times in packing.plan(counts):
        assert 0 < sum(shape) <= packing.LIMIT and times > 0
        for length in shape:
            used[length] += times
        sequences += times
    assert used == Counter({i: int(n) for i, n in enumerate(counts) if n})
    return sequences


@pytest.mark.parametrize("n", [0, 1, 7, 300, 20_000])
def test_plans_use_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(5.5, 1.0, n).astype(int), 1, packing.LIMIT)
    counts = np.bincount(lengths, minlength=packing.LIMIT + 1)
    sequences = check_plan(counts)
    least = -(-int(lengths.sum()) // packing.LIMIT)
    assert least <= sequences <= 1.02 * least + 3


def test_exact_complements_of_one_two_and_three():
    def counts(*lengths):
        return np.bincount(lengths, minlength=packing.LIMIT + 1)

    assert check_plan(counts(700, 324)) == 1
    assert check_plan(counts(700, 200, 124)) == 1
    assert check_plan(counts(700, 200, 100, 24)) == 1
    assert check_plan(counts(512, 512, 512)) == 2
    assert check_plan(counts(600, 600, 424, 424, 1024)) == 3


def packed_rows(docs):
    rows = packing.pack(docs, tokenizer_path()).collect()
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for spans in inside.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.LIMIT
    return rows


def test_pack_of_tricky_documents(documents, crowded_columns, tricky):
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(tokenizer_path())
    file.encode_special_tokens = True
    want = []
    for key, text, *_ in tricky:
        ids = file.encode(text or "", add_special_tokens=False).ids + [packing.END]
        first = len(ids) if len(ids) <= packing.LIMIT else len(ids) % packing.LIMIT or packing.LIMIT
        edges = [0, *range(first, len(ids) + 1, packing.LIMIT)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((key, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    for docs in (documents, crowded_columns):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed_rows(docs)) == sorted(want)


@pytest.mark.parametrize("mark", [" ", "\n"])
def test_long_white_space_has_the_ids_of_the_files_own_library(spark, mark):
    from tokenizers import Tokenizer

    texts = ["a" + mark * 1_000_000 + "b", mark * 3_000_000]
    ids = [Tokenizer.from_file(tokenizer_path()).encode(t, add_special_tokens=False).ids for t in texts]
    assert [packing.token_ids(tokenizer_path(), t) for t in texts] == ids
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    total = Counter()
    for r in packing.pack(docs, tokenizer_path()).collect():
        total[r.doc_id] += r.length
    assert total == {i: len(x) + 1 for i, x in enumerate(ids)}


def test_pack_over_many_tasks_and_nothing(spark, no_documents):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', int(id % 1500)) as text").repartition(13)
    assert len({(r.doc_id, r.piece) for r in packed_rows(docs)}) == len(packed_rows(docs))
    assert packed_rows(no_documents) == []
    assert len(packed_rows(spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string"))) == 2


def test_ids_equal_those_of_the_files_own_library(tricky):
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(tokenizer_path())
    file.encode_special_tokens = True
    encode = packing.encoder(tokenizer_path()).encode_ordinary
    texts = [r[1] or "" for r in tricky] + ["<|endoftext|> in text", "it's  10,000\t\n\n x", "🙂🙃 ça", "\x00\x7f�", "ـ عربى 中文"]
    for text in texts:
        assert encode(text) == file.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_found_as_by_the_unmodified_library(spark):
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(tokenizer_path())
    texts = [
        "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y", "\n<|endoftext|>\n\n", "é<|endoftext|>🙂",
        "<|endoftext|", "<|ENDOFTEXT|>", "<<|endoftext|>>", "word " * 1500 + "<|endoftext|> end",
    ]
    encode = packing.encoder(tokenizer_path()).encode
    want = {}
    for i, text in enumerate(texts):
        ids = file.encode(text, add_special_tokens=False).ids
        assert encode(text, allowed_special="all") == ids
        first = len(ids + [packing.END]) % packing.LIMIT or packing.LIMIT
        want[i] = (len(ids) + 1, zlib.crc32(np.array((ids + [packing.END])[:first], dtype="<u4").tobytes()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packed_rows(docs)
    got = {i: (sum(r.length for r in rows if r.doc_id == i), next(r.ids_crc32 for r in rows if r.doc_id == i and r.piece == 0)) for i in want}
    assert got == want
