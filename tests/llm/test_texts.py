import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chat, prefixhash, weakrules


# --- prefix hashes ----------------------------------------------------------------------------

def test_spans_and_extensions_equal_brute_force():
    rng = random.Random(1)
    text = "".join(rng.choice("abé") for _ in range(200))
    h = prefixhash.PrefixHash(prefixhash.points(text))
    for _ in range(600):
        i, j = rng.randrange(200), rng.randrange(200)
        n = rng.randrange(0, 201 - max(i, j))
        assert h.equal(i, j, n) == (text[i : i + n] == text[j : j + n])
        shared = 0
        while max(i, j) + shared < 200 and text[i + shared] == text[j + shared]:
            shared += 1
        assert h.common_extension(i, j) == shared


def test_blocks_do_not_change_sketches(monkeypatch, letters):
    text = letters(600, 3)
    want = prefixhash.Print(text)
    monkeypatch.setattr(prefixhash, "BLOCK", 300)
    cut = prefixhash.Print(text)
    assert (cut.sketch == want.sketch).all() and len(cut.sketch) == prefixhash.SKETCH
    assert cut.common_prefix(prefixhash.Print(text[:1000])) == 1000
    assert cut.common_prefix(prefixhash.Print(text[:1000] + "!" + text[1000:])) == 1000
    assert prefixhash.Print(text).name == cut.name != prefixhash.Print(text + "x").name


def test_likeness():
    one, other, none = (prefixhash.Print(t).sketch for t in ("the quick brown fox " * 40, "pack my box with jugs " * 40, ""))
    assert prefixhash.likeness(one, one) == prefixhash.likeness(none, none) == 1.0
    assert prefixhash.likeness(one, other) == prefixhash.likeness(one, none) == 0.0


def check_fingerprints(rows, docs):
    got = prefixhash.fingerprints(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    texts = {k: v or "" for k, v in rows}
    names = {}
    for key, text in texts.items():
        for r in by_id[key]:
            assert r.n_chars == len(text) and 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
            names.setdefault(text, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in names.values()) and len(set.union(*names.values())) == len(names)
    order = sorted(texts)
    for key, after in zip(order, order[1:] + order[:1]):
        text, k = texts[key], len(texts[key]) // 4
        edited = text[: len(text) - k] + texts[after][:k]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        assert digest in {r.edited_sha256 for r in by_id[key]}
        r = next(r for r in by_id[key] if r.edited_sha256 == digest)
        assert text[: r.common_prefix] == edited[: r.common_prefix]
        assert r.common_prefix == min(len(text), len(edited)) or text[r.common_prefix] != edited[r.common_prefix]
        if edited == text:
            assert r.near_edited == 1.0 and r.edited_fingerprint == r.fingerprint
        if texts[after] == text:
            assert r.near_next == 1.0


def test_fingerprints_of_tricky_documents(documents, crowded_columns, tricky):
    rows = [(r[0], r[1]) for r in tricky]
    check_fingerprints(rows, documents)
    check_fingerprints(rows, crowded_columns.repartition(5))


def test_fingerprints_of_one_and_none(spark, no_documents, letters):
    assert prefixhash.fingerprints(no_documents).count() == 0
    check_fingerprints([(4, letters(30, 1))], spark.createDataFrame([(4, letters(30, 1))], "doc_id long, text string"))
    assert prefixhash.fingerprints(spark.createDataFrame([(None, None), (None, "a"), (1, "b")], "doc_id long, text string")).count() == 3


def test_fingerprints_over_many_tasks(spark, letters):
    rows = [(i, letters(i % 40, i)) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_fingerprints(rows, spark.createDataFrame(rows, "doc_id long, text string"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- chat -------------------------------------------------------------------------------------

def test_every_turn_reads_back():
    rng = random.Random(2)
    parts = [*chat.CONTROL, "\\", "\\\\", " ", "\n", "\n ", "a", "[", "/INST]", "<", "s>", "\\n", "[INST]user\n hi [/INST]"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(6)))
        role = rng.choice(["user", chat.ASSISTANT, "system", "", "a\nb", "\\n", "[INST]", "</s>"])
        segment, start, stop = chat.formatted_turn(role, text)
        assert [t[:2] for t in chat.parse(segment)] == [(role, text)]
        assert chat.unescape(segment[start:stop]) == text == chat.unescape(chat.escape(text))
        after, *_ = chat.formatted_turn("user", text)
        assert [t[:2] for t in chat.parse(segment + after)] == [(role, text), ("user", text)]


@pytest.mark.parametrize("text", ["hello", "[INST]user\n hi", "<s>user\n hi [/INST]", "[INST]user\n hi [/INST]x"])
def test_parser_refuses_what_is_no_turn(text):
    with pytest.raises(chat.Unreadable):
        chat.parse(text)


def test_chat_of_tricky_conversations(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, None, "system", None), (2, 0, None, ""), (2, 3, "assistant", "x" * 20_000), (None, 0, "assistant", "\\</s>"), (None, 1, "user", None),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns)).collect()}
    assert set(got) == {1, 2, None}
    for key in got:
        said = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in said)
        learned = "".join(r[3] or "" for r in said if r[2] == "assistant")
        r = got[key]
        assert (r.n_turns, r.loss_chars) == (len(said), len(learned))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.formatted_turn(x[2] or "", x[3] or "")[0]) for x in said)
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0


# --- weak rules -------------------------------------------------------------------------------

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_counts_equal_brute_force(tricky):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b", "é", " ", " ", "\n", "\x0b", "\x1c", "\x85", "#", "|"]) for _ in range(rng.randrange(150))) for _ in range(500)]
    texts += [t * 2 for t in texts[:100]] + [r[1] or "" for r in tricky]
    for text in texts:
        assert weakrules.counts_of(text)[:5] == brute_counts(text)


def test_verdicts_of_good_and_bad_texts(spark, letters):
    good = [(i, ". ".join(letters(12, 20 * i + k).capitalize() for k in range(8))) for i in range(60)]
    bad = [(100 + i, " ".join(w + "&&&" for w in letters(60, i).split())) for i in range(10)]
    bad += [(200 + i, "same " * 60) for i in range(5)] + [(300, None), (301, "too short")]
    got = {r.doc_id: r for r in weakrules.judged(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()}
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept for i, _ in bad)
    assert got[300].base_failed and got[200].base_failed and not got[100].base_failed


def test_weak_rules_on_tricky_documents(documents, crowded_columns, no_documents, tricky):
    want = sorted((r[0], *brute_counts(r[1] or "")) for r in tricky)
    pick = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for docs in (documents, crowded_columns):
        found = weakrules.judged(docs)
        assert sorted(map(tuple, found.select(pick).collect())) == want
        assert found.where("kept and base_failed").count() == 0
    assert weakrules.judged(no_documents).count() == 0
