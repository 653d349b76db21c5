import random

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def letters():
    """Seeded texts of invented words."""

    def make(n_words: int, seed: int, vocabulary: int = 4000) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefgeiou") for _ in range(3 + rng.randrange(vocabulary) % 6)) for _ in range(n_words))

    return make


@pytest.fixture(scope="session")
def tricky(letters):
    """Documents with null and empty texts, copies, near copies, a long text, repeated rows and null columns."""
    base = letters(80, 1)
    near = base.split()
    near[40] = "changed"
    passage = letters(30, 2)
    texts = {
        0: None, 1: "", 2: " \n\t", 3: "One", 4: "one two three", 5: base, 6: base, 7: " ".join(near),
        8: letters(40, 3) + "\n" + passage + "\n" + letters(20, 4), 9: passage + " " + letters(25, 5),
        10: letters(9000, 6), 11: "a " * 400, 12: "Ünï códe 日本語 😀 " * 20, 13: letters(25, 7), 14: "x" * 300,
    }
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", None) for i, t in texts.items()]
    return rows + [rows[5], rows[13], rows[13]]


@pytest.fixture
def documents(spark, tricky):
    return spark.createDataFrame(tricky, SCHEMA)


@pytest.fixture
def crowded_columns(spark, tricky):
    """The same documents with columns whose names the operators might use themselves."""
    names = [
        "start", "stop", "spans", "tie", "size", "task", "piece", "length", "rank", "bits", "root", "n", "w", "label", "grade",
        "segment", "first", "anchor", "wording", "family", "position", "target", "copies", "taken", "source_size", "kept",
        "n_words", "n_bytes", "sequence_id", "offset", "expected_grade", "tail_probability", "wanted", "least", "_id", "component_id",
    ]
    schema = T._parse_datatype_string(SCHEMA)
    for name in names:
        schema = schema.add(name, "string")
    return spark.createDataFrame([(*r, *["clash"] * len(names)) for r in tricky], schema)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
