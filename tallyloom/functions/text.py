"""Text scans, snippets, token estimates and redaction."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

# A word character in any script; spelled out because the meaning of \b differs between JVMs.
_WORD = r"[\p{L}\p{M}\p{N}_]"


def _word_pattern(words: Sequence[str]) -> str:
    """Whole-word pattern; the leading letter test rejects most positions cheaply."""
    choice = "|".join(re.escape(w) for w in words)
    letters = sorted({c for w in words for c in (w[0].lower(), w[0].upper())})
    first = "".join(re.escape(c) for c in letters)
    return rf"(?=[{first}])(?<!{_WORD})(?i:({choice}))(?!{_WORD})"


def word_hits(text: Column, words: Sequence[str]) -> Column:
    """Whole-word, case-insensitive matches in text order, as written (``array<string>``)."""
    return F.regexp_extract_all(text, F.lit(_word_pattern(words)), 1)


def has_word(text: Column, words: Sequence[str]) -> Column:
    """True when any of the words occurs; null text counts as no match."""
    return F.coalesce(text.rlike(_word_pattern(words)), F.lit(False))


def extract_medications(
    text: Column, words: Sequence[str] = fixed.MEDICATIONS, seed: Column | None = None
) -> Column:
    """Distinct lower-cased hits in first-seen order; a non-null seed goes first, unchanged."""
    found = F.array_distinct(F.transform(word_hits(F.coalesce(text, F.lit("")), words), F.lower))
    if seed is None:
        return found
    return F.when(seed.isNull(), found).otherwise(
        F.concat(F.array(seed), F.array_except(found, F.array(seed)))
    )


def extract_symptoms(
    text: Column, words: Sequence[str] = fixed.SYMPTOMS, seed: Column | None = None
) -> Column:
    """Hits joined by ``', '``. Distinct is by spelling, before lower-casing."""
    found = F.transform(F.array_distinct(word_hits(F.coalesce(text, F.lit("")), words)), F.lower)
    if seed is not None:
        found = F.when(seed.isNull(), found).otherwise(F.concat(F.array(seed), found))
    return F.array_join(found, ", ")


def drug_symptom_pairs(medications: Column, symptoms: Column) -> Column:
    """Every medication with the first listed symptom; empty when either side is empty."""
    first = F.trim(F.split(symptoms, ",").getItem(0))
    pairs = F.transform(medications, lambda m: F.struct(m.alias("drug"), first.alias("symptom")))
    usable = (F.size(medications) > 0) & (F.length(symptoms) > 0)
    return F.when(usable, pairs).otherwise(F.array().cast("array<struct<drug:string,symptom:string>>"))


def approx_tokens(text: Column) -> Column:
    """One token per four characters, rounded up."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def snippet(text: Column, last_index: int, mark: str = "") -> Column:
    """Characters ``0..last_index`` inclusive, with ``mark`` appended when text was cut at ``last_index``."""
    head = F.substring(text, 1, last_index + 1)
    if not mark:
        return head
    return F.when(F.length(text) > last_index, F.concat(head, F.lit(mark))).otherwise(head)


# Longest prefix first, so that the tail of a two-part key never survives.
SECRET_RULES = {
    r"sk-ant-[A-Za-z0-9_-]+": "<ANTHROPIC_API_KEY>",
    r"sk-[A-Za-z0-9]+": "<OPENAI_API_KEY>",
}


def redact_secrets(text: Column, rules: Mapping[str, str] = SECRET_RULES) -> Column:
    """Mask every match of every rule, in rule order."""
    for pattern, mask in rules.items():
        text = F.regexp_replace(text, pattern, mask.replace("\\", "\\\\").replace("$", "\\$"))
    return text


def redact_authorization(headers: Column) -> Column:
    """Replace the Authorization entry of a ``map<string,array<string>>`` header column."""
    return F.transform_values(
        headers,
        lambda k, v: F.when(k == "Authorization", F.array(F.lit("Bearer <REDACTED>"))).otherwise(v),
    )
