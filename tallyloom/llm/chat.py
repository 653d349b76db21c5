r"""Chat formatting with a grammar round trip.

Grammar of the output, the same for every turn:

    turn  := open role "\n" " " text " " close
    open  := "[INST]" for every role but the assistant's, "<s>" for the assistant's
    close := "[/INST]" or "</s>"

The spaces beside the text belong to the marks, so no mark forms across its edges. A control string (the four
marks and others that chat models know) inside a text is written with a backslash before it and before any
backslashes in front of it; reading takes one away. Texts without control strings stay as they are.

Every turn is rendered as it is, parsed by the deterministic parser and compared with its source; where the
parser recovers something else, the conflicting strings are escaped and the turn is tried again until it is
identical. The result keeps the formatted text in segments of one turn each, with the span of the text under
the loss mask (the assistant's); the text of a conversation is the segments one after the other, so no
conversation is ever held whole.

Formatting and checking work on rows, wherever they are. Only for digests over whole conversations do the
segments of one meet: they are sorted and read as a stream, one turn at a time, so a conversation with a
third of all rows takes a task longer but no more memory (a digest over it is sequential by definition).

Edge cases: null texts and roles are empty; a null conversation is one of its own; equal turn numbers are
ordered by role, then text, null turns come first; repeated rows are turns of their own; an empty table
gives no rows; further columns pass through ``formatted``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSISTANT = "assistant"
OPEN, CLOSE = ("[INST]", "[/INST]"), ("<s>", "</s>")
#: Control strings; none contains a space, a backslash or a line end.
CONTROL = (
    "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|user|>", "<|assistant|>", "<|system|>", "<|end|>",
)
ANY = "|".join(regex.escape(c) for c in CONTROL)
PLAIN = regex.compile(rf"(\\*)({ANY})")
ESCAPED = regex.compile(rf"\\(\\*)({ANY})")


class Unreadable(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return PLAIN.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def _marks(role: str) -> tuple[str, str]:
    return CLOSE if role == ASSISTANT else OPEN


def render(role: str, text: str) -> str:
    """One turn; line ends and backslashes of a role are written as escapes, so a role is one line."""
    start, end = _marks(role)
    name = role.replace("\\", "\\\\").replace("\n", "\\n")
    return f"{start}{name}\n {text} {end}"


def _role(name: str) -> str:
    return regex.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns of a formatted text: role, text, and the span of the escaped text in it."""
    turns, at = [], 0
    while at < len(formatted):
        for start, end in (OPEN, CLOSE):
            if formatted.startswith(start, at):
                break
        else:
            raise Unreadable(f"no turn starts at {at}")
        line = formatted.find("\n ", at)
        if line < 0:
            raise Unreadable(f"the turn at {at} has no text")
        role, begin = _role(formatted[at + len(start) : line]), line + 2
        if (start, end) != _marks(role):
            raise Unreadable(f"the turn at {at} has the wrong mark")
        found = PLAIN.search(formatted, begin - 1)
        while found and found[1]:  # escaped: text
            found = PLAIN.search(formatted, found.end())
        if not found or found[2] != end or found.start() <= begin - 1 or formatted[found.start() - 1] != " ":
            raise Unreadable(f"the turn at {at} is not closed")
        stop = max(found.start() - 1, begin)
        turns.append((role, unescape(formatted[begin:stop]), begin, stop))
        at = found.end()
    return turns


def formatted_turn(role: str, text: str, tries: int = 3) -> tuple[str, int, int]:
    """A turn that reads back as its source, with the span of its text."""
    written = text
    for _ in range(tries):
        segment = render(role, written)
        try:
            turns = parse(segment)
        except Unreadable:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return segment, turns[0][2], turns[0][3]
        written = escape(written)
    raise Unreadable("a turn could not be written so that it reads back")


SEGMENT = ("segment", "loss_start", "loss_stop")


def _format(names: list[str], role: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            rows = []
            for who, said in zip(batch.column(at[role]), batch.column(at[text])):
                who = who.as_py() or ""
                segment, start, stop = formatted_turn(who, said.as_py() or "")
                rows.append((segment, start, stop) if who == ASSISTANT else (segment, 0, 0))
            kinds = (pa.string(), pa.int64(), pa.int64())
            new = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ([], [], []), kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(at[n]) for n in names], *new], names=[*names, *SEGMENT])

    return run


def formatted(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with ``segment`` (the formatted turn) and ``loss_start, loss_stop``, the span in it under the loss."""
    names = [c for c in turns.columns if c not in SEGMENT]
    schema = T.StructType([turns.schema[c] for c in names]).add("segment", "string").add("loss_start", "long").add("loss_stop", "long")
    return turns.select(*names).mapInArrow(_format(names, role, text), schema)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Reader:
    """Digests of one conversation, read from its segments."""

    def __init__(self, key: int | None):
        self.key, self.turns, self.loss, self.chars = key, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, segment: str, start: int, stop: int) -> None:
        for role, text, _, _ in parse(segment):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(segment[start:stop])
        self.loss += len(learned)
        self.learned.update(learned.encode("utf-8", "surrogatepass"))
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.key, self.turns, self.said.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    now: _Reader | None = None
    for batch in batches:
        done = []
        for key, segment, start, stop in zip(*[batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", *SEGMENT)]):
            key = key.as_py()
            if now is None or now.key != key:
                if now is not None:
                    done.append(now.row())
                now = _Reader(key)
            now.read(segment.as_py(), start.as_py(), stop.as_py())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now.row(), kinds)], names=names)


def digests(segments: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, read back from ``formatted`` output: turns, digests and sizes."""
    order = ["conv_id", F.col("_turn").asc_nulls_first(), "_role", "_text"]
    return (
        segments.select(
            F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"),
            F.coalesce(text, F.lit("")).alias("_text"), *SEGMENT,
        )
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", *SEGMENT)
        .mapInArrow(_digests, DIGESTS)
    )
