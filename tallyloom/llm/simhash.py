"""SimHash near-duplicates through pivot distance tables.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 values (seed 42) of the text's
word shingles. Fingerprints link when at most ``max_bits`` bits differ, and a document's component is
everything reachable over links.

Search. Only distinct fingerprints take part, so copies cost nothing. For each one the Hamming distances to
``PIVOTS`` reference fingerprints are computed once and packed, seven to a long. By the triangle inequality
a pair can only link if no coordinate differs by more than ``max_bits``: that test on the packed tables
discards pairs, and the bits of the survivors are compared. So that not all pairs meet, pairs must also agree
in a key: the 64 bits fall into ``blocks`` blocks, at most ``max_bits`` of them can differ, so linked
fingerprints agree in all bits of some choice of ``blocks - max_bits`` blocks. With more blocks the keys get
longer and the buckets smaller, at the price of more keys; ``blocks`` is chosen from the number of distinct
fingerprints and has no effect on the result.

Crowded buckets. Near copies of one text share most keys. In a bucket, members near one of its own ``LEADS``
reference members are linked to it (a row each, not a pair each); only then are pairs compared, and only
between members that are in different components so far. So neither all pairs of a crowd are tested nor all
of its links written, but no link between components is lost.

Edge cases: a null or word-free text has fingerprint zero and links like any other; fewer words than the
shingle length make one shingle; repeated rows each get the component of their key; a null key takes part
as the largest value and its component is the smallest key reachable (null if there is none); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .staging import drop_staged, stage

PIVOTS = 28
LEADS = 6
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    begin, end = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    votes = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), CHUNK):
        values = np.array([digest(line[a:b], 42) for a, b in zip(begin[at : at + CHUNK], end[at : at + CHUNK])], dtype="<u8")
        votes += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = votes * 2 > len(begin)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "bits"])

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id`` and its fingerprint as a long, for every row."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        _fingerprints(shingle), "doc_id long, bits long"
    )


def pivot(i: int) -> int:
    """Reference fingerprint ``i``: a row of the 64-bit Hadamard code, so any two differ in 32 bits."""
    return sum(1 << b for b in range(64) if bin(b & (i + 1)).count("1") % 2)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _pack(distances: list[Column]) -> list[Column]:
    """Distances of 0 to 64, seven to a long, in lanes of eight bits."""
    longs = []
    for at in range(0, len(distances), 7):
        lanes = [F.shiftleft(d.cast("long"), 8 * i) for i, d in enumerate(distances[at : at + 7])]
        packed = lanes[0]
        for lane in lanes[1:]:
            packed = packed.bitwiseOR(lane)
        longs.append(packed)
    return longs


def _within(a: Column, b: Column, most: int) -> Column:
    """No lane of ``a`` and ``b`` differs by more than ``most``: bit 7 of each lane of a + 128 - b + most stays set."""
    high, add = (sum(v << (8 * i) for i in range(7)) for v in (128, most))
    top = F.lit(high)
    one_way = ((a.bitwiseOR(top) - b) + F.lit(add)).bitwiseAND(top) == top
    other = ((b.bitwiseOR(top) - a) + F.lit(add)).bitwiseAND(top) == top
    return one_way & other


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Masks of all choices of ``blocks - max_bits`` of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(single, blocks - max_bits)]


def blocks_for(n: int, max_bits: int) -> int:
    """Fewest blocks (two above ``max_bits`` at least) whose keys outnumber ``n`` fingerprints."""
    blocks = max_bits + 2
    while (64 * (blocks - max_bits)) // blocks < np.log2(max(n, 1)) and blocks < max_bits + 5:
        blocks += 1
    return blocks


def links(distinct: DataFrame, max_bits: int, blocks: int | None = None) -> DataFrame:
    """Fingerprints with their component: ``bits, root`` for those of ``distinct`` (column ``bits``) with a link.

    ``root`` is a fingerprint of the component, the same for all its members.
    """
    masks = block_masks(blocks or blocks_for(distinct.count(), max_bits), max_bits)
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    keyed = distinct.select("bits", F.posexplode(table).alias("table", "mask")).select(
        "bits", "table", F.col("bits").bitwiseAND(F.col("mask")).alias("value")
    )
    leads = [F.min(F.struct(F.xxhash64("bits", F.lit(j)).alias("h"), "bits")).alias(f"lead{j}") for j in range(LEADS)]
    shared = (
        keyed.groupBy("table", "value")
        .agg(F.count(F.lit(1)).alias("n"), *leads)
        .where("n > 1")
        .select("table", "value", F.array(*[F.col(f"lead{j}.bits") for j in range(LEADS)]).alias("leads"))
    )
    # Members of shared buckets, each with the lead it links to, if any.
    members = keyed.join(shared, ["table", "value"])
    near = F.filter("leads", lambda p: (distance(p, F.col("bits")) <= max_bits) & (p != F.col("bits")))
    members = stage(members.select("table", "value", "bits", near.alias("near")), "simhash-members")
    stars = members.select("bits", F.explode("near").alias("other")).distinct()
    stars = stage(stars, "simhash-stars")
    first = components(stars, "bits", "other", "simhash")

    # Pairs between different components: the bucket's largest component meets only the others.
    rooted = members.select("table", "value", "bits").join(first, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    rooted = stage(rooted, "simhash-rooted")
    by_root = rooted.groupBy("table", "value", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        by_root.groupBy("table", "value")
        .agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("main"))
        .where("roots > 1")
        .select("table", "value", F.col("main.root").alias("main"))
    )
    inside = rooted.join(mixed, ["table", "value"])
    coordinates = _pack([distance(F.col("bits"), F.lit(_signed(pivot(i)))) for i in range(PIVOTS)])
    inside = stage(inside.withColumns({f"near{i}": c for i, c in enumerate(coordinates)}), "simhash-inside")
    a, b = inside.where("root <> main").alias("a"), inside.alias("b")
    ok = (F.col("a.table") == F.col("b.table")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.root") != F.col("b.root"))
    ok &= (F.col("b.root") == F.col("b.main")) | (F.col("a.bits") < F.col("b.bits"))
    for i in range(len(coordinates)):
        ok &= _within(F.col(f"a.near{i}"), F.col(f"b.near{i}"), max_bits)
    ok &= distance(F.col("a.bits"), F.col("b.bits")) <= max_bits
    bridges = a.join(b, ok).select(F.col("a.root").alias("bits"), F.col("b.root").alias("other")).distinct()
    second = components(stage(bridges, "simhash-bridges"), "bits", "other", "simhash-roots")
    joined = second.select(F.col("bits").alias("root"), F.col("root").alias("top"))
    out = stage(
        rooted.select("bits", "root").distinct().join(joined, "root", "left").select("bits", F.coalesce("top", "root").alias("root")),
        "simhash-roots",
    )
    drop_staged(members, stars, rooted, inside)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, bits, component_id`` for every row; ``component_id`` is the smallest key reachable."""
    every = stage(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = stage(every.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    linked = links(distinct.select("bits"), max_bits)
    members = linked.join(distinct, "bits")
    # Written, so that the joins have two plain sides: a component or a fingerprint with many rows can be split.
    tops = stage(members.groupBy("root").agg(F.min("least").alias("top")), "simhash-tops")
    topped = members.join(tops, "root").select("bits", "top")
    named = distinct.join(topped, "bits", "left").select("bits", F.coalesce("top", "least").alias("component_id"))
    return every.join(stage(named, "simhash-named"), "bits").select("doc_id", "bits", "component_id")


def hex_of(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
