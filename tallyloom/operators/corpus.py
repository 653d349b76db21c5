"""Unify classification rows with their annotations and derive examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as txt
from ..functions.status import PAIRS, label_to_bool, label_to_status
from .ranks import id_rank, split_hot

# Pairs of a text in one row. Lists of all texts are cut into parts of this size, so no row grows with a text.
PART = 1_000
# Cells in which the notes of texts are counted; a cell of more than PART notes takes the way of long lists.
NOTE_CELLS = 1 << 24


def text_key(text: Column) -> Column:
    """Fixed-width join key of a text; all null texts share the empty key, so null joins null."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def _digest(text: Column) -> Column:
    """The same key in half the bytes, for rows that move."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def _shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def long_pairs(notes: DataFrame, text: str, a: str, b: str, row_id: str) -> DataFrame:
    """Annotations in long form with their position inside the text: ``text_key, pos, a, b``.

    Linear in the input whatever the number of annotations of one text.
    """
    keyed = notes.select(
        _digest(F.col(text)).alias("text_key"), F.col(row_id).alias("row_id"), F.col(a), F.col(b)
    )
    return id_rank(keyed, "row_id", ["text_key"], name="pos").withColumn("text_key", _shown(F.col("text_key")))


def _pair_list(rows: Column, a: str, b: str) -> Column:
    ordered = F.sort_array(rows)
    return F.transform(ordered, lambda r: F.struct(r[a].alias(a), r[b].alias(b)))


def _part(pos: Column, size: int) -> Column:
    return F.floor((pos - 1) / size).cast("long")


def pairs_by_text(
    notes: DataFrame, text: str, a: str, b: str, row_id: str, part_size: int = PART
) -> DataFrame:
    """Annotation pairs per text in parts of ``part_size``: ``text, part, pairs``, parts from 0.

    Duplicates and nulls are kept, in ``row_id`` order. Digests are grouped; only texts with many notes
    are ranked. Each text is attached once, at the end.
    """
    few, many = split_hot(notes, notes, [F.col(text)], PART, NOTE_CELLS)
    key, part = _digest(F.col(text)).alias("text_key"), _part(F.col("pos"), part_size).alias("part")
    # Texts with few notes move once and are listed where they arrive.
    near = _placed(few.select(key, F.col(row_id).alias("row_id"), F.col(a), F.col(b)), ["text_key"], "pos")
    lists = _cut(near.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("pos", a, b))).alias("rows")), ["rows"], part_size)
    far = id_rank(many.select(key, F.col(row_id).alias("row_id"), F.col(a), F.col(b)), "row_id", ["text_key"], name="pos")
    parts = far.groupBy("text_key", part).agg(F.collect_list(F.struct("pos", a, b)).alias("rows"))
    texts = notes.select(key, text).distinct()
    joined = [p.select("text_key", "part", "rows").join(texts, "text_key") for p in (lists, parts)]
    return joined[0].unionByName(joined[1]).select(text, "part", _pair_list(F.col("rows"), a, b).alias("pairs"))


def _placed(notes: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Notes brought together by text and numbered there; equal and null ids keep the order in which they come."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy("row_id"))
    return notes.repartition("text_key").withColumn(name, place.cast("long"))


def _cut(lists: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Whole sorted lists of at most ``PART`` entries to parts of ``size``, beside the number ``n_parts`` of them."""
    if size >= PART:
        return lists.withColumns({"part": F.lit(0).cast("long"), "n_parts": F.lit(1).cast("long")})
    longest = F.greatest(F.lit(1), *[F.size(c) for c in columns])
    parts = lists.withColumn("n_parts", _part(longest, size) + 1)
    parts = parts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)))
    start = (F.col("part") * size + 1).cast("int")
    return parts.withColumns({c: F.slice(c, start, F.lit(size)) for c in columns})


def _tagged(notes: DataFrame, kind: str, second: str, text: str, row_id: str) -> DataFrame:
    return notes.select(
        text,
        F.lit(kind).alias("kind"),
        F.col(row_id).cast("long").alias("row_id"),
        F.col("drug").cast("string").alias("drug"),
        F.col(second).cast("string").alias("second"),
    )


def _stacked(effects: DataFrame, dosages: DataFrame, text: str, row_id: str) -> DataFrame:
    """Both annotation tables in one shape, so that they are aggregated and joined once."""
    return _tagged(effects, "effect", "effect", text, row_id).unionByName(
        _tagged(dosages, "dosage", "dosage", text, row_id)
    )


def _per_kind(count: Column) -> list[Column]:
    return [
        F.sum(F.when(F.col("kind") == "effect", count)).alias("n_effects"),
        F.sum(F.when(F.col("kind") == "dosage", count)).alias("n_dosages"),
    ]


def unify_counts(
    base: DataFrame, effects: DataFrame, dosages: DataFrame, text: str = "text", label: str = "label"
) -> DataFrame:
    """Classification rows with a boolean label and the exact number of annotations of each kind.

    The light form of ``unify_corpus`` for statistics: no list is built, no pair is shuffled.
    """
    kinds = effects.select(text_key(F.col(text)).alias("text_key"), F.lit("effect").alias("kind")).unionByName(
        dosages.select(text_key(F.col(text)).alias("text_key"), F.lit("dosage").alias("kind"))
    )
    counts = kinds.groupBy("text_key").agg(*_per_kind(F.lit(1)))
    rows = base.withColumn("text_key", text_key(F.col(text)))
    joined = rows.join(counts, "text_key", "left")
    return joined.select(
        *[c for c in base.columns if c != label],
        "text_key",
        label_to_bool(F.col(label)).alias("label"),
        F.coalesce("n_effects", F.lit(0)).alias("n_effects"),
        F.coalesce("n_dosages", F.lit(0)).alias("n_dosages"),
    )


def _collected(kind: str) -> Column:
    return F.collect_list(F.when(F.col("kind") == kind, F.struct("_pos", "drug", "second")))


def _note_lists(notes: DataFrame, size: int) -> DataFrame:
    """Both sorted pair lists of every text with few notes, beside their lengths; a note moves once."""
    lists = _placed(notes, ["text_key", "kind"], "_pos").groupBy("text_key").agg(
        *_per_kind(F.lit(1)),
        F.sort_array(_collected("effect")).alias("effect_rows"),
        F.sort_array(_collected("dosage")).alias("dosage_rows"),
    )
    return _cut(lists, ["effect_rows", "dosage_rows"], size)


def _note_parts(notes: DataFrame, size: int) -> DataFrame:
    """Both pair lists of texts with many notes, cut into parts, beside the counts of the whole text."""
    placed = id_rank(notes, "row_id", ["text_key", "kind"], name="_pos")
    parts = placed.groupBy("text_key", _part(F.col("_pos"), size).alias("part")).agg(
        *_per_kind(F.lit(1)), _collected("effect").alias("effect_rows"), _collected("dosage").alias("dosage_rows")
    )
    whole = Window.partitionBy("text_key")
    totals = {n: F.sum(n).over(whole) for n in ("n_effects", "n_dosages")}
    return parts.withColumns({**totals, "n_parts": F.max("part").over(whole) + 1})


def unify_corpus(
    base: DataFrame,
    effects: DataFrame,
    dosages: DataFrame,
    text: str = "text",
    label: str = "label",
    row_id: str = "row_id",
    part_size: int = PART,
) -> DataFrame:
    """Every classification row (duplicates too) with a boolean label and both pair lists.

    Lists of every text are cut into parts of ``part_size`` pairs: a row comes once per ``part`` of its
    text, from 0 to ``n_parts`` - 1. ``n_effects`` and ``n_dosages`` count the whole text.
    Annotations are listed by digest. Those of a text with at most ``PART`` of them move once; others are
    ranked and spread, so a text with most of them is no task's alone.
    """
    notes = _stacked(effects, dosages, text, row_id)
    few, many = split_hot(notes, notes, [F.col(text)], PART, NOTE_CELLS)
    plain, crowded = split_hot(base, notes, [F.col(text)], PART, NOTE_CELLS)
    key = _digest(F.col(text))
    few, many = (n.withColumn("text_key", key).drop(text) for n in (few, many))
    plain, crowded = (b.withColumn("text_key", key) for b in (plain, crowded))
    near = plain.join(_note_lists(few, part_size), "text_key", "left")
    if part_size >= PART:  # also of rows without notes, and known to the planner
        near = near.withColumn("n_parts", F.lit(1).cast("long"))
    far = crowded.join(_note_parts(many, part_size), "text_key", "left")
    columns = [*base.columns, "text_key", "part", "n_parts", "effect_rows", "dosage_rows", "n_effects", "n_dosages"]
    joined = near.select(*columns).unionByName(far.select(*columns))
    none = F.array().cast("array<struct<_pos:bigint,drug:string,second:string>>")

    def pairs(column: str, second: str) -> Column:
        ordered = F.sort_array(F.coalesce(F.col(column), none))
        return F.transform(ordered, lambda r: F.struct(r["drug"].alias("drug"), r["second"].alias(second)))

    return joined.select(
        *[c for c in base.columns if c not in (text, label)],
        F.col(text).alias("text"),
        _shown(F.col("text_key")).alias("text_key"),
        label_to_bool(F.col(label)).alias("label"),
        F.coalesce("part", F.lit(0)).cast("long").alias("part"),
        F.coalesce("n_parts", F.lit(1)).cast("long").alias("n_parts"),
        pairs("effect_rows", "effect").alias("drug_effect_pairs"),
        pairs("dosage_rows", "dosage").alias("drug_dosage_pairs"),
        F.coalesce("n_effects", F.lit(0)).alias("n_effects"),
        F.coalesce("n_dosages", F.lit(0)).alias("n_dosages"),
    )


def valid_items(df: DataFrame, raw_json: str | None = None) -> DataFrame:
    """Keep rows that carry both a ``text`` and a ``label`` field (a null value still counts)."""
    if raw_json is None:
        missing = {"text", "label"} - set(df.columns)
        return df.limit(0) if missing else df
    fields = F.from_json(F.col(raw_json), "map<string,string>")
    has = F.map_contains_key(fields, "text") & F.map_contains_key(fields, "label")
    return df.filter(F.coalesce(has, F.lit(False)))


def to_examples(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Raw rows to ``input`` and ``expected`` structs with full confidence and no pairs."""
    return df.withColumns(
        {
            "input": F.struct(F.coalesce(F.col(text), F.lit("")).alias("text")),
            "expected": F.struct(
                label_to_status(F.col(label)).alias("ade_status"),
                F.lit(1.0).alias("confidence"),
                F.array().cast(PAIRS).alias("drug_symptom_pairs"),
            ),
        }
    )


def extraction_examples(unified: DataFrame) -> DataFrame:
    """Distinct drugs, and distinct effects, of each record in first-seen order: ``part, kind, items``.

    Drugs come from the effect pairs, else from the dosage pairs. An item is listed in the part of its
    first occurrence only, so the parts of a record, one after the other, are its distinct items.
    """
    effects, dosages = F.col("drug_effect_pairs"), F.col("drug_dosage_pairs")
    drugs = F.when(F.col("n_effects") > 0, F.transform(effects, lambda p: p["drug"])).otherwise(
        F.transform(dosages, lambda p: p["drug"])
    )
    kinds = {"drugs": drugs, "effects": F.transform(effects, lambda p: p["effect"])}
    keep = [c for c in unified.columns if c not in ("drug_effect_pairs", "drug_dosage_pairs")]

    # A record of one part holds all its items.
    whole = [F.struct(F.lit(kind).alias("kind"), F.array_distinct(items).alias("items")) for kind, items in kinds.items()]
    found = F.filter(F.array(*whole), lambda w: F.size(w["items"]) > 0)
    single = unified.where(F.col("n_parts") == 1).select(*keep, F.explode(found).alias("_x")).select(*keep, "_x.*")

    def listed(kind: str, items: Column) -> Column:
        return F.transform(items, lambda i, n: F.struct(F.lit(kind).alias("kind"), n.cast("long").alias("at"), i.alias("item")))

    # Of others, each part is read once per text, whatever the number of records that share it.
    cut = unified.where(F.col("n_parts") > 1)
    once = cut.groupBy("text_key", "part").agg(F.first(F.concat(*[listed(k, i) for k, i in kinds.items()])).alias("_x"))
    seen = once.select("text_key", "part", F.explode("_x").alias("_x")).select("text_key", "part", "_x.*")
    first = seen.groupBy("text_key", "kind", "item").agg(F.min(F.struct("part", "at")).alias("_f"))
    items = first.groupBy("text_key", F.col("_f.part").alias("part"), "kind").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("_f.at").alias("at"), "item"))), lambda r: r["item"]).alias("items")
    )
    return single.unionByName(cut.select(*keep).join(items, ["text_key", "part"]).select(*keep, "kind", "items"))


def classification_examples(unified: DataFrame) -> DataFrame:
    """Text with its drugs and effects (duplicates kept) and the expected answer, part by part."""
    pairs = F.col("drug_effect_pairs")
    return unified.withColumns(
        {
            "drugs": F.transform(pairs, lambda p: p["drug"]),
            "effects": F.transform(pairs, lambda p: p["effect"]),
            "has_ade": F.col("label"),
            "confidence": F.when(F.col("label"), 0.8).otherwise(0.2),
        }
    )


def synthetic_examples(
    df: DataFrame,
    sentence: str = "sentence",
    label: str = "label",
    medications: Sequence[str] = fixed.MEDICATIONS,
    symptoms: Sequence[str] = fixed.SYMPTOMS,
) -> DataFrame:
    """Sentences to typed examples through the word scans."""
    scanned = df.withColumns(
        {
            "medications": txt.extract_medications(F.col(sentence), medications),
            "symptoms": txt.extract_symptoms(F.col(sentence), symptoms),
        }
    )
    return scanned.withColumns(
        {
            "ade_status": label_to_status(F.col(label)),
            "confidence": F.when(F.col(label) == 1, 0.8).otherwise(0.9),
            "drug_symptom_pairs": txt.drug_symptom_pairs(F.col("medications"), F.col("symptoms")),
        }
    )


def clean_input(df: DataFrame) -> DataFrame:
    """Coerce report, medications and symptoms of any scalar or list type to text and text lists."""
    types = dict(df.dtypes)

    def listed(name: str, text_only: bool) -> Column:
        kind, value = types[name], F.col(name)
        if kind.startswith("array"):
            items = F.transform(F.filter(value, lambda v: v.isNotNull()), lambda v: v.cast("string"))
            kept = items
        elif kind == "string" or not text_only:
            kept = F.when(value.isNotNull(), F.array(value.cast("string")))
        else:  # a number is no symptom
            kept = F.lit(None).cast("array<string>")
        if text_only:
            kept = F.filter(kept, lambda v: v != "")
        return F.coalesce(kept, F.array().cast("array<string>"))

    return df.withColumns(
        {
            "patient_report": F.coalesce(F.col("patient_report").cast("string"), F.lit("")),
            "medications": listed("medications", False),
            "symptoms": listed("symptoms", True),
        }
    )


def check_required(df: DataFrame, order: str, required: Sequence[str], kind: str = "training") -> DataFrame:
    """One row: number of examples and the first problem, by ``order``, or null when all is well."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(missing, F.col(order))).alias("first_bad"))
    problem = (
        F.when(F.col("n") == 0, f"Invalid {kind} examples: cannot be empty")
        .when(
            F.col("first_bad").isNotNull(),
            F.format_string(f"Invalid {kind} examples: item %d missing required fields", F.col("first_bad")),
        )
    )
    return seen.withColumn("error", problem)
