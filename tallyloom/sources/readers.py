"""Readers of corpora, examples, recorded interactions and pull requests."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import extract_medications

CORPUS_SCHEMAS = {
    "classification": "text string, label bigint",
    "drug_ade": "text string, drug string, effect string",
    "drug_dosage": "text string, drug string, dosage string",
}

INTERACTION_SCHEMA = (
    "cassette string, idx bigint, method string, uri string, request_body string, "
    "status bigint, response_body string, recorded_at string"
)

PULL_REQUEST_SCHEMA = "pr bigint, title string, description string, ellipsis_summary string"


def read_corpus(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str | None] = CORPUS_SCHEMAS
) -> dict[str, DataFrame]:
    """Named Parquet configurations, each with a ``row_index`` and ``file_name`` for stable order."""
    tables = {}
    for name, path in paths.items():
        reader = spark.read
        if schemas.get(name):
            reader = reader.schema(schemas[name])
        table = reader.parquet(path)
        tables[name] = table.select(
            "*",
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.row_index").alias("row_index"),
        )
    return tables


def _first_of(df: DataFrame, names: Sequence[str], kind: str) -> Column:
    present = [F.col(n).try_cast(kind) for n in names if n in df.columns]
    return F.coalesce(*present, F.lit(None).cast(kind))


def normalize_examples(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]] = fixed.FIELD_ALIASES,
    words: Sequence[str] = fixed.MEDICATIONS,
) -> DataFrame:
    """Resolve column aliases to ``text, label, drug, effect``; a missing drug comes from the text."""
    own_text = F.col("text") if "text" in df.columns else F.lit("")
    found = F.get(extract_medications(own_text, words), F.lit(0))
    return df.select(
        _first_of(df, aliases["text"], "string").alias("text"),
        F.coalesce(_first_of(df, aliases["label"], "bigint"), F.lit(0).cast("long")).alias("label"),
        F.coalesce(_first_of(df, aliases["drug"], "string"), found).alias("drug"),
        _first_of(df, aliases["effect"], "string").alias("effect"),
    )


def _raw_examples(spark: SparkSession, path: str, names: str) -> DataFrame | None:
    """All columns of a directory; None where no file of it has a schema that can be read."""
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).option("pathGlobFilter", names)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def read_examples(
    spark: SparkSession,
    paths: Sequence[str],
    aliases: Mapping[str, Sequence[str]] = fixed.FIELD_ALIASES,
    words: Sequence[str] = fixed.MEDICATIONS,
    names: str = "*.parquet",
) -> DataFrame:
    """Examples of Parquet directories; files inside one directory may differ in columns.

    Unreadable files give no rows; ``unreadable_examples`` names them.
    """
    merged = spark.createDataFrame([], "text string, label bigint, drug string, effect string")
    for path in paths:
        raw = _raw_examples(spark, path, names)
        if raw is not None:
            merged = merged.unionByName(normalize_examples(raw, aliases, words))
    return merged


def _file_path() -> Column:
    """The path of a row's file as it is on the file system; Spark gives it in the form of an address."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


PARQUET_MARK = b"PAR1"
# Files without rows are opened again up to this size, to tell other formats from tables without rows.
SMALL_FILE = 1 << 20


def unreadable_examples(
    spark: SparkSession,
    paths: Sequence[str],
    aliases: Mapping[str, Sequence[str]] = fixed.FIELD_ALIASES,
    names: str = "*.parquet",
    whole: bool = False,
) -> DataFrame:
    """Files that ``read_examples`` cannot read in full: ``file, bytes, reason, rows_lost``.

    Listed files are compared with the row counts of the footers that can be read, which costs no data pages.
    A file without rows is ``not a Parquet file`` or has ``no rows`` (an empty table, a damaged footer, a
    file above ``SMALL_FILE`` bytes, or one whose bytes cannot be read at all); ``rows_lost`` is null. ``whole``
    also decodes the columns that examples are made of and reports files with ``damaged pages`` and the number
    of their rows that were not read. Files of no bytes are not listed by Spark.
    """
    file = _file_path().alias("file")
    out = None
    for path in paths:
        listed = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("pathGlobFilter", names).load(path)
        marks = (F.substring("content", 1, 4) == F.lit(PARQUET_MARK)) & (F.substring("content", -4, 4) == F.lit(PARQUET_MARK))
        small = listed.where(F.col("length") <= SMALL_FILE).select(file, marks.alias("marked"))
        sizes = listed.select(file, F.col("length").alias("bytes"))
        raw = _raw_examples(spark, path, names)
        if raw is None:
            counts = spark.createDataFrame([], "file string, n_rows bigint, n_read bigint")
        else:
            counts = raw.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"))
            used = [n for listed_names in aliases.values() for n in listed_names if n in raw.columns]
            if whole and used:
                # The digest must be there for a file to count, so its columns are decoded and not pruned.
                decoded = raw.groupBy(file).agg(F.count(F.lit(1)).alias("n_read"), F.bit_xor(F.xxhash64(*used)).alias("_digest"))
                decoded = decoded.where(F.col("_digest").isNotNull()).drop("_digest")
                counts = counts.join(decoded, "file", "left").withColumn("n_read", F.coalesce("n_read", F.lit(0).cast("long")))
            else:
                counts = counts.withColumn("n_read", F.col("n_rows"))
        bad = sizes.join(counts, "file", "left").where(F.col("n_rows").isNull() | (F.col("n_read") < F.col("n_rows")))
        reason = (
            F.when(F.col("n_rows").isNotNull(), "damaged pages").when(~F.col("marked"), "not a Parquet file").otherwise("no rows")
        )
        part = bad.join(small, "file", "left").select("file", "bytes", reason.alias("reason"), (F.col("n_rows") - F.col("n_read")).alias("rows_lost"))
        out = part if out is None else out.unionByName(part)
    return out


def _call_fields():
    """The columns of one recorded call after its place, as a closure."""

    def fields(call: dict) -> tuple:
        request, response = call.get("request") or {}, call.get("response") or {}
        stamp = call.get("recorded_at")
        return (
            request.get("method"),
            request.get("uri"),
            (request.get("body") or {}).get("string"),
            (response.get("status") or {}).get("code"),
            (response.get("body") or {}).get("string"),
            None if stamp is None else str(stamp),
        )

    return fields


def _yaml_parser():
    """The batch parser as a closure, so that tasks need no installed package but PyYAML."""
    columns = [f.split()[0] for f in INTERACTION_SCHEMA.split(", ")]
    fields = _call_fields()

    def flatten(path: str, recorded: dict) -> Iterable[tuple]:
        for idx, call in enumerate(recorded.get("http_interactions") or []):
            if call is not None:
                yield path, idx, *fields(call)

    def parse(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        for files in batches:
            for path, content in zip(files["path"], files["content"]):
                try:
                    rows = list(flatten(path, yaml.load(content, Loader=loader) or {}))
                except (yaml.YAMLError, AttributeError):
                    continue
                yield pd.DataFrame(rows, columns=columns)

    return parse


def read_interactions(spark: SparkSession, path: str, names: str = "*.yml") -> DataFrame:
    """Recorded calls of a directory tree of YAML files; a file that does not parse gives no rows.

    ``cassette`` is the path below ``path``, so folder names of the machine match no pattern.

    One file is read by one task as one value. Large recordings are read by ``read_interactions_split``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .load(path)
        .select("path", "content")
    )
    return files.withColumn("path", _below(spark, path, F.col("path"))).mapInPandas(_yaml_parser(), INTERACTION_SCHEMA)


def _below(spark: SparkSession, path: str, file: Column) -> Column:
    """A file's path below ``path``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()
    return F.regexp_replace(file, F.lit(r"^([a-z0-9]+:)?/*" + re.escape(root.strip("/")) + "/"), F.lit(""))


CALL_START = "- request:"
SPLIT_CALL = "cassette string, block bigint, place bigint, " + INTERACTION_SCHEMA.split(", ", 2)[2]


def _split_parser():
    """The parser of single calls as a closure; each comes without its first words."""
    columns = [f.split()[0] for f in SPLIT_CALL.split(", ")]
    fields, start = _call_fields(), CALL_START

    def parse(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        for calls in batches:
            rows = []
            for cassette, block, place, value in zip(calls["cassette"], calls["block"], calls["place"], calls["value"]):
                # Keys after the list are no part of a call; its last line end went with the cut.
                item = re.split(r"\n(?=[A-Za-z_])", start + value, maxsplit=1)[0] + "\n"
                try:
                    read = yaml.load(item, Loader=loader)
                    if len(read) == 1:
                        rows.append((cassette, block, place, *fields(read[0])))
                except (yaml.YAMLError, AttributeError, TypeError):
                    continue
            yield pd.DataFrame(rows, columns=columns)

    return parse


def read_interactions_split(spark: SparkSession, path: str, names: str = "*.yml") -> DataFrame:
    """The rows of ``read_interactions`` from files of any size in the layout that the recorder writes.

    There, every call begins with ``CALL_START`` at the start of a line. Files are cut at these places, so Spark
    splits them, any number of tasks reads one file, and none holds more than a batch of calls. ``idx`` counts
    the calls of the splits before (one row per split) and the place inside the split; no rows are sorted. A call that
    does not parse gives no row, but the others of its file do. Calls in another layout are not found.
    """
    raw = (
        spark.read.option("lineSep", "\n" + CALL_START)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .text(path)
    )
    calls = raw.select(
        _below(spark, path, _file_path()).alias("cassette"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    blocks = calls.groupBy("cassette", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("cassette").orderBy("block")) - F.col("n")
    blocks = blocks.select("cassette", "block", (before - F.col("first") - 1).alias("shift"))  # what precedes the first call is no call
    parsed = calls.mapInPandas(_split_parser(), SPLIT_CALL).join(blocks, ["cassette", "block"])
    columns = [f.split()[0] for f in INTERACTION_SCHEMA.split(", ")]
    return parsed.withColumn("idx", F.col("place") + F.col("shift")).where(F.col("idx") >= 0).select(*columns)


def read_interactions_json(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from splittable JSON lines."""
    return spark.read.schema(INTERACTION_SCHEMA).option("recursiveFileLookup", True).json(path)


def typed_pull_requests(df: DataFrame) -> DataFrame:
    """Pull requests with null texts as ''."""
    return df.select(
        F.col("pr").cast("long").alias("pr"),
        "title",
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("ellipsis_summary", F.lit("")).alias("ellipsis_summary"),
    )


def read_pull_requests(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Pull requests from a JSON array, or from JSON lines with ``multi_line=False``."""
    return typed_pull_requests(
        spark.read.schema(PULL_REQUEST_SCHEMA).option("multiLine", multi_line).json(path)
    )
