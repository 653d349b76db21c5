"""Report sinks and the run registry."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.themes import changelog_blocks

REGISTRY_SCHEMA = (
    "run_id string, best_score_name string, best_score_value double, "
    "metadata map<string,string>, program string, saved_at timestamp"
)


def write_report_json(report: DataFrame, path: str, run_id: str) -> None:
    """Append the report rows of one run under ``path/run_id=…``; writing a run again replaces it."""
    (
        report.withColumn("run_id", F.lit(run_id))
        .write.partitionBy("run_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .json(path)
    )


def write_report_text(lines: DataFrame, path: str, order: Sequence[str] = ("section", "line_no")) -> None:
    """Write ``line`` in order; file names sort like the lines."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def write_blocks(pieces: DataFrame, path: str) -> None:
    """Write changelog documents in order; the parts of a list are joined, so part sizes leave no trace."""
    ordered = changelog_blocks(pieces).orderBy("document", "theme", "subtheme")
    ordered.select("document", F.regexp_replace("block", "^\n\n", "\n").alias("line")).write.partitionBy("document").mode(
        "overwrite"
    ).text(path)


def run_record(
    spark: SparkSession,
    run_id: str,
    score_name: str,
    score: float,
    metadata: Mapping[str, str] | None = None,
    program: Mapping[str, object] | None = None,
) -> DataFrame:
    """One registry row stamped with the current time; ``program`` (rules, demonstrations, settings) is kept as JSON."""
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(score_name).alias("best_score_name"),
        F.lit(float(score)).alias("best_score_value"),
        F.create_map(*[F.lit(str(x)) for kv in (metadata or {}).items() for x in kv]).cast("map<string,string>").alias("metadata"),
        F.lit(None if program is None else json.dumps(program, sort_keys=True)).cast("string").alias("program"),
        F.current_timestamp().alias("saved_at"),
    )


def save_run(record: DataFrame, path: str) -> None:
    """Append registry rows; earlier versions stay, and writers at the same time keep all of theirs.

    The rows of a run are one file, written in a folder of this call alone and then renamed into the run's
    folder. So a reader sees a version whole or not at all (where the file system renames in one step), and
    no writer's clean-up meets another writer's unfinished files.
    """
    spark = record.sparkSession
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    mark = uuid.uuid4().hex
    own = jvm.Path(f"{path}/_saving-{mark}")  # readers skip names that start with "_"
    record.repartition("run_id").write.partitionBy("run_id").parquet(own.toString())
    files = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for run in files.listStatus(own):
        if not run.isDirectory():
            continue
        target = jvm.Path(path, run.getPath().getName())
        files.mkdirs(target)
        for part in files.listStatus(run.getPath()):
            if part.getPath().getName().startswith("part-"):
                if not files.rename(part.getPath(), jvm.Path(target, f"part-{mark}-{part.getPath().getName()[5:]}")):
                    raise OSError(f"cannot publish {part.getPath().toString()}")
    files.delete(own, True)


def latest_runs(registry: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Newest version of every run, with the number of versions."""
    others = [c for c in registry.columns if c != "run_id"]
    newest = F.max_by(F.struct(*others), F.struct("saved_at", *tie))
    return (
        registry.groupBy("run_id")
        .agg(newest.alias("_r"), F.count(F.lit(1)).alias("versions"))
        .select("run_id", "_r.*", "versions")
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All saved versions; no row when the registry does not exist yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path)


def load_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Newest version of one run with the program that was saved; no row when the run is unknown."""
    return latest_runs(read_registry(spark, path).filter(F.col("run_id") == run_id))
