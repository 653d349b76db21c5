"""Intermediate tables in the shared folder, and helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a single-process session without one gets its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tallyloom-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of a session, once, through Spark's own file server.

    For entry points that a session calls without having installed the package on its executors.
    """
    context = spark.sparkContext
    if getattr(context, "_tallyloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallyloom-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallyloom_shipped = True


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it from there.

    This cuts the lineage: an executor lost later costs a read, not the work above. The files go when
    the driver ends, or earlier through ``drop_staged``.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, *order: Column, name: str = "position", label: str = "numbered") -> DataFrame:
    """Rows of ``df`` with their place (from 0) in ``order``, without a window over the whole table.

    Rows are dealt by range and sorted in their partitions; the only global step adds up one count per
    partition. The result is staged.
    """
    place = F.monotonically_increasing_id()
    local = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"_part": F.shiftright(place, 33), name: place.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        label,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        local.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    )
    return local.join(starts, "_part").withColumn(name, F.col(name) + F.col("_from")).drop("_part", "_from")
