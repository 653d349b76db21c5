"""Running token sums per module, and themes that merge batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.costs import tokens_by_module
from ..operators.themes import SERVICE_RULES, Rules, assign_themes, named_members, theme_leaders, theme_names, with_theme_key

# Result versions that stay in the folder: the newest, and the one before for readers that have begun.
VERSIONS = 2


def _versions(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the versions in a folder of ``batch=…`` folders."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))


def _version(out: str, number: int) -> str:
    return f"{out}/batch={number:012d}"


def _drop_old(spark: SparkSession, out: str) -> None:
    for number in _versions(spark, out)[:-VERSIONS]:
        _drop(spark, _version(out, number))


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stream_token_usage(
    events: DataFrame,
    out: str,
    checkpoint: str,
    horizon: str,
    once: bool = True,
    event_id: str = "event_id",
    ts: str = "ts",
) -> StreamingQuery:
    """Keep token sums per module current; a repeated event counts once, a late one is counted apart.

    An event is late if it is older than the newest time of earlier micro-batches by more than ``horizon``
    (an interval such as ``7 days``); late events add to ``late_events`` of their module and to nothing else. Ids
    are remembered as long as an event that repeats them would not be late. Events without an id are never taken
    for repeats, events without a time are never late and their ids are remembered with the batch they came in.

    Each micro-batch writes the ids it has met, then the complete sums (one row per module) under its batch number,
    and replaces both when it runs again, so a restart never counts an event twice. The sums of the last
    ``VERSIONS`` batches stay, and ids of batches whose newest time is within the horizon.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = [v for v in _versions(spark, f"{out}/sums") if v < batch_id]
        before = spark.read.parquet(_version(f"{out}/sums", versions[-1])) if versions else None
        newest = before.agg(F.max(F.unix_micros("newest"))).first()[0] if versions else None
        back = F.expr(f"INTERVAL {horizon}")
        late = F.lit(False) if newest is None else F.coalesce(F.col("ts") < F.timestamp_micros(F.lit(newest)) - back, F.lit(False))
        tokens = [F.coalesce("module", F.lit("unknown")).alias("module"), "tokens_input", "tokens_output"]
        rows = batch.select(F.col(event_id).alias("id"), F.col(ts).cast("timestamp").alias("ts"), *tokens).withColumn("late", late).persist()
        latest = rows.agg(F.max(F.unix_micros("ts"))).first()[0]
        latest = max((t for t in (newest, latest) if t is not None), default=None)
        now = F.timestamp_micros(F.lit(latest).cast("long"))

        # Of an event that comes several times in a batch the least row counts.
        timely = rows.where("not late")
        fresh = timely.where("id is not null").groupBy("id").agg(F.min(F.struct("ts", "module", "tokens_input", "tokens_output")).alias("e"))
        fresh = fresh.select("id", F.coalesce("e.ts", now).alias("ts"), "e.module", "e.tokens_input", "e.tokens_output")
        if any(v < batch_id for v in _versions(spark, f"{out}/ids")):
            seen = spark.read.schema(fresh.schema.add("batch", "string")).parquet(f"{out}/ids").where(F.col("batch").cast("long") < batch_id)
            fresh = fresh.join(seen.select("id"), "id", "left_anti")
        fresh.write.mode("overwrite").parquet(_version(f"{out}/ids", batch_id))
        counted = spark.read.schema(fresh.schema).parquet(_version(f"{out}/ids", batch_id)).drop("id", "ts")

        zero = F.lit(0).cast("long")
        new = tokens_by_module(counted.unionByName(timely.where("id is null").drop("id", "ts", "late"))).withColumn("late_events", zero)
        missed = rows.where("late").groupBy("module").agg(F.count(F.lit(1)).alias("late_events")).withColumns({"input": zero, "output": zero})
        parts = new.unionByName(missed) if before is None else new.unionByName(missed).unionByName(before.drop("newest"))
        sums = parts.groupBy("module").agg(*[F.sum(c).alias(c) for c in ("input", "output", "late_events")])
        sums.withColumn("newest", now).write.mode("overwrite").parquet(_version(f"{out}/sums", batch_id))
        rows.unpersist()
        _drop_old(spark, f"{out}/sums")
        ends = spark.read.schema(fresh.schema.add("batch", "string")).parquet(f"{out}/ids").groupBy("batch").agg(F.max("ts").alias("ts"))
        for gone in ends.where((F.col("ts") < now - back) & (F.col("batch").cast("long") < batch_id)).collect():
            _drop(spark, _version(f"{out}/ids", int(gone["batch"])))

    stream = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()


def latest_token_usage(spark: SparkSession, out: str) -> DataFrame:
    """The newest sums written by the stream: ``module, input, output``."""
    return token_usage_and_late_events(spark, out).drop("late_events")


def token_usage_and_late_events(spark: SparkSession, out: str) -> DataFrame:
    """The newest sums with the number of events that came too late: ``module, input, output, late_events``."""
    newest = _versions(spark, f"{out}/sums")[-1]
    return spark.read.parquet(_version(f"{out}/sums", newest)).drop("newest")


def stream_merge_themes(
    prs: DataFrame,
    out: str,
    checkpoint: str,
    rules: Rules = SERVICE_RULES,
    batch_size: int = 5,
    once: bool = True,
) -> StreamingQuery:
    """Merge each micro-batch's themes into the themes so far.

    The state is one row per theme name: the theme it belongs to, with name and description. A micro-batch
    reads the version before it, lets its new names join the themes they are alike (or begin new ones) and
    writes the next version under its batch number; a repeated batch starts from the same version again. The
    memberships of a batch are only appended. Earlier themes never change, so none has to be merged anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_theme_key(assign_themes(batch, rules, batch_size)).withColumn("origin", F.lit(batch_id).cast("long"))
        rows.select("theme_key", "pr", "batch_no").write.mode("overwrite").parquet(_version(f"{out}/members", batch_id))
        names = theme_names(rows)
        before = [v for v in _versions(spark, f"{out}/names") if v < batch_id]
        if before:
            known = spark.read.parquet(_version(f"{out}/names", before[-1]))
            known = known.select("theme_key", F.col("origin"), F.col("own_theme").alias("theme"), F.col("own_description").alias("theme_description"))
            names = known.unionByName(names.join(known, "theme_key", "left_anti"))
        own = names.select("theme_key", F.col("theme").alias("own_theme"), F.col("theme_description").alias("own_description"), F.col("origin").alias("_o"))
        led = theme_leaders(names).drop("origin").join(own, "theme_key").withColumnRenamed("_o", "origin")
        led.write.mode("overwrite").parquet(_version(f"{out}/names", batch_id))
        _drop_old(spark, f"{out}/names")

    stream = prs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()


def accumulated_themes(spark: SparkSession, out: str) -> DataFrame:
    """Themes over all batches so far, with their members; the earliest batch names a theme."""
    newest = _versions(spark, f"{out}/names")[-1]
    leaders = spark.read.parquet(_version(f"{out}/names", newest))
    members = spark.read.parquet(f"{out}/members").where(F.col("batch").cast("long") <= newest)
    return named_members(members, leaders)
