"""Profiles of corpus tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import pct_round, safe_ratio
from ..functions.text import snippet
from .corpus import text_key


def _stack(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def profile_shape(configs: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and types per configuration (schemas are known without a scan)."""
    parts = []
    for name, df in configs.items():
        types = ", ".join(f"{c}:{t}" for c, t in df.dtypes)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("config"),
                "n_rows",
                F.lit(len(df.columns)).cast("long").alias("n_columns"),
                F.lit(types).alias("types"),
            )
        )
    return _stack(parts)


def profile_non_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null count per column, from one aggregation."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count(F.col(n)).alias(n) for n in names])
    return counted.unpivot([], names, "column_name", "non_null")


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def preview_rows(
    df: DataFrame, order: str, k: int = 3, last_index: int = 100, masked: Sequence[str] = ("indexes",)
) -> DataFrame:
    """The first k rows with long texts cut and struct columns masked."""
    shown = []
    for name, kind in df.dtypes:
        if name in masked or kind.startswith("struct"):
            shown.append(F.lit("[struct]").alias(name))
        elif kind == "string":
            shown.append(snippet(F.col(name), last_index, "...").alias(name))
        else:
            shown.append(F.col(name))
    return df.orderBy(order).limit(k).select(*shown)


def corpus_stats(unified: DataFrame) -> DataFrame:
    """Totals of a unified corpus with percentages to one decimal; no list is built for this."""
    total = F.count(F.lit(1))
    counted = unified.agg(
        total.alias("total"),
        F.count_if(F.col("n_effects") > 0).alias("with_effects"),
        F.count_if(F.col("n_dosages") > 0).alias("with_dosages"),
        F.count_if(F.col("label")).alias("positives"),
    )
    parts = ("with_effects", "with_dosages", "positives")
    return counted.withColumns(
        {f"{p}_pct": pct_round(safe_ratio(F.col(p), F.col("total"))) for p in parts}
    )


def annotation_label_crosstab(unified: DataFrame) -> DataFrame:
    """Annotated against labelled, and whether every annotated row is positive."""
    noted = F.col("n_effects") > 0
    counted = unified.agg(
        F.count_if(noted & F.col("label")).alias("annotated_positive"),
        F.count_if(noted & ~F.col("label")).alias("annotated_negative"),
        F.count_if(~noted & F.col("label")).alias("plain_positive"),
        F.count_if(~noted & ~F.col("label")).alias("plain_negative"),
    )
    return counted.withColumn("all_annotated_positive", F.col("annotated_negative") == 0)


def _text_presence(configs: dict[str, Column | DataFrame], text: str) -> DataFrame:
    tagged = []
    for name, df in configs.items():
        flags = [F.lit(name == other).alias(f"in_{other}") for other in configs]
        tagged.append(df.where(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias("text_key"), *flags))
    return _stack(tagged).groupBy("text_key").agg(
        *[F.bool_or(f"in_{name}").alias(f"in_{name}") for name in configs]
    )


def config_alignment(configs: dict[str, DataFrame], text: str = "text") -> DataFrame:
    """Distinct texts per configuration and the sizes of all shared sets, in one shuffle of digests."""
    names = list(configs)
    presence = _text_presence(configs, text)
    sums = [F.count_if(F.col(f"in_{n}")).alias(n) for n in names]
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            sums.append(F.count_if(F.col(f"in_{a}") & F.col(f"in_{b}")).alias(f"{a}&{b}"))
    if len(names) > 2:
        every = reduce(lambda x, y: x & y, [F.col(f"in_{n}") for n in names])
        sums.append(F.count_if(every).alias("every"))
    counted = presence.agg(*sums)
    return counted.unpivot([], counted.columns, "configs", "n_texts")


def shared_text_annotations(configs: dict[str, DataFrame], shown: dict[str, Sequence[str]], text: str = "text") -> DataFrame:
    """All rows of one text that every configuration has (the smallest digest): ``config, row``."""
    presence = _text_presence(configs, text)
    every = reduce(lambda x, y: x & y, [F.col(f"in_{n}") for n in configs])
    sample = presence.filter(every).agg(F.min("text_key").alias("k")).scalar()
    parts = [
        df.filter(F.sha2(F.col(text), 256) == sample).select(
            F.lit(name).alias("config"), F.to_json(F.struct(*shown[name])).alias("row")
        )
        for name, df in configs.items()
    ]
    return _stack(parts)


def _texts(df: DataFrame, text: str) -> DataFrame:
    """Each distinct text once beside its digest; all null texts are one."""
    return df.select(text_key(F.col(text)).alias("_key"), text).groupBy("_key").agg(F.first(text).alias(text))


def intersect_texts(left: DataFrame, right: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts present on both sides: only digests of the right side are moved."""
    other = right.select(text_key(F.col(text)).alias("_key")).distinct()
    return _texts(left, text).join(other, "_key", "left_semi").select(text)


def except_texts(left: DataFrame, right: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts of the left side that the right side lacks."""
    other = right.select(text_key(F.col(text)).alias("_key")).distinct()
    return _texts(left, text).join(other, "_key", "left_anti").select(text)


def behaviour_rates(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Actual and predicted positives with their rates in percent."""
    counted = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("y_true")).alias("actual_positives"),
        F.count_if(F.col("y_pred")).alias("predicted_positives"),
    )
    return counted.withColumns(
        {
            "positive_prediction_pct": pct_round(safe_ratio(F.col("predicted_positives"), F.col("total"))),
            "ground_truth_positive_pct": pct_round(safe_ratio(F.col("actual_positives"), F.col("total"))),
        }
    )
