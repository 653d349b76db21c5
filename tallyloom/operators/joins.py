"""Joins on text or id: null-safe equality, prediction alignment, replayed responses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null equals null; the key columns of ``right`` are dropped."""
    shadow = {k: f"_right_{k}" for k in keys}
    side = right.select(
        *[F.col(c).alias(shadow.get(c, c)) for c in right.columns]
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(shadow[k])) for k in keys])
    return left.join(side, same, how).drop(*shadow.values())


def align_predictions(
    predictions: DataFrame, truth: DataFrame, keys: Sequence[str] = ("example_id",), strict: bool = False
) -> DataFrame:
    """Pair predictions with the truth of the same key.

    Lenient: every prediction stays, missing truth is null. Strict: any key found on one side
    only fails the job with an error.
    """
    if not strict:
        return predictions.join(truth, list(keys), "left")
    both = predictions.withColumn("_p", F.lit(1)).join(
        truth.withColumn("_t", F.lit(1)), list(keys), "full_outer"
    )
    unequal = F.col("_p").isNull() | F.col("_t").isNull()
    guard = F.when(
        unequal, F.raise_error(F.lit("Predictions and actuals must have same length")).cast("int")
    ).otherwise(F.lit(1))
    return both.filter(guard == 1).drop("_p", "_t")


def request_key(method: str, uri: str, body: str):
    """Digest of a request: equal requests share it."""
    return F.sha2(F.to_json(F.struct(F.col(method), F.col(uri), F.col(body))), 256)


def replay_responses(
    requests: DataFrame,
    recordings: DataFrame,
    order: str = "recorded_at",
    method: str = "method",
    uri: str = "uri",
    body: str = "request_body",
    response: str = "response_body",
) -> DataFrame:
    """Serve each request the earliest recorded response of the same method, address and body.

    A request without a recording keeps its row with a null response and an error text.
    """
    first = recordings.groupBy(request_key(method, uri, body).alias("_key")).agg(
        F.min(F.struct(F.col(order).alias("o"), F.col(response).alias("r"))).alias("_rec")
    )
    keyed = requests.withColumn("_request_key", request_key(method, uri, body))
    joined = keyed.join(first, F.col("_request_key") == F.col("_key"), "left")
    return joined.select(
        *[F.col(c) for c in requests.columns],
        F.col("_rec.r").alias(response),
        F.when(F.col("_key").isNull(), F.lit("no recorded response")).alias("error"),
    )
