"""Token usage and request prices, in exact decimals until the final rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

USAGE = "struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>"


def usage_tokens(usage_json: Column) -> Column:
    """``struct<input, output, total>`` from a usage object; total defaults to the sum."""
    usage = F.from_json(usage_json, USAGE)
    read = F.coalesce(usage["prompt_tokens"], F.lit(0).cast("long"))
    written = F.coalesce(usage["completion_tokens"], F.lit(0).cast("long"))
    return F.struct(
        read.alias("input"),
        written.alias("output"),
        F.coalesce(usage["total_tokens"], read + written).alias("total"),
    )


def _per_token(price_per_1k: str) -> Column:
    return F.lit(Decimal(price_per_1k) / 1000).cast("decimal(12,10)")


def token_cost(tokens: Column, price_per_1k: str) -> Column:
    """Exact cost of a token count (decimal)."""
    return tokens.cast("decimal(20,0)") * _per_token(price_per_1k)


def request_cost(
    input_tokens: Column,
    output_tokens: Column,
    input_price: str = fixed.INPUT_PRICE_PER_1K,
    output_price: str = fixed.OUTPUT_PRICE_PER_1K,
) -> Column:
    """Exact cost of a call (decimal), input plus output."""
    return token_cost(input_tokens, input_price) + token_cost(output_tokens, output_price)


def dollars(cost: Column, digits: int = 6) -> Column:
    """A decimal cost rounded half up and returned as a double."""
    return F.round(cost, digits).cast("double")
