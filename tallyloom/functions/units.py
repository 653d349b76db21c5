"""Unit conversion and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def convert_units(value: Column, source: Column, target: Column) -> Column:
    """``struct<converted, error>``: the value in the target unit to 4 places, or an error text."""
    result = F.lit(None).cast("double")
    for (a, b), (times, over, before, after) in fixed.UNIT_CONVERSIONS.items():
        amount = value.cast("double")
        if before:
            amount = amount + F.lit(before)
        if times != 1.0:
            amount = amount * F.lit(times)
        if over != 1.0:
            amount = amount / F.lit(over)
        if after:
            amount = amount + F.lit(after)
        result = F.when((F.lower(source) == a) & (F.lower(target) == b), amount).otherwise(result)
    error = F.concat(
        F.lit("Error: Conversion from "), source, F.lit(" to "), target, F.lit(" not supported")
    )
    return F.struct(
        (F.round(result * 10000.0, 0) / 10000.0).alias("converted"),
        F.when(result.isNull(), error).alias("error"),
    )


def iso_stamp(instant: Column) -> Column:
    """ISO-8601 text in UTC."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_stamp(instant: Column) -> Column:
    """Compact stamp used in report names."""
    return F.date_format(instant, "yyyyMMdd_HHmmss")


def from_epoch(seconds: Column) -> Column:
    """UTC instant of an epoch-second count, without a time zone."""
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
