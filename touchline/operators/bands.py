"""Threshold bands and single-value reductions used by the panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band(value: Column, steps: Sequence[tuple[float, str]]) -> Column:
    """Label of the highest step not above ``value``; the first label below all steps.

    Null values have no band.
    """
    result = F.lit(steps[0][1])
    for threshold, label in steps:
        result = F.when(value >= threshold, label).otherwise(result)
    return F.when(value.isNotNull(), result)


def percent_of_range(value: Column, low: Column, high: Column) -> Column:
    """Position of ``value`` between ``low`` and ``high`` in percent.

    A range of zero width puts the value at the top.
    """
    return F.when(high > low, (value - low) * 100.0 / (high - low)).when(
        value.isNotNull(), F.lit(100.0)
    )


def last_not_null(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Most recent non-null ``value`` of each series."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*key)
        .agg(F.max(F.struct(*order, value)).alias("_last"))
        .select(*key, F.col(f"_last.{value}").alias(value))
    )
