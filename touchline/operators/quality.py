"""Data-quality suite evaluated in one pass over the data."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import fixed_values as fv

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Expectation:
    """A rule on one column; ``broken`` counts rows, None means schema-only."""

    rule: str
    column: str
    broken: Column | None = None


def column_exists(column: str) -> Expectation:
    return Expectation("column_exists", column)


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.col(column).isNull())


def between(column: str, low=None, high=None) -> Expectation:
    """Inclusive bounds; nulls are not judged."""
    value = F.col(column)
    checks = []
    if low is not None:
        checks.append(value < low)
    if high is not None:
        checks.append(value > high)
    broken = F.lit(False)
    for check in checks:
        broken = broken | check
    return Expectation("between", column, broken)


def in_set(column: str, allowed: Iterable) -> Expectation:
    """Membership; nulls are not judged."""
    return Expectation("in_set", column, ~F.col(column).isin(*allowed))


def player_suite() -> list[Expectation]:
    return [
        *[column_exists(c) for c in fv.REQUIRED_COLUMNS],
        *[not_null(c) for c in fv.NOT_NULL_COLUMNS],
        *[between(c, low, high) for c, (low, high) in fv.VALUE_BOUNDS.items()],
        in_set("Position", fv.ALLOWED_POSITIONS),
    ]


def report(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """Rows (rule, column, total, unexpected, success), one per expectation.

    All counters are one aggregate, so the data is read once however many rules
    there are. A rule on a column the data lacks fails on every row.
    """
    present = set(df.columns)
    counters = [F.count(F.lit(1)).alias("total")]
    for i, rule in enumerate(suite):
        if rule.column not in present:
            counters.append(F.count(F.lit(1)).alias(f"bad_{i}"))
        elif rule.broken is None:
            counters.append(F.lit(0).cast("bigint").alias(f"bad_{i}"))
        else:
            counters.append(F.count_if(rule.broken).alias(f"bad_{i}"))
    rows = [
        F.struct(
            F.lit(rule.rule).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col("total"),
            F.col(f"bad_{i}").alias("unexpected"),
            (
                F.lit(rule.column in present)
                if rule.broken is None
                else (F.col(f"bad_{i}") == 0) & F.lit(rule.column in present)
            ).alias("success"),
        )
        for i, rule in enumerate(suite)
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def validate(df: DataFrame, suite: Sequence[Expectation] | None = None) -> bool:
    """Advisory check: log each failed rule, return whether all passed."""
    failed = report(df, suite or player_suite()).where("not success").collect()
    for row in failed:
        log.warning("failed: %s on %s (%d of %d rows)", row["rule"], row["column"],
                    row["unexpected"], row["total"])
    return not failed


def clean_numbers(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values; columns without a default keep their nulls."""
    return df.fillna(dict(defaults))
