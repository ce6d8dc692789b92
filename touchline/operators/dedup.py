"""One row per key, chosen by a total order.

Both operators are aggregations, not windows: every map task first reduces its
own rows to one candidate per key, so a key that owns a third of the table
sends one row per task through the shuffle instead of its whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Smallest row of each key by ``order``, then by all other columns.

    Nulls sort first. Equal rows are interchangeable, so the survivor is the
    same whatever the partitioning.
    """
    ranked = _ranking(df, key, order)
    if not ranked:
        return df.distinct()
    return _unpack(df, key, F.min(F.struct(*ranked)))


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Largest row of each key by ``order``, ties broken by all other columns."""
    ranked = _ranking(df, key, order)
    return _unpack(df, key, F.max(F.struct(*ranked)))


def _ranking(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> list[str]:
    rest = [c for c in df.columns if c not in key and c not in order]
    return [*order, *rest]


def _unpack(df: DataFrame, key, chosen) -> DataFrame:
    return df.groupBy(*key).agg(chosen.alias("_chosen")).select(*key, "_chosen.*").select(*df.columns)
