"""Ranked reports over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows by ``order``, which must be a total order.

    The limit is applied first: each task keeps its own best ``n`` and only
    those travel. The rank is then numbered over at most ``n`` rows.
    """
    best = df.orderBy(*order).limit(n)
    if rank is None:
        return best
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def keep_top_groups(df: DataFrame, key: str, ranking: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the ``n`` best groups of ``ranking``."""
    return df.join(top_n(ranking, order, n).select(key), key, "left_semi")
