"""Compare a target listing with its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def orphans(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows with no counterpart in the source."""
    return target.join(source.select(*key), list(key), "left_anti")


def additions(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows the target does not have yet."""
    return orphans(source, target, key)
