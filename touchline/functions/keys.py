"""Surrogate keys computed from content.

A key that is a hash of the natural key is the same in every run and every
task, so a fact can compute the key of its dimension row in place: no join, no
shuffle, and a retried task cannot produce a different id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed_values as fv

# Stands for null inside a composite key: concat_ws alone would skip the null
# and let ("a", null) collide with ("a").
NULL_PART = "\\N"


def name_key(column: Column | str) -> Column:
    """Key of a single natural-key column; null stays null."""
    return F.sha2(_col(column).cast("string"), 256)


def composite_key(*columns: Column | str) -> Column:
    """Key of several natural-key columns; never null."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in columns]
    return F.sha2(F.concat_ws(fv.KEY_SEPARATOR, *parts), 256)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
