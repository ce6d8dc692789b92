"""Sums that do not depend on row order, for inputs shaped from the benchmark tables.

Floating-point addition changes with partitioning, so two runs of one query can
differ in the last digits, which the text and integer columns made from them would
show. Here whole units and millionths are added as integers, which is exact in any
order. The marts and panels use plain sums and means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this, or for NaN, the parts no longer fit and the plain sum is used.
LARGEST = "1e12D"
# Millionths are summed in two halves of so many bits, plain integers: a shuffled partial sum stays small.
HALF = 30


def exact_sum(value: str) -> Column:
    """Sum of a numeric SQL expression, exact to six digits after the point."""
    x = f"CAST({value} AS DOUBLE)"
    millionths = f"floor({x}) * 1000000L + floor(({x} - floor({x})) * 1000000D + 0.5D)"
    fits = f"abs({x}) < {LARGEST}"
    high = f"sum(if({fits}, shiftright({millionths}, {HALF}), NULL))"
    low = f"sum(if({fits}, ({millionths}) & {2 ** HALF - 1}L, NULL))"
    large = f"sum(if({fits}, NULL, {x}))"
    whole = f"CAST((CAST({high} AS DECIMAL(19,0)) * {2 ** HALF}BD + CAST({low} AS DECIMAL(19,0))) * 0.000001BD AS DOUBLE)"
    return F.expr(f"CASE WHEN {large} IS NULL THEN {whole} ELSE {large} + coalesce({whole}, 0D) END")


def comparable(value: Column) -> Column:
    """A mean rounded to four digits, so that two engines show the same; exact halves go up in both."""
    return F.floor(value * 10000 + 0.5001) / 10000
