"""Dense sequential numbers over rows of any count."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.sources.tables import stored


def sequential_id(df: DataFrame, order: Sequence[str | Column], name: str = "id", start: int = 1,
                  made: list[str] | None = None) -> DataFrame:
    """``df`` with ``name``: start, start + 1, ... in the given order, then by all columns.

    Rows are dealt by ranges of the order, so that each task numbers one range; numbers go on from range to range by
    the sizes of those before, one row a range. No task sees all rows. The numbers are the same in every run, as
    rows that compare equal are equal. The dealt rows are stored, in a scratch folder that is added to ``made``.
    """
    total = [*order, *(F.col(f"`{c}`") for c in df.columns)]
    dealt = stored(df.repartitionByRange(*total).withColumn("_range", F.spark_partition_id()), "numbered", made)
    sizes = sorted(dealt.groupBy("_range").count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame([(r, b + start - 1) for (r, _), b in zip(sizes, before)], "_range int, _before bigint")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*total))
    return dealt.withColumn("_at", within).join(F.broadcast(offsets), "_range").select(
        *(F.col(f"`{c}`") for c in df.columns), (F.col("_at") + F.col("_before")).alias(name))
