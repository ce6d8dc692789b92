"""As-of join: for each row the last record of its key at or before its time.

Both sides are laid on one line of time and the last record is carried forward. To keep a
hot key out of a single task, its line is cut into ranges of time of about
equal rows: ranges are carried forward on their own, and what is known when a range begins is the last
record of the ranges before it, one row for a range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.sources.tables import stored

#: Rows of a key that one task carries forward.
RANGE_ROWS = 100_000
#: Cut points of a key at most, each a row of the table of ranges.
MOST_RANGES = 1_000


def asof_join(rows: DataFrame, records: DataFrame, key: Sequence[str], at: str, since: str, ties: Sequence[str] = (),
              range_rows: int = RANGE_ROWS, made: list[str] | None = None) -> DataFrame:
    """``rows`` with the columns of their record, null where there is none.

    A record fits a row of the same ``key`` if ``since`` <= ``at``; the latest fits best, of equal times the largest by
    ``ties`` and then by its other columns. Rows without a key or a time have no record; records without either are
    never found. Rows stay as they are, repeated ones too. Column names of the two sides differ but for the key.
    The line of time is stored, in a scratch folder that is added to ``made``.
    """
    keys = list(key)
    taken = [c for c in records.columns if c not in keys]
    order = [since, *ties, *(c for c in taken if c not in (since, *ties))]
    record = F.struct(*order)
    left = rows.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"),
                       F.lit(None).cast(records.select(record.alias("r")).schema["r"].dataType).alias("_record"))
    right = records.where(_all_there([*keys, since])).select(
        *keys, F.col(since).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), record.alias("_record"))
    whole = _all_there([*keys, "_at"])
    # rows without a record are stored along, so that what gives ``rows`` is run once
    laid = stored(left.unionByName(right), "asof_line", made)
    line = laid.where(whole)
    large = line.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > range_rows).limit(1).count() > 0
    ranged = _ranges(line, keys, range_rows) if large else line.withColumn("_range", F.lit(0))
    same = [*keys, "_range"]
    carried = Window.partitionBy(*same).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the largest record so far is the latest one, as records order by time first
    found = ranged.withColumn("_own", F.max("_record").over(carried)).where("_kind = 1")
    if large:
        last = ranged.where("_kind = 0").groupBy(*same).agg(F.max("_record").alias("_last"))
        starts = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ranged.select(*same).distinct().join(last, same, "left")
        found = found.join(ranges.select(*same, F.max("_last").over(starts).alias("_before")), same, "left")
        found = found.withColumn("_own", F.coalesce("_own", "_before"))
    found = found.select("_row", F.col("_own").alias("_record"))
    without = laid.where(~whole).select("_row", "_record")
    out = [F.col(f"_row.{c}").alias(c) for c in rows.columns] + [F.col(f"_record.{c}").alias(c) for c in taken]
    return found.unionByName(without).select(*out)


def _all_there(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _ranges(line: DataFrame, keys: list[str], range_rows: int) -> DataFrame:
    """``line`` with _range: 0 for keys of up to ``range_rows`` rows, else the place of the row's time among cut points.

    Cut points are approximate quantiles of the times of a large key; equal times share a range.
    """
    counts = line.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > range_rows)
    large = line.join(F.broadcast(counts.select(*keys)) if _few(counts) else counts.select(*keys), keys, "left_semi")
    number = F.unix_micros(F.col("_at").cast("timestamp"))
    share = F.array(*(F.lit(i / MOST_RANGES) for i in range(1, MOST_RANGES)))
    cuts = large.groupBy(*keys).agg(F.percentile_approx(number, share, 10 * MOST_RANGES).alias("_q"), F.count("*").alias("_n"))
    step = F.greatest(F.lit(1), F.ceil(F.lit(MOST_RANGES) * range_rows / F.col("_n"))).cast("int")
    kept = F.array_distinct(F.filter(F.col("_q"), lambda x, i: (i + 1) % step == 0))
    cuts = cuts.select(*keys, kept.alias("_cuts"))
    place = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda c: c < number))
    return line.join(F.broadcast(cuts) if _few(counts) else cuts, keys, "left").withColumn("_range", place).drop("_cuts")


def _few(counts: DataFrame) -> bool:
    """Whether the large keys are few enough to share; a key holds many rows, so they hardly ever are not."""
    return len(counts.limit(1001).take(1001)) <= 1000
