"""Attach dimension columns to rows whose keys may be very unevenly used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of a small dimension; a hot key is spread over this many partitions.
SALTS = 8
# Rows of a joined side that the driver builds a broadcast from: some 100 MB.
MOST_BROADCAST_ROWS = 500_000


def lookup(
    rows: DataFrame, dimension: DataFrame, key: Sequence[str], vary: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Left join of ``rows`` to ``dimension`` on the equally named ``key``.

    A dimension that Spark knows to be small enough to broadcast is joined as it is.
    Else ``vary`` are columns that differ within a key. They give each row one of
    ``salts`` shares of its key, and the dimension is repeated per share, so the
    rows of a hot key, and those without a key, meet in several tasks. The share
    is part of the join key, therefore both sides are shuffled for this join and
    adaptive execution can split what is still uneven; a dimension that comes
    straight from an aggregation would otherwise keep that from happening. Use
    ``salts=1`` for a dimension too large to repeat.
    """
    if broadcastable(dimension):
        return rows.join(dimension, list(key), "left")
    share = F.pmod(F.xxhash64(*vary), F.lit(salts)).cast("int")
    shares = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        rows.withColumn("_share", share)
        .join(dimension.withColumn("_share", shares), [*key, "_share"], "left")
        .drop("_share")
    )


def bounded(side: DataFrame, most: int | None = None) -> DataFrame:
    """``side``, merged instead of broadcast by the joins it is in if it has more than ``most`` rows.

    Spark plans a broadcast from the size of files; rows that files hold in a compressed form take several times
    that in the driver, which builds the table. ``side`` is scanned for its count, so it is a table.
    """
    return side if side.count() <= (MOST_BROADCAST_ROWS if most is None else most) else side.hint("merge")


def broadcastable(df: DataFrame) -> bool:
    """True when the planned size of ``df`` is below the session's broadcast limit."""
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= most
