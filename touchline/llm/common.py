"""Reading the corpus tables, cutting lineage and joining on hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import shared_dir

#: A hot key of the large side of ``spread_join`` goes to so many tasks.
SHARES = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    Spark removes the files when the frame is no longer used, if the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def spread_join(large: DataFrame, small: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` in which a hot key of ``large`` is dealt by ``by`` to SHARES tasks.

    ``small`` holds one row for a key (an aggregate), so its copies stay small.
    """
    dealt = large.withColumn("_share", F.pmod(F.xxhash64(by), F.lit(SHARES)).cast("int"))
    copies = small.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return dealt.join(copies, [key, "_share"], how).drop("_share")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else: ``lower`` alone would also change letters beyond ASCII."""
    plain = ~text.rlike(r"[^\x00-\x7F]")
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


#: A key with more than one part in HOT of all rows is hot: there are fewer than HOT of them, whatever the table.
HOT = 2_000
#: Tasks that a hot key of ``hot_join`` is dealt to.
HOT_SHARES = 64


def hot_join(large: DataFrame, small: DataFrame, keys: list[str], rows: str, by: str, how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which only the hot keys of ``large`` are dealt, by ``by``, to HOT_SHARES tasks.

    ``small`` holds one row for a key and tells in ``rows`` how many rows of ``large`` have it.
    The keys above one HOT-th of all rows, fewer than HOT by their definition, are broadcast to mark
    their rows; one shuffle then joins hot and other keys alike. ``rows`` is not in the result.
    """
    total = small.agg(F.sum(rows)).first()[0] or 0
    small = small.withColumn("_hot", F.col(rows) * HOT > total).drop(rows)
    hot = F.broadcast(small.where("_hot").select(*keys, "_hot"))
    share = F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(HOT_SHARES))).otherwise(0).cast("int")
    dealt = large.join(hot, keys, "left").withColumn("_share", share).drop("_hot")
    shares = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SHARES - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(small.withColumn("_share", F.explode(shares)).drop("_hot"), [*keys, "_share"], how).drop("_share")
