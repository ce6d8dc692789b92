"""Removal of lines that many documents share.

Lines are hashed by their normalised form, distinct documents are counted for each
hash, and lines of hashes over the threshold go from all documents but one. Texts are
read twice and shuffled once, to meet what their document loses; between the two only
hashes and ids travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower, cut, hot_join

#: What is stripped at both ends of a line.
WHITE = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_keys(text: Column) -> Column:
    """The key of each line: stripped at both ends, A-Z lower-cased."""
    return F.transform(lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(WHITE)))


def hashed(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(line, n_docs, last): hashes of the keys of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold, with the largest id among these.

    Rows with one id are one document; rows without an id are not counted.
    """
    counted = _exploded(docs, min_chars, id_col, text_col).groupBy("line").agg(
        F.count_distinct("id").alias("n_docs"), F.max("id").alias("last"))
    return counted.where(F.col("n_docs") >= min_docs)


def _exploded(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(id, line): every different long line of every row that has an id."""
    long = F.filter(line_keys(F.col(text_col)), lambda key: F.length(key) >= min_chars)
    found = F.array_distinct(F.transform(long, hashed))
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode(found).alias("line"))


def without_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_lines, n_dropped, kept string) for every row of ``docs``.

    A line goes if its key has ``min_chars`` code points or more and is in ``min_docs`` documents or more,
    except in the document with the largest id among these, which keeps all its lines of that key; the
    other lines stay in their order. Null and empty texts are one empty line and stay. Rows with one id
    are one document: they count once and lose the same keys. Rows without an id are not counted and
    lose nothing. A text of any length is one row of one task. An empty table gives an empty one;
    further columns are ignored.
    """
    shared = cut(shared_lines(docs, min_chars, min_docs, id_col, text_col))
    held = _exploded(docs, min_chars, id_col, text_col)
    lost = (hot_join(held, shared, ["line"], "n_docs", "id", "inner").where("id < last")
            .groupBy("id").agg(F.collect_set("line").alias("_lost")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows without an id meet nothing: their texts spread them over the tasks of the join
    rows = rows.withColumn("_spread", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0))
    lost = lost.withColumn("_spread", F.lit(0).cast("long"))
    numbered = F.arrays_zip(lines(F.col("text")).alias("line"), line_keys(F.col("text")).alias("key"))
    stays = F.filter(numbered, lambda x: (F.length(x["key"]) < min_chars)
                     | ~F.array_contains(F.col("_lost"), hashed(x["key"])))
    kept = F.when(F.col("_lost").isNull(), lines(F.col("text"))).otherwise(F.transform(stays, lambda x: x["line"]))
    found = rows.join(lost, ["id", "_spread"], "left").select(
        F.col("id").alias(id_col), F.size(lines(F.col("text"))).cast("long").alias("n_lines"), kept.alias("_kept"))
    return found.select(id_col, "n_lines", (F.col("n_lines") - F.size("_kept")).alias("n_dropped"),
                        F.array_join("_kept", "\n").alias("kept"))
