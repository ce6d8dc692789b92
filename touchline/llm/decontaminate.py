"""Benchmark decontamination by winnowing, in built-in functions only.

Of the k-word hashes in every window of an item's or a document's words the smallest is
kept. Equal windows keep equal hashes, so a document that holds a window of an item
shares a fingerprint with it: the join loses nothing. Around each hit a document's windows
are then read in full and joined to the items' windows by 128-bit hashes, which alone
decides. Rows are places of a document, not pairs of places: a text of one repeated word
costs as much as another of its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import cut, spread_join

WINDOW, GRAM = 13, 8
#: A document is contaminated from one hit word in so many.
SHARE = 20
#: A side of at most so many bytes, measured, is broadcast, else both are shuffled.
BROADCAST_BYTES = 64 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LONGS, _PLACES = "array<bigint>", "array<struct<p:int,hash:bigint>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` computed once, however often the body's functions refer to it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased, written as the characters of their UTF-8 bytes; none for null.

    Each byte is read as a Latin-1 character, which makes ``lower`` and the split cheap.
    That also lowers lead bytes C3-DE to E3-FE; the number of bytes that follow still
    tells the two apart, so different words stay different, and both sides do the same.
    """
    octets = F.decode(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"), "ISO-8859-1")
    return F.array_remove(F.split(F.lower(octets), _SEPARATORS), "")


def hashed(items: Column) -> Column:
    return F.transform(items, lambda w: F.xxhash64(w))


def grams(hashes: Column, window: int) -> Column:
    """Hashes of all k-word runs, in order; windows of different sizes never share one."""
    k = min(GRAM, window)
    runs = F.transform(F.sequence(F.lit(1), F.size(hashes) - F.lit(k - 1)),
                       lambda i: F.xxhash64(F.lit(window), F.slice(hashes, i, k)))
    return F.when(F.size(hashes) >= window, runs).otherwise(F.array().cast(_LONGS))


def winnow(hashes: Column, window: int) -> Column:
    """The smallest gram hash of each window, without repeats."""
    width = window - min(GRAM, window) + 1
    least = F.transform(F.sequence(F.lit(1), F.size(hashes) - F.lit(width - 1)),
                        lambda i: F.array_min(F.slice(hashes, i, width)))
    return F.when(F.size(hashes) >= width, F.array_distinct(least)).otherwise(F.array().cast(_LONGS))


def window_hash(items: Column, start: Column, length: Column) -> Column:
    """128-bit hash, as two numbers, of ``length`` words from ``start``, counted from 1."""
    return let(F.slice(items, start, length), lambda w: F.struct(F.xxhash64(w).alias("x"), F.xxhash64(F.lit("window"), w).alias("y")))


def gram_lengths(texts: DataFrame, prints: DataFrame) -> DataFrame:
    """(hash, len): the kept grams and the length of the windows that they stand for."""
    return prints.join(texts.select("_i", "len"), "_i").select("hash", "len").distinct()


def fingerprints(hashes: Column, windows: list[int]) -> Column:
    kept = [let(grams(hashes, n), lambda g: winnow(g, n)) for n in windows]
    return F.concat(F.array().cast(_LONGS), *kept)


def places(hashes: Column, windows: list[int]) -> Column:
    """(position, hash) of every gram."""
    found = [F.transform(grams(hashes, n), lambda h, i: F.struct(i.alias("p"), h.alias("hash"))) for n in windows]
    return F.concat(F.array().cast(_PLACES), *found)


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast when its values take at most BROADCAST_BYTES; a row counts 16 bytes besides."""

    def size(name: str, kind: str) -> Column:
        if kind == "string":
            return F.coalesce(F.octet_length(name), F.lit(0)).cast("long")
        if kind == "array<string>":
            return F.coalesce(F.octet_length(F.concat_ws(",", name)), F.lit(0)).cast("long") + F.coalesce(F.size(name), F.lit(0)) * 8
        return F.lit(8).cast("long")

    total = F.sum(sum((size(n, k) for n, k in df.dtypes), F.lit(16).cast("long")))
    return F.broadcast(df) if (df.agg(total).first()[0] or 0) <= BROADCAST_BYTES else df


def _key(id_col: str, text_col: str) -> Column:
    """Repeated rows have one key, different texts under one id do not."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                       F.hex(F.xxhash64(F.col(text_col).cast("string"))))


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(_key, id_col, n_words, n_hit, items, contaminated) for every row of ``docs``.

    An item's windows are its runs of ``window`` words, the whole item if it has fewer.
    A word inside any occurrence of a window is hit; ``items`` are the sorted ids, as
    strings, of items with an occurring window; a document is contaminated when at least
    one word is hit and one word in SHARE at least. Null and empty texts have no words;
    items without words or without an id are matched but not named; repeated rows get
    equal reports; very long texts and texts of one repeated word cost time linear in their
    length; empty tables give no rows or no hits; further columns are ignored.
    """
    item_words = words(F.col(item_text_col))
    texts = cut(items.select(F.col(item_col).cast("string").alias("item"), item_words.alias("words"))
                .where(F.size("words") > 0).distinct()
                .select(F.xxhash64("item", "words").alias("_i"), "item", "words",
                        F.least(F.size("words"), F.lit(window)).alias("len")))
    windows = sorted(r["len"] for r in texts.select("len").distinct().collect())  # at most ``window`` numbers
    own = F.concat(F.array().cast(_LONGS), *[
        F.when(F.col("len") == n, let(hashed(F.col("words")), lambda h: fingerprints(h, [n]))).otherwise(F.array().cast(_LONGS))
        for n in windows])
    prints = cut(texts.select("_i", F.explode(own).alias("hash")).distinct())

    # one pass over the documents: a row for itself (hash null) and one for each shared fingerprint
    rows = docs.select(_key(id_col, text_col).alias("_key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    read = rows.select("_key", "id", let(let(words(F.col("text")), hashed), lambda h: F.struct(
        F.size(h).cast("long").alias("n"), F.concat(F.array(F.lit(0).cast("long")), fingerprints(h, windows)).alias("hashes"))).alias("r"))
    seen = read.select("_key", "id", F.col("r.n").alias("n_words"), F.posexplode("r.hashes").alias("pos", "hash"))
    wanted = prints.select("hash").union(docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("hash"))).distinct()
    seen = cut(seen.join(_small(cut(wanted)), "hash", "left_semi").select("_key", "id", "n_words", (F.col("pos") > 0).alias("shares")))
    named = _small(cut(seen.where("shares").select("_key").distinct()))
    near = cut(rows.join(named, "_key", "left_semi").dropDuplicates(["_key"]).select("_key", words(F.col("text")).alias("doc")))

    # the distinct windows of all items; windows that the same texts hold share one class
    pieces = texts.select("_i", "len", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("len") + 1), lambda i: window_hash(F.col("words"), i, F.col("len")))).alias("w"))
    of_window = pieces.groupBy("w", "len").agg(F.sort_array(F.collect_set("_i")).alias("holders"))
    of_window = cut(of_window.withColumn("class", F.xxhash64("holders")))
    classes = of_window.select("class", "holders").dropDuplicates(["class"]).select("class", F.explode("holders").alias("_i"))
    classes = cut(classes.join(texts.select("_i", "item"), "_i").select("class", "item"))
    wanted = cut(of_window.select("w", "len", "class"))

    # windows of a document around the places of its shared grams
    on_doc = near.select("_key", F.explode(let(hashed(F.col("doc")), lambda h: places(h, windows))).alias("g"))
    at = (on_doc.select("_key", F.col("g.hash").alias("hash"), F.col("g.p").alias("p"))
          .join(_small(cut(gram_lengths(texts, prints))), "hash").groupBy("_key")
          .agg(F.collect_list(F.struct("p", "len")).alias("at")))
    # begin and length in one number: ``array_distinct`` of numbers is linear, of structs it is not
    begins = F.array_distinct(F.flatten(F.transform("at", lambda x: F.transform(
        F.sequence(F.greatest(x["p"] - (x["len"] - F.least(x["len"], F.lit(GRAM))), F.lit(0)), x["p"]),
        lambda b: b.cast("long") * (window + 1) + x["len"]))))
    spans = F.transform(begins, lambda c: F.struct(F.floor(c / (window + 1)).cast("int").alias("b"), (c % (window + 1)).cast("int").alias("len")))
    spans = F.filter(spans, lambda x: x["b"] + x["len"] <= F.size("doc"))
    read_in_full = near.join(at, "_key").select("_key", F.explode(F.transform(spans, lambda x: F.struct(
        x["b"].alias("b"), x["len"].alias("len"), window_hash(F.col("doc"), x["b"] + 1, x["len"]).alias("w")))).alias("x"))
    read_in_full = read_in_full.select("_key", "x.b", "x.len", "x.w")
    shared = _small(wanted)
    if shared is wanted:  # too large to share: a common passage is dealt to many tasks
        on = F.struct("w", "len")
        met = spread_join(read_in_full.withColumn("_on", on), wanted.select(on.alias("_on"), "class"), "_on", "_key")
    else:
        met = read_in_full.join(shared, ["w", "len"])
    hits = cut(met.select("_key", "b", "len", "class"))

    # hit words: the length of the union of the windows, which lie in order
    order = F.array_sort(F.collect_list(F.struct("b", (F.col("b") + F.col("len")).alias("e"))))
    covered = F.aggregate(order, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda acc, x: F.struct(
        F.greatest(acc["end"], x["e"]).alias("end"),
        (acc["n"] + F.greatest(x["e"] - F.greatest(acc["end"], x["b"]), F.lit(0))).cast("long").alias("n")))["n"]
    count = hits.groupBy("_key").agg(covered.alias("n_hit"))
    names = (hits.select("_key", "class").distinct().join(_small(classes), "class").select("_key", "item").distinct()
             .groupBy("_key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    found = _small(cut(count.join(names, "_key")))
    out = seen.where(~F.col("shares")).select("_key", F.col("id").alias(id_col), "n_words").join(found, "_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("_key", id_col, "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not contaminated, all columns kept."""
    bad = _small(cut(report(docs, items, window, id_col, text_col).where("contaminated").select("_key").distinct()))
    bad = bad.withColumnRenamed("_key", "_bad")
    return docs.join(bad, _key(id_col, text_col) == F.col("_bad"), "left_anti")
