"""Quality classifier: hashed word n-grams, logistic regression fitted by follow-the-regularised-leader.

Words are runs of letters and digits or runs of other signs, lower-cased in A-Z. Their
1-grams and 2-grams are hashed to a fixed number of buckets; a 2-gram of two equal words
has one bucket for all words. A document's value in a bucket is log(1 + count), scaled to
unit length, and its score the logistic function of the sparse dot product with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 18
BUCKETS = 1 << HASH_BITS
#: The model is fitted on at most so many labelled rows, chosen by the hash of their id.
FIT_ROWS = 8_000
#: Rows are gone through in the same order again until so many steps are made, twice at least.
STEPS, MOST_EPOCHS = 16_000, 20
#: FTRL: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
THRESHOLD = 0.7
#: Bytes of text whose features are in memory at once; a longer text is alone.
BLOCK = 2 << 20

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_BYTES >= 128)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
#: 0: white space, 1: letters and digits, 2: other signs.
_KIND = np.where(_SPACE, 0, np.where(_WORD, 1, 2)).astype(np.uint8)
_GOLD, _MIX, _PAIR = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BYTE_HASH = (_LOWER.astype(np.uint64) + np.uint64(1)) * _GOLD
_BYTE_HASH ^= _BYTE_HASH >> np.uint64(31)
_PLACE = np.cumprod(np.full(64, _MIX, np.uint64))
_SAME = np.uint64(0x5DEECE66D)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, bucket, value) of every feature of the UTF-8 ``texts``, sorted."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    empty = np.zeros(0, np.int64)
    if not len(buffer):
        return empty, empty, empty.astype(float)
    kind = _KIND[buffer]
    starts = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    place = np.arange(len(buffer)) - np.repeat(starts, np.diff(starts, append=len(buffer)))
    words = np.add.reduceat(_BYTE_HASH[buffer] * _PLACE[place & 63], starts)
    real = kind[starts] != 0
    words, starts = _mixed(words[real]), starts[real]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, "right")
    pairs = _mixed(words[:-1] * _PAIR + words[1:])
    pairs[words[:-1] == words[1:]] = _SAME
    within = doc[:-1] == doc[1:]
    grams, of = np.concatenate([words, pairs[within]]), np.concatenate([doc, doc[:-1][within]])
    key, count = np.unique((of.astype(np.int64) << HASH_BITS) | (grams * _GOLD >> np.uint64(64 - HASH_BITS)).astype(np.int64),
                           return_counts=True)
    of, value = key >> HASH_BITS, np.log1p(count)
    norm = np.sqrt(np.bincount(of, value * value, len(texts)))
    return of, key & (BUCKETS - 1), value / norm[of]


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Scores from 0 to 1; ``weights`` end with the bias."""
    parts = [np.zeros(0)]
    for block in blocks(texts):
        of, bucket, value = features(block)
        parts.append(np.bincount(of, weights[bucket] * value, len(block)) + weights[-1])
    return 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -500, 500)))


def follow_the_leader(rows: list[tuple[bytes, int]], steps: int = STEPS) -> np.ndarray:
    """Weights, the last one the bias, which has no penalty."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at):
        lasso, ridge = np.where(at == BUCKETS, 0.0, L1), np.where(at == BUCKETS, 0.0, L2)
        steep = (BETA + np.sqrt(n[at])) / ALPHA + ridge
        return np.where(np.abs(z[at]) <= lasso, 0.0, -(z[at] - np.sign(z[at]) * lasso) / steep)

    for _ in range(min(MOST_EPOCHS, max(2, steps // len(rows)))):
        for text, label in rows:
            _, at, value = features([text])
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            w = weights(at)
            slope = (1 / (1 + np.exp(-np.clip(w @ value, -500, 500))) - label) * value
            z[at] += slope - (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / ALPHA * w
            n[at] += slope * slope
    return weights(np.arange(BUCKETS + 1))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learnt from; false without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights learnt from the whole texts of up to ``fit_rows`` labelled rows that are not held out.

    One task learns, as each step follows from the last; ``fit_rows`` bounds it. Null
    labels and ids are not learnt from. Without any label nothing speaks against a row:
    all scores are 1.
    """
    usable = labels.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).orderBy(
        F.xxhash64("_id", "_y")).limit(fit_rows)
    rows = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("_t")).join(
        F.broadcast(chosen), F.col("_d") == F.col("_id"))  # fit_rows pairs of numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(t or b"", y) for b in batches for t, y in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist())]
        w = follow_the_leader(found) if found else np.append(np.zeros(BUCKETS), 1e3)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at], pa.float64())], names=["i", "w"])

    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("_id", "_y"), "_t").select("_t", "_y")
    weights = np.zeros(BUCKETS + 1, np.float32)
    for row in one.mapInArrow(run, "i int, w double").collect():  # BUCKETS rows at most
        weights[row["i"]] = row["w"]
    if not weights.any():
        weights[-1] = 1e3
    return weights


def classify(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for every row; a null text counts as empty.

    Rows are scored one by one: repeated rows get equal scores, an empty table gives an
    empty one, further columns are ignored.
    """
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, all columns kept."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores([t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()], weights)
            yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(run, docs.schema)
