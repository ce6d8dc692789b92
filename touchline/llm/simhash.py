"""SimHash near-duplicates: majority fingerprints and a generalised pigeonhole search.

Fingerprints of H bits differ in few bits for texts that share most of their shingles.
To find all pairs within ``radius`` bits, the bits are cut into partitions; partition i
gets a threshold t_i of its own (-1: not searched) with sum(t_i) = radius - partitions + 1.
If a pair differed in more than t_i bits in every partition, it would differ in more than
``radius`` bits in all, so every pair meets in at least one partition: no pair is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import cut
from touchline.llm.components import components

BITS = 64
SEED = 42
#: Cost of a probed key (a shuffled row) against that of a compared candidate.
PROBE_COST, CANDIDATE_COST = 1.0, 0.05
#: Shingles hashed at once, so that a very long text stays small in memory.
BLOCK = 65_536
_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text; zero without words."""
    words = text.lower().split()  # on bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    spans = zip(starts, ends[shingle - 1:] or ends[-1:])
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    while block := [digest(joined[s:e], SEED) for s, e in itertools.islice(spans, BLOCK)]:
        octets = np.array(block, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BIT_TABLE for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint long) for every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", shingle) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fingerprint long").withColumnRenamed("id", id_col)


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and how often each pair of bits is set together, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            octets = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([*total.ravel(), n], pa.int64())], names=["k", "v"])

    sums = prints.select("fingerprint").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v"))
    values = np.zeros(BITS * BITS + 1)
    for row in sums.collect():  # one row for each pair of bits, whatever the corpus
        values[row["k"]] = row["v"]
    return int(values[-1]), values[:-1].reshape(BITS, BITS)


def correlated_groups(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, each grown from the most correlated bits."""
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((together / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    free, groups = set(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        group = [max(sorted(free), key=lambda b: tie[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: tie[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def key_of(bits: list[int], column: str = "fingerprint"):
    """The bits of a group, moved together; neighbouring bits move as one run."""
    runs, at = [], 0
    for _, run in itertools.groupby(enumerate(bits), lambda x: x[1] - x[0]):
        run = list(run)
        runs.append((run[0][1], at, len(run)))
        at += len(run)
    key = F.lit(0).cast("long")
    for start, to, width in runs:
        key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned(column, start).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1)), to))
    return key


def near_probability(p: np.ndarray, bits: list[int], radius: int) -> list[float]:
    """Chance that two rows differ in at most t = 0..radius of the bits, taken as independent."""
    chance = np.array([1.0] + [0.0] * radius)
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        chance = chance * (1 - q) + np.concatenate([[0.0], chance[:-1]]) * q
    return list(np.cumsum(chance))


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least sum of costs[i][t_i + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t1, c in enumerate(row):
                if (key := used + t1 - 1) not in step or cost + c < step[key][0]:
                    step[key] = (cost + c, [*chosen, t1 - 1])
        best = step
    return best[total]


def plan_search(prints: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is searched, the cheapest way for these rows.

    For every number of partitions the equal-key pairs are counted over all rows; pairs
    at distance t are estimated from them and the chances of single bits to differ.
    """
    n, together = bit_statistics(prints)
    n = max(n, 1)  # without rows all ways cost nothing
    choices = {m: correlated_groups(together, n, m) for m in range(2, radius + 2)} if radius else {1: [list(range(BITS))]}
    keys = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), key_of(bits).alias("key"))
            for m, groups in choices.items() for i, bits in enumerate(groups)]
    met = (prints.select(F.explode(F.array(*keys)).alias("k")).groupBy("k").count()
           .groupBy("k.m", "k.i").agg(F.sum(F.col("count").cast("double") ** 2).alias("pairs")))
    pairs = {(r["m"], r["i"]): r["pairs"] for r in met.collect()}  # a row for each partition of each choice
    p = np.diag(together) / n
    plans = []
    for m, groups in choices.items():
        costs = []
        for i, bits in enumerate(groups):
            chance, row, probes = near_probability(p, bits, radius), [0.0], 0
            for t in range(radius + 1):
                probes += len(list(itertools.combinations(range(len(bits)), t)))
                candidates = max(pairs.get((m, i), 0.0), n) * chance[t] / max(chance[0], 1e-300)
                row.append(n * probes * PROBE_COST + min(candidates, float(n) ** 2) * CANDIDATE_COST)
            costs.append(row)
        cost, thresholds = allocate(costs, radius - m + 1)
        plans.append((cost, [(bits, t) for bits, t in zip(groups, thresholds) if t >= 0]))
    return min(plans, key=lambda x: x[0])[1]


def near_pairs(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b) ids of distinct fingerprints within ``radius`` bits; a pair may come more than once.

    ``prints``: (id, fingerprint), one row for a fingerprint.
    """
    search = plan_search(prints, radius)
    probes = []
    for i, (bits, t) in enumerate(search):
        masks = [sum(1 << x for x in c) for d in range(t + 1) for c in itertools.combinations(range(len(bits)), d)]
        masks = F.array(*(F.lit(m).cast("long") for m in masks))
        probes.append(F.transform(F.array(key_of(bits)), lambda k: F.transform(
            masks, lambda m: F.struct(F.lit(i).alias("part"), k.bitwiseXOR(m).alias("key"))))[0])
    exact = [F.struct(F.lit(i).alias("part"), key_of(bits).alias("key")) for i, (bits, _) in enumerate(search)]
    left = prints.select(F.col("id").alias("a"), F.col("fingerprint").alias("fa"), F.explode(F.concat(*probes)).alias("k"))
    right = prints.select(F.col("id").alias("b"), F.col("fingerprint").alias("fb"), F.explode(F.array(*exact)).alias("k"))
    left, right = left.select("a", "fa", "k.part", "k.key"), right.select("b", "fb", "k.part", "k.key")
    met = left.join(right, ["part", "key"]).where((F.col("fa") < F.col("fb"))
                                                  & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius))
    return met.select("a", "b")


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits; component_id is
    the smallest id reachable by links. Texts without words (null, empty) have the zero
    fingerprint and link like any other; repeated rows share everything. A row without
    an id takes the component of its fingerprint, null if no other row has it. An empty
    table gives an empty one; further columns are ignored.
    """
    prints = cut(fingerprints(docs, shingle, id_col, text_col))
    distinct = cut(prints.groupBy("fingerprint").agg(F.min(id_col).alias("id")).where("id is not null"))
    roots = components(near_pairs(distinct, radius), "a", "b")
    of_print = cut(distinct.join(roots, distinct["id"] == roots["node"], "left")
                   .select("fingerprint", F.coalesce("root", "id").alias("component_id")))
    return prints.join(of_print, "fingerprint", "left").select(id_col, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that have the smallest id of their near-duplicate group, all columns kept.

    Repeated rows (equal id and text) come out once. Rows without an id cannot be
    named as a copy of another and stay.
    """
    groups = near_duplicates(docs, radius, shingle, id_col, text_col)
    kept = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_kept")).distinct()
    named = docs.join(kept, docs[id_col] == kept["_kept"], "left_semi").dropDuplicates([id_col, text_col])
    return named.union(docs.where(docs[id_col].isNull()))
