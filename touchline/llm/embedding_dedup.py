"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations of the principal axes are learnt on a bounded sample so that the signs of the
rotated coordinates are balanced, faithful codes: one 64-bit word for each rotation. The
words are cut into parts, each the key of a table; a vector looks up, in every table, all
keys within a few bits of its own. Width and radius are the cheapest by costs measured on
the sample, and words are learnt until planted pairs at the least cosine meet in a table
with the share ``RECALL``: vectors that lie close together, or a larger table, get more
tables, not fewer finds. Should learnt words stop to help, random hyperplanes through the
origin follow, which part such pairs by their angle alone. Candidates are reranked by the cosine of the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import cut, spread_join
from touchline.llm.components import components

#: The rotations are learnt on at most so many vectors, chosen by the hash of their id.
FIT_ROWS, ROUNDS = 10_000, 50
BITS = 64
#: Share of the planted pairs, all exactly at the least cosine, that must meet in a table.
RECALL = 0.99
#: Planted pairs of each kind, and random pairs of the sample that tell how often unlike vectors meet.
PLANTED, UNLIKE = 4_000, 200_000
#: Keys looked up in one table at most; what a table costs besides, counted in keys.
PROBES, TABLE = 3_000, 64


class Index(NamedTuple):
    """How vectors are coded and where codes meet: ``words`` are (centre, projection), the signs of (x - centre) @ projection."""

    words: list[tuple[np.ndarray, np.ndarray]]
    width: int
    radius: int
    recall: float

    @property
    def per_word(self) -> int:
        return BITS // self.width

    @property
    def tables(self) -> int:
        return self.per_word * len(self.words)

    @property
    def masks(self) -> list[int]:
        """Differences within the radius."""
        found = [0]
        for _ in range(self.radius):
            found += [m | 1 << b for m in found for b in range(self.width)]
        return sorted(set(found))


def _rotation(low: np.ndarray, seed: int, rounds: int) -> np.ndarray:
    """BITS columns: balanced rotations of the coordinates, side by side if these are fewer than BITS."""
    blocks, size = [], low.shape[1]
    rng = np.random.default_rng(seed)
    for _ in range(-(-BITS // size)):
        rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(low @ rotation >= 0, 1.0, -1.0).T @ low)
            rotation = (u @ v).T
        blocks.append(rotation)
        rounds = 0  # few coordinates: a second learnt rotation would be the first one again
    return np.hstack(blocks)[:, :BITS]


def planted(sample: np.ndarray, least: float, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at cosine ``least``: moved in any direction, and in directions in which the sample differs."""
    rng = np.random.default_rng(seed)
    pick = lambda: sample[rng.integers(0, len(sample), PLANTED)]
    pairs = []
    for move in (rng.standard_normal((PLANTED, sample.shape[1])), pick() - pick()):
        x = pick()
        move = move - np.einsum("ij,ij->i", move, x)[:, None] * x
        size = np.linalg.norm(move, axis=1, keepdims=True)
        some = size[:, 0] > 1e-9
        y = least * x + math.sqrt(1 - least * least) * move / np.maximum(size, 1e-9)
        if some.any():
            pairs.append((x[some], y[some]))
    return pairs


def _part_distances(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Differing bits in each part of two words given as booleans."""
    per = BITS // width
    return (a != b)[:, :per * width].reshape(-1, per, width).sum(2)


def learn(sample: np.ndarray, least: float, rows: int, rounds: int = ROUNDS) -> Index:
    """The index for a table of ``rows`` vectors of which ``sample``, unit vectors, are some."""
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :BITS]
    low = centred @ axes
    pairs = planted(sample, least)
    near = [((x - mean) @ axes, (y - mean) @ axes) for x, y in pairs]
    first = _rotation(low, 0, rounds)
    bits = lambda x, rotation: x @ rotation >= 0
    rng = np.random.default_rng(2)
    left, right = (bits(low[rng.integers(0, len(low), UNLIKE)], first) for _ in range(2))

    def price(width: int, radius: int) -> float:
        """Keys looked up and codes met for a vector, with as many tables as reach the recall if tables were independent."""
        probes = sum(math.comb(width, d) for d in range(radius + 1))
        if probes > PROBES:
            return math.inf
        share = min(((_part_distances(bits(x, first), bits(y, first), width) <= radius).mean() for x, y in near), default=1.0)
        if share == 0:
            return math.inf
        meet = max((_part_distances(left, right, width) <= radius).mean(), probes / 2.0**width)
        return math.ceil(math.log(1 - RECALL) / math.log(1 - min(share, 0.999))) * (TABLE + probes + rows * meet)

    width, radius = min(((w, r) for w in (8, 10, 12, 16, 21, 32) for r in (4, 3, 2, 1, 0)), key=lambda o: price(*o))
    words: list[tuple[np.ndarray, np.ndarray]] = []
    met, recall, centred_words = [np.zeros(len(x), bool) for x, _ in pairs], 0.0, True
    while not words or recall < RECALL:
        if centred_words:
            words.append((mean, axes @ (_rotation(low, len(words), rounds) if words else first)))
        else:
            words.append((np.zeros_like(mean), np.random.default_rng(len(words)).standard_normal((len(mean), BITS))))
        centre, projection = words[-1]
        met = [m | (_part_distances(bits(x - centre, projection), bits(y - centre, projection), width) <= radius).any(1)
               for m, (x, y) in zip(met, pairs)]
        before, recall = recall, min((m.mean() for m in met), default=1.0)
        # vectors around the mean look opposite from it: from the origin, the angle of every pair is that of ``least``
        centred_words = centred_words and 1 - recall <= 0.95 * (1 - before)
    return Index(words, width, radius, float(recall))


def words_of(x: np.ndarray, index: Index) -> np.ndarray:
    """Signed 64-bit words, a column each, of unit vectors."""
    words = [np.packbits((x - centre) @ projection >= 0, axis=1, bitorder="little").view("<i8").ravel() for centre, projection in index.words]
    return np.stack(words, axis=1)


def _vectors(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # the square of a large component stays finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(rows: DataFrame, size: int, index: Index) -> DataFrame:
    """(rep, n, code) of (rep, n, v); a code is an array of words."""
    count = len(index.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(_unit(_vectors(batch.column(2), size)), index)
            code = pa.ListArray.from_arrays(np.arange(0, words.size + 1, count, dtype=np.int32), words.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code], names=["rep", "n", "code"])

    return rows.select("rep", "n", "v").mapInArrow(run, "rep long, n long, code array<long>")


def candidates(coded: DataFrame, index: Index) -> DataFrame:
    """(a, na, b, nb) with codes that meet in a table; each pair once, from the first table in which it meets."""
    width, per = index.width, index.per_word
    part = f"shiftrightunsigned({{0}}, int({{1}} % {per}) * {width}) & {(1 << width) - 1}L"
    word = "{0}[int({1} div " + str(per) + ")]"
    key = part.format(word.format("code", "t"), "t")
    dealt = coded.select("rep", "n", "code", F.explode(F.sequence(F.lit(0), F.lit(index.tables - 1))).alias("t"))
    dealt = dealt.select("rep", "n", "code", "t", F.expr(key).alias("key"))
    masks = F.array(*[F.lit(m).cast("long") for m in index.masks])
    left = dealt.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("code").alias("ca"), "t", "key", F.explode(masks).alias("mask"))
    left = left.select("a", "na", "ca", "t", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
    right = dealt.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("code").alias("cb"), "t", "key")
    differ = part.format(f"({word.format('ca', 'i')} ^ {word.format('cb', 'i')})", "i")
    earlier = F.expr(f"exists(slice(sequence(0, {index.tables - 1}), 1, t), i -> bit_count({differ}) <= {index.radius})")
    pairs = left.join(right, ["t", "key"])
    return pairs.where((F.col("a") < F.col("b")) & ~earlier).select("a", "na", "b", "nb")


def rerank(pairs: DataFrame, vectors: DataFrame, size: int, least: float) -> DataFrame:
    """Pairs whose original vectors have a cosine of ``least`` or more, in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_vectors(batch.column(i), size) for i in (4, 5))
            near = np.einsum("ij,ij->i", _unit(x), _unit(y)) >= least
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=["a", "na", "b", "nb"]).filter(pa.array(near))

    of = vectors.select("rep", "v")
    both = (pairs.join(of.withColumnsRenamed({"rep": "a", "v": "va"}), "a")
            .join(of.withColumnsRenamed({"rep": "b", "v": "vb"}), "b").select("a", "na", "b", "nb", "va", "vb"))
    return both.mapInArrow(run, "a long, na long, b long, nb long")


def near_links(reps: DataFrame, size: int, least: float) -> DataFrame:
    """(a, na, b, nb) for linked vectors of one length; ``reps``: (rep, n, v), different vectors."""
    sample = reps.orderBy(F.xxhash64("rep")).limit(FIT_ROWS).select("v").toArrow()["v"].combine_chunks()
    index = learn(_unit(_vectors(sample, size)), least, reps.count())
    return rerank(candidates(cut(codes(reps, size, index)), index), reps, size, least)


def near_duplicates(table: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row.

    Two vectors link when their cosine is at least ``least``. n_links counts the other
    vectors linked directly, component_id is the smallest id reachable, kept tells whether
    it is the vector's own. Equal vectors are searched once, so a vector with very many
    copies costs as much as one. Links at ``least`` are found with the share RECALL at least, as
    measured on planted pairs, nearer ones with a higher one. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without an id, link with nothing (component_id is
    the own id). Vectors of different lengths do not link. Repeated rows (equal id and
    vector) are one vector and get equal rows; an empty table gives an empty one.
    """
    v = F.col(vector_col)
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = table.where(usable & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()
    reps = cut(rows.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    sizes = [r["s"] for r in reps.select(F.size("v").alias("s")).distinct().collect()]  # lengths of vectors, not their number
    found = None
    for size in sizes:
        links = near_links(reps.where(F.size("v") == size), size, least)
        found = links if found is None else found.union(links)
    out = table.select(F.col(id_col), F.col(id_col).cast("long").alias("_id"))
    if found is None:
        return out.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    found = cut(found)
    copies = reps.where("n > 1")
    of_copy = cut(spread_join(rows, copies, "v", "id").select("id", "rep", "n"))
    degrees = found.select(F.col("a").alias("rep"), F.col("nb").alias("k")).union(found.select("b", "na")).groupBy("rep").agg(F.sum("k").alias("links"))
    ends = found.select("a", "b").union(of_copy.select("id", "rep"))
    roots = components(ends, "a", "b").select(F.col("node").alias("_id"), F.col("root"))
    own = degrees.select(F.col("rep").alias("_id"), "links").join(
        of_copy.select(F.col("id").alias("_id")), "_id", "left_anti").select("_id", "links")
    shared = of_copy.join(degrees, "rep", "left").groupBy(F.col("id").alias("_id")).agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    told = own.union(shared).groupBy("_id").agg(F.sum("links").alias("links"))
    out = out.join(told, "_id", "left").join(roots, "_id", "left")
    component = F.coalesce("root", "_id")
    return out.select(id_col, F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))
