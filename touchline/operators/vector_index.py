"""Nearest neighbours through a partitioned index, exact or by a few probes.

The corpus is cut into cells around centres learnt from a sample. The index is a table
partitioned by cell that keeps each vector's distance to its centre; what it knows about
cells (centre, rows, nearest and farthest vector) is one small row each. A question goes
to its closest cells first. By the triangle inequality a cell cannot hold anything nearer than
the question's distance to its centre less the farthest vector of the cell (or than the nearest one
less that distance), so exact search ends for a question as soon as its k-th distance rules the
other cells out; only the rest goes on to further cells, several times as many and then to all that are
left. Probing stops after a number of cells instead.

Cells that are neighbours make up a region of about as many rows as a task takes at once. A question is sent
to a region once, with the cells it visits there, so what is moved grows with the regions and not with the cells.

Cosine is searched on unit vectors, whose Euclidean distances order alike. Reported distances
are always measured on the given vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.measures import exact_distances, matrix
from touchline.sources.files import remove_folders
from touchline.sources.tables import stored

#: Vectors that centres are learnt from, and passes over them.
SAMPLE, PASSES = 20_000, 10
MOST_CELLS = 4_096
#: Rows of a region, and questions, that meet in one task.
SHARE_ROWS, SHARE_QUESTIONS = 32_000, 32_000
#: Questions of like distance to a centre that share a window of its rows; more of them, up to so many pairs with the
#: rows of a share, where few rows make the calls dearer than the pairs.
BESIDE, PAIRS_AT_ONCE = 64, 1_000_000
#: So many times more cells are visited in the second round; the third has all that are left.
GROWTH = 16
#: Distances from questions to centres that a task holds at once.
ROUTED_AT_ONCE = 1_000_000
#: Vectors without length have cosine 0 to all, so they are kept apart in a cell of their own.
NO_LENGTH = -1


@dataclass
class VectorIndex:
    """``rows``: id columns, vector, cell, distance to its centre (r), partitioned by cell. ``cells``: a row for a cell,
    with its region and, where a cell is larger than a region, the shares that its rows are dealt to."""

    rows: DataFrame
    cells: pd.DataFrame
    ids: list[str]
    metric: str


def usable(vector: str | Column) -> Column:
    """True for vectors that distances can be measured to: not null, without null or non-finite parts."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return column.isNotNull() & F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def build_index(corpus: DataFrame, path: str, ids: Sequence[str], vector: str = "vector", metric: str = "l2",
                cells: int | None = None, share_rows: int = SHARE_ROWS) -> VectorIndex:
    """Index of all usable vectors of ``corpus``, written to ``path``.

    ``cells`` defaults to the root of the number of rows, MOST_CELLS at most; centres are learnt from about SAMPLE
    vectors. A cell with many rows is written, and searched, in shares of about ``share_rows``; small cells are searched
    together, in regions of as many rows.
    """
    made: list[str] = []
    given = stored(corpus.where(usable(vector)).select(*ids, _narrow(corpus, vector).alias("vector")), "vectors", made)
    n = given.count()
    centres = _centres(given, n, cells or int(min(MOST_CELLS, max(1, n ** 0.5))), metric, made)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields)
    shared = given.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, r = _closest(_placed(matrix(batch["vector"]), metric), shared.value, metric)
            yield batch.assign(cell=cell, r=r)

    placed = stored(given.mapInPandas(assign, f"{kinds}, cell int, r double"), "placed_vectors", made)
    known = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high"))
    table = known.toPandas().sort_values("cell", ignore_index=True)  # a row for a cell, MOST_CELLS at most
    table["centre"] = [centres[c] if c != NO_LENGTH else None for c in table["cell"]]
    table["shares"] = table["n"] // share_rows + 1
    table["region"] = _regions(table, share_rows)
    shares = given.sparkSession.createDataFrame([(int(c), int(s)) for c, s in zip(table["cell"], table["shares"])], "cell int, _shares int")
    dealt = placed.join(F.broadcast(shares), "cell").withColumn("share", F.pmod(F.xxhash64(*ids), F.col("_shares")).cast("int"))
    (dealt.drop("_shares").repartition("cell", "share").sortWithinPartitions("cell", "share", "r")
     .write.partitionBy("cell").parquet(path))
    remove_folders(given.sparkSession, made)
    rows = given.sparkSession.read.schema(f"{kinds}, r double, share int, cell int").parquet(path)
    return VectorIndex(rows, table, list(ids), metric)


def _narrow(df: DataFrame, vector: str) -> Column:
    """The vector as it is stored and sent: single precision if it was given so, else double."""
    single = df.select(vector).schema[0].dataType.simpleString() == "array<float>"
    return F.col(vector) if single else F.col(vector).cast("array<double>")


def _regions(table: pd.DataFrame, share_rows: int) -> np.ndarray:
    """Number of the region of each cell: halves of halves along the widest axis, until ``share_rows`` rows or one cell are left."""
    out, next_, sizes = np.zeros(len(table), np.int64), 0, table["n"].to_numpy()
    real = np.flatnonzero(table["cell"].to_numpy() != NO_LENGTH)
    out[table["cell"].to_numpy() == NO_LENGTH] = -1
    centres = np.stack(table["centre"].to_numpy()[real]) if len(real) else None
    parts = [np.arange(len(real))] if len(real) else []
    while parts:
        part = parts.pop()
        if len(part) == 1 or sizes[real[part]].sum() <= share_rows:
            out[real[part]] = next_
            next_ += 1
            continue
        part = part[np.argsort(centres[part, np.argmax(centres[part].var(0))], kind="stable")]
        rows = sizes[real[part]].cumsum()
        half = min(max(1, int(np.searchsorted(rows, rows[-1] / 2)) + 1), len(part) - 1)
        parts += [part[:half], part[half:]]
    return out


def _centres(given: DataFrame, n: int, cells: int, metric: str, made: list[str]) -> np.ndarray:
    if not n:
        return np.zeros((0, 0))
    length = F.sqrt(F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
    sample = given.sample(min(1.0, 1.2 * SAMPLE / n), seed=1).select("vector", length.alias("_length"))
    if metric == "cosine":
        sample = sample.where("_length > 0").withColumn("vector", F.transform("vector", lambda x: x / F.col("_length")))
    features = stored(sample.select(array_to_vector("vector").alias("features")), "sampled_vectors", made)
    if not features.limit(1).count():
        return np.zeros((1, given.select(F.size("vector")).first()[0]))
    model = KMeans(k=max(2, cells), maxIter=PASSES, seed=1, initMode="random").fit(features)
    return np.unique(np.array(model.clusterCenters()), axis=0)


def _placed(x: np.ndarray, metric: str) -> np.ndarray:
    """Vectors as they are searched: unit vectors for cosine, zero where there is no length."""
    if metric != "cosine" or not x.size:
        return x
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all centres."""
    if not x.size or not centres.size:
        return np.zeros((len(x), len(centres)))
    return np.stack([np.sqrt(((x - c) ** 2).sum(1)) for c in centres], axis=1)


def _closest(x: np.ndarray, centres: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    apart = _apart(x, centres)
    cell = apart.argmin(1).astype(np.int32)
    r = apart[np.arange(len(x)), cell]
    if metric == "cosine":
        cell[~x.any(1)] = NO_LENGTH
        r[~x.any(1)] = 0.0
    return cell, r


def route(x: np.ndarray, index: VectorIndex) -> tuple[np.ndarray, np.ndarray]:
    """For each question: cells in order of visit (places in ``index.cells``), and the least distance that each may hold.

    Distances to centres come from a matrix product, and from each bound is taken what that may be off.
    """
    table, cosine = index.cells, index.metric == "cosine"
    real = table["cell"].to_numpy() != NO_LENGTH
    apart, off = np.full((len(x), len(table)), np.inf), np.zeros((len(x), 1))
    if real.any() and x.size:
        centres = np.stack(table["centre"][real].to_list())
        qq, cc = (x * x).sum(1)[:, None], (centres * centres).sum(1)[None, :]
        apart[:, real], off = np.maximum(qq + cc - 2.0 * (x @ centres.T), 0.0), 1e-12 * (1.0 + qq + cc.max())
    high, low = table["high"].to_numpy(), table["low"].to_numpy()
    least = np.maximum(np.maximum(np.sqrt(np.maximum(apart - off, 0.0)) - high, low - np.sqrt(apart + off)), 0.0)
    if cosine:  # cosine 0 is a distance of the root of 2 between unit vectors
        least[:, ~real] = np.sqrt(2.0)
        least[~x.any(1)] = np.sqrt(2.0)
    # of cells that may hold equally near rows the one with the closer centre comes first
    order = np.argsort(least + 1e-3 * np.sqrt(np.minimum(apart, 1e30)), axis=1, kind="stable")
    return order, np.take_along_axis(least, order, 1)


def search(index: VectorIndex, questions: DataFrame, question_id: Sequence[str], k: int = fv.RETRIEVED_CHUNKS,
           vector: str = "vector", probes: int | None = None, measured: Accumulator | None = None,
           share_questions: int = SHARE_QUESTIONS) -> DataFrame:
    """Rows (question id, corpus id, distance, rank) with rank 1..k, as ``neighbours.nearest`` gives them.

    Without ``probes`` the result is exact: all rounds are run until no question may gain from another cell.
    With it each question visits so many cells (more, until those hold ``k`` rows). ``measured`` is
    increased by the number of pairs that were compared. Unusable vectors are near nothing; equal distances rank by id.
    """
    qid, cid = list(question_id), index.ids
    spark, made, kept = questions.sparkSession, [], []
    asked = stored(questions.where(usable(vector)).select(*qid, _narrow(questions, vector).alias("_qv")), "questions", made)
    kinds = lambda df, names: [f"{c} {df.schema[c].dataType.simpleString()}" for c in names]
    found_schema = ", ".join(kinds(asked, qid) + kinds(index.rows, cid) + ["distance double"])
    best = spark.createDataFrame([], found_schema)
    if not len(index.cells):
        return best.withColumn("rank", F.lit(0))
    order = Window.partitionBy(*qid).orderBy("distance", *cid)
    limits = asked.select(*qid).withColumn("_limit", F.lit(float("inf"))).limit(0)
    for step in range(1 if probes else 3):
        going = asked.join(limits, qid, "left").fillna({"_limit": float("inf")})
        visits = _visits(index, going, k, step, probes, kinds(asked, [*qid, "_qv"]))
        per_region = {r["region"]: r["count"] for r in visits.groupBy("region").count().collect()}  # a row for a region
        if per_region:
            found = _measure(index, visits, per_region, qid, cid, k, found_schema, measured, share_questions)
            ranked = best.unionByName(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best, earlier, kept = stored(ranked.drop("rank"), "nearest", later := []), kept, later
            remove_folders(spark, earlier)
            worst = F.max("distance") if index.metric == "l2" else F.max("distance") * 2
            limits = best.groupBy(*qid).agg(F.count("*").alias("_n"), F.sqrt(worst).alias("_limit")).where(F.col("_n") >= k).drop("_n")
    remove_folders(spark, made)
    return best.withColumn("rank", F.row_number().over(order))


def _visits(index: VectorIndex, going: DataFrame, k: int, step: int, probes: int | None, kinds: list[str]) -> DataFrame:
    """(question, its vector, limit, region, bits of its cells) for the cells of this round.

    The first round takes the cells that together hold ``k`` rows (or ``probes``), the second up to GROWTH times as many, the
    third the others.
    """
    shared = going.sparkSession.sparkContext.broadcast(index.cells)
    metric = index.metric

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = shared.value
        sizes = cells["n"].to_numpy()
        plan = VectorIndex(None, cells, [], metric)
        regions, members = _members(cells)
        at_once = max(1, ROUTED_AT_ONCE // len(cells))
        for whole in batches:
            for start in range(0, len(whole), at_once):
                batch = whole.iloc[start:start + at_once]
                order, least = route(_placed(matrix(batch["_qv"]), metric), plan)
                first = np.maximum((sizes[order].cumsum(1) < k).sum(1) + 1, probes or 1)
                low, high = ((0, first), (first, first * GROWTH), (first * GROWTH, np.full(len(batch), len(cells))))[step]
                place = np.arange(order.shape[1])
                limit = batch["_limit"].to_numpy()
                reach = limit + 1e-9 * (1.0 + np.where(np.isfinite(limit), limit, 0.0))
                q, at = np.nonzero((place >= np.reshape(low, (-1, 1))) & (place < high[:, None]) & (least <= reach[:, None]))
                visited = np.zeros((len(batch), len(cells)), bool)
                visited[q, order[q, at]] = True
                for region, own in zip(regions, members):
                    on = np.flatnonzero((bits := visited[:, own]).any(1))
                    packed = np.packbits(bits[on], axis=1)
                    if len(on):
                        yield batch.iloc[on].reset_index(drop=True).assign(region=int(region), _cells=[b.tobytes() for b in packed])

    return going.mapInPandas(run, ", ".join([*kinds, "_limit double", "region int", "_cells binary"]))


def _members(cells: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """Regions, and the places in ``cells`` of the cells of each."""
    region = cells["region"].to_numpy()
    names = np.unique(region)
    return names, [np.flatnonzero(region == r) for r in names]


def _measure(index: VectorIndex, visits: DataFrame, per_region: dict[int, int], qid: list[str], cid: list[str], k: int,
             schema: str, measured: Accumulator | None, share_questions: int) -> DataFrame:
    """Best ``k`` rows of every region visited, for every question that visits it.

    Only the partitions of cells in visited regions are read. Shares of a region's rows meet blocks of its questions, so a
    group is bounded on both sides.
    """
    metric, spark = index.metric, visits.sparkSession
    names, members = _members(index.cells)
    cells = {int(r): index.cells.iloc[m] for r, m in zip(names, members) if int(r) in per_region}
    # Two frames, as the sides of a cogroup must not share columns; one has a row for a cell, one for a region.
    blocks = {r: n // share_questions + 1 for r, n in per_region.items()}
    parts = spark.createDataFrame([(int(c), r, blocks[r]) for r, own in cells.items() for c in own["cell"]], "cell int, region int, _blocks int")
    dealt = spark.createDataFrame([(r, blocks[r], int(own["shares"].max())) for r, own in cells.items()], "region int, _blocks int, _shares int")
    rows = (index.rows.where(F.col("cell").isin([int(c) for own in cells.values() for c in own["cell"]])).join(F.broadcast(parts), "cell")
            .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks"))
    asked = (visits.join(F.broadcast(dealt), "region").withColumn("_block", F.pmod(F.xxhash64(*qid), F.col("_blocks")).cast("int"))
             .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).drop("_blocks", "_shares"))
    group = ["region", "share", "_block"]
    shared = spark.sparkContext.broadcast(cells)
    columns = [n.split()[0] for n in schema.split(", ")]

    def meet(have: pa.Table, want: pa.Table) -> pa.Table:
        if not have.num_rows or not want.num_rows:
            types = [*((want if c in qid else have).schema.field(c).type for c in columns[:-1]), pa.float64()]
            return pa.table([pa.array([], t) for t in types], names=columns)
        q, r, distance = _nearest(have, want, shared.value[have["region"][0].as_py()], cid, k, metric, measured)
        found = [(want if c in qid else have)[c].take(pa.array(q if c in qid else r)) for c in columns[:-1]]
        return pa.table([*found, pa.array(distance)], names=columns)

    return rows.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(meet, schema)


def _flat(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows of a matrix."""
    n = len(vectors)
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _nearest(have: pa.Table, want: pa.Table, cells: pd.DataFrame, cid: list[str], k: int, metric: str,
             measured: Accumulator | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``want``, place in ``have``, distance) of the ``k`` rows nearest to each question, of its cells and within its limit.

    A matrix product rules most pairs out, the others are measured exactly; no more than PAIRS_AT_ONCE are held.
    """
    x, y = _flat(have["vector"]), _flat(want["_qv"])
    cell, r = have["cell"].to_numpy(), have["r"].to_numpy()
    by_cell = np.lexsort((r, cell))
    x, cell, r = x[by_cell], cell[by_cell], r[by_cell]
    ids = pc.sort_indices(have.select(cid).take(pa.array(by_cell)), [(c, "ascending") for c in cid], null_placement="at_start").to_numpy()
    id_rank = np.empty(len(ids), np.int64)
    id_rank[ids] = np.arange(len(ids))
    visited = np.unpackbits(np.frombuffer(b"".join(want["_cells"].to_pylist()), np.uint8).reshape(len(y), -1), axis=1)
    reach = want["_limit"].to_numpy()
    placed = _placed(y, metric)
    # A pair is near if the product of ``a`` and ``b`` is large: cosine, or the part of the squared distance that both sides make.
    # In single precision, unless squares might not fit, each of the terms may be off by ``unit``.
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    kind = np.float32 if max(xx.max(), yy.max()) < 1e30 else np.float64
    unit = (1e-7 if kind is np.float32 else 1e-15) * (x.shape[1] + 8)
    if metric == "cosine":
        a, b = placed, _placed(x, metric)
        bound, slack = reach ** 2 * 0.5 * (1 + 1e-9) + 1e-12, np.full(len(y), 1e-9 + 2 * unit)
        floor = lambda most: 1.0 - most
    else:
        a, b = np.column_stack([y, np.ones(len(y))]), np.column_stack([x, -0.5 * xx])
        bound, slack = reach ** 2 * (1 + 1e-9) + 1e-12, 1e-9 + (1e-9 + 2 * unit) * (yy + xx.max())
        floor = lambda most: 0.5 * (yy - most)
    a, b = np.ascontiguousarray(a, kind), np.ascontiguousarray(b, kind)
    blank = ~placed.any(1)
    pool: list[list[np.ndarray]] = [[], [], []]

    def kept() -> None:
        """Keeps the ``k`` nearest of the pool for each question, and lowers its bound to the k-th."""
        q, at, d = (np.concatenate(p) if p else np.zeros(0, t) for p, t in zip(pool, (np.int64, np.int64, np.float64)))
        order = np.lexsort((id_rank[at], d, q))
        q, at, d = q[order], at[order], d[order]
        new = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
        place = np.arange(len(q)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(q))))
        bound[q[place == k - 1]] = np.minimum(bound[q[place == k - 1]], d[place == k - 1])
        on = place < k
        pool[:] = [[q[on]], [at[on]], [d[on]]]

    waiting, room = 0, max(PAIRS_AT_ONCE, 2 * k * len(y)) // 2
    for place, (name, centre) in enumerate(zip(cells["cell"], cells["centre"])):
        start, end = np.searchsorted(cell, [name, name + 1])
        asked = np.flatnonzero(visited[:, place])
        if start == end or not len(asked):
            continue
        apart = np.sqrt(((placed[asked] - centre) ** 2).sum(1)) if centre is not None else np.full(len(asked), np.nan)
        asked, apart = asked[order := np.argsort(apart, kind="stable")], apart[order]
        beside = max(BESIDE, PAIRS_AT_ONCE // (end - start))
        for first in range(0, len(asked), beside):
            some = asked[first:first + beside]
            rows = _window(r[start:end], reach[some], apart[first:first + beside], metric == "cosine" and blank[some].any())
            lo, hi = start + rows.start, start + rows.stop
            if measured is not None:
                measured.add((hi - lo) * len(some))
            for lo in range(lo, hi, step := max(k + 1, 4 * PAIRS_AT_ONCE // len(some))):
                near = a[some] @ b[lo:min(lo + step, hi)].T
                least = floor(bound)[some] - slack[some]
                if near.shape[1] > k and not np.isfinite(least).all():
                    least = np.maximum(least, np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k] - 2 * slack[some])
                q, at = np.divmod(np.flatnonzero(near >= least.astype(kind)[:, None]), near.shape[1])
                if not len(q):
                    continue
                for p, v in zip(pool, (some[q], at + lo, exact_distances(y[some[q]], x[at + lo], metric))):
                    p.append(v)
                waiting += len(q)
                if waiting > room:
                    kept()
                    waiting = len(pool[0][0]) if len(pool[0][0]) < room // 2 else 0
    kept()
    return pool[0][0], by_cell[pool[1][0]], pool[2][0]


def _window(r: np.ndarray, limit: np.ndarray, apart: np.ndarray, whole: bool) -> slice:
    """Rows of a cell, sorted by distance to its centre, that some of these questions may gain from."""
    if whole or not np.isfinite(limit).all() or not np.isfinite(apart).all():
        return slice(0, len(r))
    slack = 1e-9 * (1.0 + limit + apart + r[-1])
    return slice(int(np.searchsorted(r, (apart - limit - slack).min())), int(np.searchsorted(r, (apart + limit + slack).max(), "right")))


def cells_to_probe(index: VectorIndex, sample: DataFrame, sample_id: Sequence[str], k: int = fv.RETRIEVED_CHUNKS,
                   vector: str = "vector", share: float = 0.95) -> int:
    """How many cells a question must visit for ``share`` of its ``k`` nearest to be among them.

    Measured on a sample of questions, given by the caller and small: their exact neighbours are found, then
    the place of each neighbour's cell in the order of visit.
    """
    nearest = search(index, sample, sample_id, k, vector).select(*sample_id, *index.ids)
    cells = nearest.join(index.rows.select(*index.ids, "cell"), index.ids).select(*sample_id, "cell")
    asked = sample.select(*sample_id, _narrow(sample, vector).alias("_qv"))
    shared = sample.sparkSession.sparkContext.broadcast(index.cells)
    metric = index.metric

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = VectorIndex(None, shared.value, [], metric)
        for batch in batches:
            order, _ = route(_placed(matrix(batch["_qv"]), metric), plan)
            cell = plan.cells["cell"].to_numpy()[order]
            yield pd.DataFrame({"place": (cell == batch["cell"].to_numpy()[:, None]).argmax(1)})

    counts = cells.join(asked, list(sample_id)).mapInPandas(places, "place int").groupBy("place").count().toPandas()
    if not len(counts):
        return 1
    counts = counts.sort_values("place")
    reached = counts["count"].cumsum() / counts["count"].sum()
    return int(counts["place"][reached >= share].iloc[0]) + 1


def recall(exact: DataFrame, found: DataFrame, ids: Sequence[str]) -> float:
    """Share of the rows of ``exact`` that ``found`` has, both with columns ``ids``."""
    total, hit = exact.count(), exact.join(found.select(*ids), list(ids), "left_semi").count()
    return hit / total if total else 1.0
