"""Ranked lexical search over a length-stratified index.

A stratum holds all documents of one length normaliser m, so within it the impact of a
term depends on its frequency alone and is computed once for each frequency. The index has
one row for a block of a stratum: its documents, its terms, and postings ordered by term and
frequency. The largest frequencies of a block bound what any of its documents can score.

A search visits the strata with the highest bounds first, which gives each question a score that
its ten best reach for sure; then all blocks, of which those bounded below that score are
left out. Results are exact. The questions are a stated set, taken in blocks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import cut
from touchline.session import scratch_path

#: Fixed value: ASCII letters and digits and all characters beyond ASCII make terms. Bytes of UTF-8.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Bytes of a text that are cut into terms at once.
PART = 1 << 20
#: Postings and documents of a block (a document with more postings is a block of its own).
POSTINGS, DOCUMENTS = 1 << 18, 1 << 13
#: An index for given questions alone is made while their different terms have at most so many bytes.
VOCABULARY_BYTES = 16_000_000
#: (question, term) pairs that tasks get at once, and questions scored at once against a block.
QUESTION_TERMS, QUESTIONS = 200_000, 256
#: Strata that a question visits first.
SEEDS = 4

_INDEX = ("m long, docs array<long>, terms array<string>, counts array<long>, tops array<int>,"
          " members array<int>, tfs array<int>")


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text, A-Z lower-cased."""
    counts, start = Counter(), 0
    while start < len(text):
        gap = GAP.search(text, start + PART)
        end = gap.start() if gap else len(text)
        counts.update(TERM.findall(text[start:end].lower()))
        start = end
    return counts


def term_rows(rows: DataFrame, id_col: str, text_col: str, only: frozenset[bytes] | None = None) -> DataFrame:
    """(id, n, terms, tfs) for rows with an id and a term; n counts all terms, ``only`` limits which are listed."""
    shared = rows.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                counts = term_counts(text.as_py())
                if not counts:
                    continue
                ids.append(i)
                sizes.append(counts.total())
                listed = counts if wanted is None else {t: c for t, c in counts.items() if t in wanted}
                terms.extend(listed)
                tfs.extend(listed.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["id", "n", "terms", "tfs"])

    given = rows.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    given = given.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "id long, n long, terms array<string>, tfs array<int>")


# --- index ------------------------------------------------------------------

@dataclass
class Index:
    """Blocks of strata, and the numbers of documents and terms behind them."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, path: str, only: frozenset[bytes] | None = None, id_col: str = "doc_id",
                text_col: str = "text", postings: int = POSTINGS, documents: int = DOCUMENTS) -> Index:
    """Index of all rows with an id and at least one term, written to ``path``.

    Each row is a document, also when ids repeat. Null and empty texts have no terms and are not
    counted; a text may be of any length. ``only`` leaves out the postings of other terms, not their
    part in the lengths. ``postings`` and ``documents`` limit a block. Rows are dealt by ranges of (m, hash), so a stratum with many documents is many blocks.
    """
    found = cut(term_rows(docs, id_col, text_col, only))
    sums = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # 75 n N may pass 64 bits, so it is a decimal
    m = F.expr(f"25 + CAST(n AS DECIMAL(19, 0)) * {75 * sums['docs']}BD div {max(sums['terms'], 1)}BD")
    dealt = (found.where("size(terms) > 0").select(m.cast("long").alias("m"), "id", "terms", "tfs")
             .repartitionByRange("m", F.xxhash64("id")).sortWithinPartitions("m"))
    blocks = dealt.mapInArrow(partial(_blocks, limits=(postings, documents)), _INDEX)
    # searches visit the strata of short documents most: dealt anew, every file has blocks of all strata
    blocks.repartition(F.xxhash64("m", F.col("docs")[0])).write.parquet(path)
    return Index(docs.sparkSession.read.schema(_INDEX).parquet(path), sums["docs"], sums["terms"])


def _blocks(batches: Iterator[pa.RecordBatch], limits: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows in order of m to blocks of one m each, of limited postings and documents."""
    held, m, postings, docs = [], None, 0, 0
    for batch in batches:
        start, of_row = 0, batch.column(0).to_numpy()
        for i, size in enumerate(pc.list_value_length(batch.column(2)).to_numpy()):
            if of_row[i] != m or postings + size > limits[0] or docs == limits[1]:
                held.append(batch.slice(start, i - start))
                yield from _inverted(m, held)
                held, m, postings, docs, start = [], of_row[i], 0, 0, i
            postings, docs = postings + size, docs + 1
        held.append(batch.slice(start))
    yield from _inverted(m, held)


def _inverted(m: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents and its postings in order of term and frequency."""
    held = [batch for batch in held if batch.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    lists, tfs = rows["terms"].combine_chunks(), rows["tfs"].combine_chunks().flatten().to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    members = np.repeat(np.arange(rows.num_rows, dtype=np.int32), pc.list_value_length(lists).to_numpy())
    order = np.lexsort((tfs, codes))
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    tops = tfs[order][np.cumsum(counts) - 1]
    one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    yield pa.RecordBatch.from_arrays([
        pa.array([m], pa.int64()), one(rows["id"].combine_chunks(), pa.int64()), one(coded.dictionary, pa.string()), one(counts, pa.int64()),
        one(tops, pa.int32()), one(members[order], pa.int32()), one(tfs[order], pa.int32())],
        names=["m", "docs", "terms", "counts", "tops", "members", "tfs"])


# --- search -----------------------------------------------------------------

def impacts(tfs: np.ndarray, m: int) -> np.ndarray:
    """What a term that occurs tf times gives in a document of normaliser m, before its weight."""
    tfs = tfs.astype(np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


class Questions:
    """Weighted terms of some questions: for each term which of them hold it, and with what weight."""

    def __init__(self, weights: pd.DataFrame):
        self.ids = np.sort(weights["item"].unique())
        number = np.searchsorted(self.ids, weights["item"].to_numpy())
        self.terms = {}
        for term, rows in weights.assign(_q=number).groupby("term"):
            self.terms[term] = (rows["_q"].to_numpy(), rows["weight"].to_numpy(np.int64))

    def bounds(self, m: int, found: list, tops: np.ndarray) -> np.ndarray:
        """For each question the most that a document of a block can score."""
        bounds = np.zeros(len(self.ids), np.int64)
        most = impacts(tops, m)
        for at, (questions, weights) in found:
            bounds[questions] += weights * most[at]
        return bounds

    def known(self, terms: list[str]) -> list:
        """(place in the block, questions and weights) of the block's terms that questions hold."""
        return [(at, self.terms[t]) for at, t in enumerate(terms) if t in self.terms]


class Best:
    """The k best documents of each question so far, and the score below which none can join them."""

    def __init__(self, k: int, reached: np.ndarray):
        self.k, self.limit = k, np.maximum(reached, 1)
        self.scores = [np.zeros(0, np.int64) for _ in reached]
        self.docs = [np.zeros(0, np.int64) for _ in reached]

    def add(self, question: int, scores: np.ndarray, docs: np.ndarray) -> None:
        enough = np.flatnonzero(scores >= self.limit[question])
        if not len(enough):
            return
        scores, docs = scores[enough], docs[enough]
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, -self.k)[-self.k]
            scores, docs = scores[keep], docs[keep]
        scores, docs = np.concatenate([self.scores[question], scores]), np.concatenate([self.docs[question], docs])
        first = np.lexsort((docs, -scores))[:self.k]
        self.scores[question], self.docs[question] = scores[first], docs[first]
        if len(first) == self.k:
            self.limit[question] = max(self.limit[question], scores[first[-1]])

    def rows(self, ids: np.ndarray) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(ids, sizes), pa.int64()), pa.array(np.concatenate([*self.docs, np.zeros(0, np.int64)]), pa.int64()),
            pa.array(np.concatenate([*self.scores, np.zeros(0, np.int64)]), pa.int64())], names=["item", "doc", "score"])


def _visit(questions: Questions, best: Best, row: dict, chosen: np.ndarray | None) -> None:
    """Score a block for the questions whose bound may reach their limit."""
    m, docs = row["m"].as_py(), row["docs"].values.to_numpy()
    found = questions.known(row["terms"].values.to_pylist())
    bounds = questions.bounds(m, found, row["tops"].values.to_numpy())
    if chosen is not None:
        bounds[~chosen] = 0
    visiting = np.flatnonzero(bounds >= best.limit)
    if not len(visiting):
        return
    ends = np.cumsum(row["counts"].values.to_numpy())
    members = row["members"].values.to_numpy()
    tfs, of_posting = np.unique(row["tfs"].values.to_numpy(), return_inverse=True)
    impact = impacts(tfs, m)[of_posting]
    for start in range(0, len(visiting), QUESTIONS):
        part = visiting[start:start + QUESTIONS]
        place = np.full(len(bounds), -1)
        place[part] = np.arange(len(part))
        scores = np.zeros((len(part), len(docs)), np.int64)
        for at, (holders, weights) in found:
            lines = place[holders]
            if (lines < 0).any():
                weights, lines = weights[lines >= 0], lines[lines >= 0]
            if len(lines):
                postings = slice(ends[at - 1] if at else 0, ends[at])
                scores[lines[:, None], members[postings]] += weights[:, None] * impact[postings]
        for question, line in zip(part, scores):
            best.add(question, line, docs)


def _scan(blocks: DataFrame, questions: Questions, k: int, reached: np.ndarray, seeds: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(item, doc, score): for every task the best documents of each question; with ``seeds`` only in the strata named for it."""
    shared = blocks.sparkSession.sparkContext.broadcast((questions, reached, seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, limit, of_stratum = shared.value
        best = Best(k, limit)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                chosen = None
                if of_stratum is not None:
                    chosen = np.zeros(len(limit), bool)
                    chosen[of_stratum.get(row["m"].as_py(), [])] = True
                _visit(asked, best, row, chosen)
        yield best.rows(asked.ids)

    if seeds is not None:
        blocks = blocks.where(F.col("m").isin([int(m) for m in seeds]))
    return blocks.mapInArrow(run, "item long, doc long, score long")


def _first_strata(blocks: DataFrame, questions: Questions) -> dict[int, np.ndarray]:
    """The strata of the highest bounds of each question: SEEDS a question at most, as stratum -> questions."""
    shared = blocks.sparkSession.sparkContext.broadcast(questions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        highest = np.zeros((0, len(asked.ids)), np.int64)
        strata = np.zeros((0, len(asked.ids)), np.int64)
        for batch in batches:
            for m, terms, tops in zip(*batch.columns):
                bound = asked.bounds(m.as_py(), asked.known(terms.values.to_pylist()), tops.values.to_numpy())
                again = np.where(strata == m.as_py(), bound, 0)
                highest = np.maximum(highest, again)
                new = np.where((strata == m.as_py()).any(0), 0, bound)
                highest, strata = np.vstack([highest, new]), np.vstack([strata, np.full(len(bound), m.as_py())])
                first = np.argsort(-highest, axis=0, kind="stable")[:SEEDS]
                highest, strata = np.take_along_axis(highest, first, 0), np.take_along_axis(strata, first, 0)
        question = np.tile(np.arange(len(asked.ids)), len(strata))
        keep = highest.ravel() > 0
        yield pa.RecordBatch.from_arrays([pa.array(question[keep], pa.int64()), pa.array(strata.ravel()[keep], pa.int64()),
                                          pa.array(highest.ravel()[keep], pa.int64())], names=["question", "m", "bound"])

    bounds = blocks.select("m", "terms", "tops").mapInArrow(run, "question long, m long, bound long")
    order = Window.partitionBy("question").orderBy(F.desc("bound"), "m")
    first = (bounds.groupBy("question", "m").agg(F.max("bound").alias("bound"))
             .withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= SEEDS))
    chosen: dict[int, list[int]] = {}
    for r in first.collect():  # SEEDS rows a question
        chosen.setdefault(r["m"], []).append(r["question"])
    return {m: np.array(q) for m, q in chosen.items()}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of each item, those with a score of 0 left out.

    Equal scores rank by ascending doc. Rows of one item count once if they are equal and else add their terms;
    items without an id, a text or a term that any document holds have no rows.
    """
    return _search(index, cut(term_rows(items.select(id_col, text_col).distinct(), id_col, text_col)), k)


def _search(index: Index, asked: DataFrame, k: int) -> DataFrame:
    spark = asked.sparkSession
    held = asked.select("id", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).groupBy(F.col("id").alias("item"), F.col("t.terms").alias("term")).agg(
        F.sum("t.tfs").alias("q"))
    df = index.blocks.select(F.inline(F.arrays_zip("terms", "counts"))).join(held.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
    df = df.groupBy(F.col("terms").alias("term")).agg(F.sum("counts").alias("df"))
    ratio = F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weights = cut(held.join(df, "term").select("item", "term", (F.col("q") * F.floor(1000 * F.log(ratio))).alias("weight")).where("weight > 0"))
    parts = weights.count() // QUESTION_TERMS + 1
    results = spark.createDataFrame([], "item long, doc long, score long, rank int")
    for part in range(parts):
        rows = weights.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).toPandas()
        if not len(rows):
            continue
        questions = Questions(rows)
        nothing = np.zeros(len(questions.ids), np.int64)
        seeds = _first_strata(index.blocks, questions)
        reached = nothing.copy()
        for r in _ranked(_scan(index.blocks, questions, k, nothing, seeds), k).where(F.col("rank") == k).collect():  # a row a question
            reached[np.searchsorted(questions.ids, r["item"])] = r["score"]
        results = results.union(_ranked(_scan(index.blocks, questions, k, reached), k))
    return results.select("item", "rank", "doc", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, id_col, score): ``search`` in an index of ``docs`` made for these items.

    While the different terms of the items are few (VOCABULARY_BYTES), the index lists only their postings; scores do
    not depend on that. Further columns are ignored; an empty table on either side gives an empty result.
    """
    asked = cut(term_rows(items.select(item_id, item_text).distinct(), item_id, item_text))
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    size = terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    only = frozenset(r["term"].encode() for r in terms.collect()) if size <= VOCABULARY_BYTES else None
    index = build_index(docs, scratch_path(docs.sparkSession, "lexical_index"), only, id_col, text_col)
    return _search(index, asked, k).select(F.col("item").alias(item_id), "rank", F.col("doc").alias(id_col), "score")
