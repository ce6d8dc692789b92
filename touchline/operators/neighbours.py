"""Exact nearest neighbours of question vectors in a corpus of vectors.

The corpus never moves when the questions fit in memory: every task scans its
own rows against all questions, keeps ``k`` per question, and only those are
shuffled. Number and bytes of the questions are checked; above the bounds the corpus
is indexed by distance to learnt centres, and each question meets the
cells that its k-th distance does not rule out (``vector_index``). Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.measures import Best
from touchline.operators.vector_index import build_index, search
from touchline.session import scratch_path

MAX_BROADCAST_QUESTIONS = 20_000
MAX_BROADCAST_BYTES = 32_000_000
MAX_CELL_ROWS = 50_000


def nearest(
    corpus: DataFrame,
    questions: DataFrame,
    corpus_id: Sequence[str],
    question_id: Sequence[str],
    k: int = fv.RETRIEVED_CHUNKS,
    vector: str = "vector",
    metric: str = "l2",
    max_questions: int = MAX_BROADCAST_QUESTIONS,
    cell_rows: int = MAX_CELL_ROWS,
) -> DataFrame:
    """Rows (question id, corpus id, distance, rank) with rank 1..k.

    ``metric`` is ``l2`` (squared Euclidean) or ``cosine`` (one minus cosine).
    Equal distances rank by corpus id; ids are unique on both sides. Rows without a
    vector, on either side, are near nothing.
    """
    qid, cid = list(question_id), list(corpus_id)
    # No filter on the corpus: a condition on a column that Python computes would make Spark compute it twice.
    corpus = corpus.select(*cid, F.col(vector).alias("_cv"))
    questions = questions.where(F.col(vector).isNotNull()).select(*qid, F.col(vector).alias("_qv"))
    schema = ", ".join(
        [f"{c} {questions.schema[c].dataType.simpleString()}" for c in qid]
        + [f"{c} {corpus.schema[c].dataType.simpleString()}" for c in cid]
        + ["distance double"]
    )
    # Counted before any question comes to the driver; the rows after the limit are not read.
    bound = questions.limit(max_questions + 1).agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("_qv")), F.lit(0)).alias("width")).first()
    if bound["n"] > max_questions or bound["n"] * bound["width"] * 8 > MAX_BROADCAST_BYTES:
        index = build_index(corpus, scratch_path(corpus.sparkSession, "vector_index"), cid, "_cv", metric, share_rows=cell_rows)
        return search(index, questions, qid, k, "_qv")
    partial = _scan_corpus(corpus, questions.toPandas(), qid, cid, k, metric, schema)
    order = Window.partitionBy(*qid).orderBy("distance", *cid)
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scan_corpus(corpus, head, qid, cid, k, metric, schema) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(shared.value, qid, cid, k, metric)
        for batch in batches:
            best.add(batch[batch["_cv"].notna()])
        yield best.rows()

    return corpus.mapInPandas(run, schema)
