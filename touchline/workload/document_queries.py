"""Document collection: chunks, vectors, retrieval, prompts, chat."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators import chunking, embedding, retrieval, vector_index
from touchline.operators.neighbours import nearest
from touchline.session import scratch_path
from touchline.workload.registry import query
from touchline.workload.tables import read_spread, read_table


def _chunks(spark, sf):
    return chunking.chunk_fixed(read_spread(spark, sf, "documents", "doc_id"))


CHUNKS_SQL = """
chunks AS (
  SELECT doc_id, seq, substr(text, seq * 900 + 1, 1000) AS chunk
  FROM (SELECT doc_id, text, unnest(range(greatest(length(text) - 101, 0) // 900 + 1))::INT AS seq
        FROM documents WHERE length(text) > 0)
)"""


def _counts_sql(name: str, source: str, ids: str, text: str) -> str:
    """Token counts per hash bucket."""
    return f"""
{name} AS (
  SELECT {ids}, ('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n
  FROM (SELECT {ids}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM {source})
  WHERE token <> '' GROUP BY ALL
)"""


@query(f"WITH {CHUNKS_SQL} SELECT * FROM chunks")
def chunk_fixed(spark, sf):
    return _chunks(spark, sf)


@query()
def chunk_recursive(spark, sf):
    return chunking.chunk_recursive(read_spread(spark, sf, "documents", "doc_id"))


@query(f"""
WITH {CHUNKS_SQL}, {_counts_sql("counts", "chunks", "doc_id, seq", "chunk")}
SELECT c.doc_id, c.seq, coalesce(sum(n), 0)::BIGINT AS tokens, coalesce(sum(n * n), 0)::BIGINT AS squared_norm,
  coalesce(sum(n * bucket), 0)::BIGINT AS weighted, count(bucket) AS filled
FROM chunks c LEFT JOIN counts t ON c.doc_id = t.doc_id AND c.seq = t.seq GROUP BY ALL
""")
def embed_chunks(spark, sf):
    """Vectors of all chunks, shown by four figures that pin the counts down."""
    vectors = embedding.hashed_vectors(_chunks(spark, sf), "chunk").select("doc_id", "seq", "vector")
    total = F.lit(0.0)
    return vectors.select(
        "doc_id", "seq",
        F.aggregate("vector", total, lambda s, x: s + x).cast("bigint").alias("tokens"),
        F.aggregate("vector", total, lambda s, x: s + x * x).cast("bigint").alias("squared_norm"),
        F.aggregate(F.transform("vector", lambda x, i: x * i), total, lambda s, x: s + x).cast("bigint").alias("weighted"),
        F.size(F.filter("vector", lambda x: x > 0)).cast("bigint").alias("filled"),
    )


@query("""
WITH parts AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centres AS (SELECT label AS topic, i, avg(x) AS c FROM parts GROUP BY ALL),
distances AS (SELECT topic, vec_id, sum((c - x) * (c - x)) AS d FROM parts JOIN centres USING (i) GROUP BY ALL)
SELECT topic, vec_id, row_number() OVER (PARTITION BY topic ORDER BY d, vec_id)::INT AS rank FROM distances
QUALIFY rank <= 4
""")
def knn_topk(spark, sf):
    """The four vectors nearest to the centre of each topic, over all vectors."""
    vectors = read_spread(spark, sf, "embeddings", "vec_id")
    centres = (
        vectors.select(F.col("label").alias("topic"), array_to_vector("embedding").alias("v"))
        .groupBy("topic")
        .agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("embedding"))
    )
    return nearest(vectors, centres, ["vec_id"], ["topic"], vector="embedding").select("topic", "vec_id", "rank")


_NEIGHBOURS_SQL = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
distances AS (
  SELECT q.vec_id AS question, c.vec_id, sum((q.x - c.x) * (q.x - c.x)) AS d FROM parts q JOIN parts c USING (i) GROUP BY ALL)
SELECT question, vec_id, row_number() OVER (PARTITION BY question ORDER BY d, vec_id)::INT AS rank FROM distances
QUALIFY rank <= 4
"""


def _vector_index(spark, sf):
    vectors = read_spread(spark, sf, "embeddings", "vec_id").select("vec_id", F.col("embedding").alias("vector"))
    return vectors, vector_index.build_index(vectors, scratch_path(spark, "vector_index"), ["vec_id"])


@query(_NEIGHBOURS_SQL)
def knn_join_large(spark, sf):
    """The four nearest vectors of every vector, itself included: both sides large, cells left out by the triangle inequality."""
    vectors, index = _vector_index(spark, sf)
    questions = vectors.withColumnRenamed("vec_id", "question")
    return vector_index.search(index, questions, ["question"]).select("question", "vec_id", "rank")


@query("""
SELECT count(*) AS questions, (count(*) * least(4, count(*)))::BIGINT AS nearest, true AS found_nine_in_ten
FROM embeddings WHERE embedding IS NOT NULL
""")
def knn_index_recall(spark, sf):
    """Whether the index, probing as many cells as a sample asked for, finds nine in ten of the four nearest of all vectors."""
    vectors, index = _vector_index(spark, sf)
    questions = vectors.withColumnRenamed("vec_id", "question")
    sample = questions.orderBy(F.xxhash64("question"), "question").limit(100)
    found = vector_index.search(index, questions, ["question"], probes=vector_index.cells_to_probe(index, sample, ["question"]))
    hits = found.select("question", "vec_id", F.lit(1).alias("hit"))
    exact = vector_index.search(index, questions, ["question"])
    each = exact.join(hits, ["question", "vec_id"], "left").groupBy("question").agg(F.count("*").alias("n"), F.count("hit").alias("found"))
    return each.agg(F.count("*").alias("questions"), F.coalesce(F.sum("n"), F.lit(0)).alias("nearest"),
                    F.coalesce(F.sum("found") >= 0.9 * F.sum("n"), F.lit(True)).alias("found_nine_in_ten"))


RETRIEVE_SQL = f"""{CHUNKS_SQL},
{_counts_sql("chunk_counts", "chunks", "doc_id, seq", "chunk")},
{_counts_sql("question_counts", "benchmark", "item_id", "text")},
chunk_norms AS (SELECT doc_id, seq, sum(n * n)::DOUBLE AS nn FROM chunk_counts GROUP BY ALL),
question_norms AS (SELECT item_id, sum(n * n)::DOUBLE AS nn FROM question_counts GROUP BY ALL),
dots AS (
  SELECT item_id, doc_id, seq, sum(q.n * c.n)::DOUBLE AS dot
  FROM question_counts q JOIN chunk_counts c USING (bucket) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, seq, row_number() OVER (
    PARTITION BY item_id ORDER BY 1.0::DOUBLE - dot / sqrt(q.nn * c.nn), doc_id, seq)::INT AS rank
  FROM dots JOIN chunk_norms c USING (doc_id, seq) JOIN question_norms q USING (item_id)
  QUALIFY rank <= 4
)"""


@query(f"WITH {RETRIEVE_SQL} SELECT * FROM ranked")
def retrieve_chunks(spark, sf):
    """The four chunks closest to each question of the benchmark."""
    ranked = retrieval.retrieve(_chunks(spark, sf), read_table(spark, sf, "benchmark"))
    return ranked.select("item_id", "doc_id", "seq", "rank")


def _text(sql: str) -> str:
    return "'" + sql.replace("'", "''") + "'"


_BEFORE, _REST = fv.PROMPT_TEMPLATE.split("{context}")
_BETWEEN, _AFTER = _REST.split("{question}")


@query(f"""
WITH {RETRIEVE_SQL},
contexts AS (
  SELECT item_id, count(*)::INT AS n_chunks, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context
  FROM ranked JOIN chunks USING (doc_id, seq) GROUP BY item_id)
SELECT item_id, n_chunks,
  {_text(_BEFORE)} || context || {_text(_BETWEEN)} || text || {_text(_AFTER)} AS prompt
FROM contexts JOIN benchmark USING (item_id)
""")
def assemble_prompt(spark, sf):
    documents, questions = read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")
    ranked = retrieval.retrieve(_chunks(spark, sf), questions)
    return retrieval.assemble_prompt(ranked, documents, questions).select("item_id", "n_chunks", "prompt")


@query(f"""
WITH {CHUNKS_SQL} SELECT * FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def incremental_chunks(spark, sf):
    """Chunks of the documents that are new to a collection."""
    return retrieval.incremental_chunks(read_spread(spark, sf, "documents", "doc_id"), read_table(spark, sf, "labels"))


@query("""
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position, turn, role, text
FROM conversations
""")
def chat_history(spark, sf):
    return retrieval.chat_history(read_table(spark, sf, "conversations"))
