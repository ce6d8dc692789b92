"""Question answering context: retrieve chunks, build the prompt, keep the chat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.chunking import chunk_fixed, chunk_recursive
from touchline.operators.embedding import hashed_vectors
from touchline.operators.neighbours import nearest
from touchline.operators.reconcile import additions
from touchline.sources.tables import read_parquet_optional, stored


def retrieve(
    chunks: DataFrame, questions: DataFrame, question_id: str = "item_id",
    question: str = "text", k: int = fv.RETRIEVED_CHUNKS,
) -> DataFrame:
    """Best ``k`` chunks (doc_id, seq) for each question, by cosine of hashed counts."""
    return nearest(
        hashed_vectors(chunks, "chunk"),
        hashed_vectors(questions.select(question_id, question), question),
        ["doc_id", "seq"], [question_id], k=k, metric="cosine",
    )


def assemble_prompt(
    ranked: DataFrame, documents: DataFrame, questions: DataFrame,
    question_id: str = "item_id", question: str = "text",
) -> DataFrame:
    """One prompt per question: its chunks in rank order, then the question.

    The ranking is stored, because both the documents and the chunks are matched
    against it; being small it is broadcast, and only documents with a hit are
    cut again. It holds at most ``k`` rows per question, so the context
    collected for a question is bounded.
    """
    hits = stored(ranked.select(question_id, "doc_id", "seq", "rank"), "ranked_chunks")
    chunks = chunk_fixed(documents.join(hits.select("doc_id"), "doc_id", "left_semi"))
    context = (
        chunks.join(hits, ["doc_id", "seq"])
        .groupBy(question_id)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "chunk"))).alias("_hits"))
        .select(
            question_id,
            F.size("_hits").alias("n_chunks"),
            F.array_join(F.transform("_hits", lambda h: h["chunk"]), "\n\n").alias("context"),
        )
    )
    return (
        context.join(questions.select(question_id, F.col(question).alias("question")), question_id)
        .withColumn("prompt", fill_prompt(F.col("context"), F.col("question")))
    )


def fill_prompt(context: Column, question: Column) -> Column:
    before, rest = fv.PROMPT_TEMPLATE.split("{context}")
    between, after = rest.split("{question}")
    return F.concat(F.lit(before), context, F.lit(between), question, F.lit(after))


def new_documents(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Documents whose id the collection does not have yet.

    Ids are compared first and the new ones stored. Texts are then picked by a
    side of known size, which is broadcast when few documents are new, so
    the texts need not be shuffled.
    """
    ids = stored(additions(documents.select("doc_id"), known, ["doc_id"]), "new_documents")
    return documents.join(ids, "doc_id", "left_semi")


def incremental_chunks(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Chunks of the documents that are new to the collection."""
    return chunk_fixed(new_documents(documents, known))


INDEX_SCHEMA = "doc_id STRING, seq INT, chunk STRING, vector ARRAY<FLOAT>"


def index_rows(documents: DataFrame) -> DataFrame:
    """Chunks with their vectors, as kept in a collection."""
    texts = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    return hashed_vectors(chunk_recursive(texts), "chunk")


def extend_index(documents: DataFrame, path: str) -> None:
    """Add documents to the collection at ``path``; documents it has are left alone."""
    spark = documents.sparkSession
    known = read_parquet_optional(spark, path, INDEX_SCHEMA).select("doc_id").distinct()
    texts = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    index_rows(new_documents(texts, known)).write.mode("append").parquet(path)


def search_index(
    spark: SparkSession, path: str, questions: DataFrame, question_id: str = "item_id",
    question: str = "text", k: int = fv.RETRIEVED_CHUNKS,
) -> DataFrame:
    """Best ``k`` chunks of a stored collection for each question."""
    return nearest(
        read_parquet_optional(spark, path, INDEX_SCHEMA),
        hashed_vectors(questions.select(question_id, question), question),
        ["doc_id", "seq"], [question_id], k=k, metric="cosine",
    )


def chat_history(messages: DataFrame, block: int = 1024) -> DataFrame:
    """Messages numbered from 1 in turn order within each conversation.

    Numbering is done per block of turns and shifted by the size of the blocks
    before it, so a conversation of any length is spread over many tasks. Messages
    without a turn come first, in a block of their own; those without a conversation
    form one.
    """
    blocked = messages.withColumn("_block", F.floor(F.col("turn") / block))
    sizes = blocked.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "conv_id", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text")
    numbered = blocked.withColumn("_pos", F.row_number().over(within)).alias("m")
    same = F.col("m.conv_id").eqNullSafe(F.col("o.conv_id")) & F.col("m._block").eqNullSafe(F.col("o._block"))
    return (
        numbered.join(offsets.alias("o"), same)
        .select(
            "m.conv_id",
            (F.col("_pos") + F.col("_offset")).cast("bigint").alias("position"),
            "turn", "role", "text",
        )
    )
