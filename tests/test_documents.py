import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline import fixed_values as fv
from touchline.operators import chunking, embedding, retrieval
from touchline.operators.neighbours import nearest


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def windows(text, size=1000, overlap=100):
    out, start = [], 0
    while text:
        out.append(text[start:start + size])
        start += size - overlap
        if start >= len(text) - overlap:
            return out
    return out


def test_fixed_chunks_against_slicing(spark):
    texts = ["", "a", "x" * 1000, "x" * 1001, "é" * 1900, "ab" * 950 + "c", "日本" * 70000, None, "w" * 57700, "w" * 57701]
    got = {}
    for doc, seq, chunk in chunking.chunk_fixed(docs(spark, *texts)).collect():
        got.setdefault(doc, {})[seq] = chunk
    for i, text in enumerate(texts):
        assert [got.get(i, {}).get(s) for s in range(len(got.get(i, {})))] == windows(text or "")


def test_fixed_chunks_need_no_shuffle(spark):
    plan = chunking.chunk_fixed(docs(spark, "x"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


SEPARATORS = fv.CHUNK_SEPARATORS


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=300), st.integers(5, 40), st.integers(0, 4))
def test_recursive_chunks_are_bounded_and_cover_the_text(text, size, overlap):
    chunks = chunking.split_text(text, size, overlap, SEPARATORS)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    position = 0
    for c in chunks:
        found = text.find(c, max(0, position - size))
        assert found >= 0
        position = found + len(c)
    kept = set("".join(chunks)) - {" ", "\n"}
    assert kept == set(text) - {" ", "\n"}
    if overlap == 0:
        assert "".join("".join(chunks).split()) == "".join(text.split())


@pytest.mark.parametrize("text, size, overlap, want", [
    ("aaa bbb ccc", 7, 3, ["aaa bbb", "ccc"]),
    ("aaa bbb ccc", 8, 4, ["aaa bbb", "bbb ccc"]),
    ("one\n\ntwo\n\nthree", 8, 0, ["one\n\ntwo", "three"]),
    ("abcdefghij", 4, 1, ["abcd", "defg", "ghij"]),
    ("  \n ", 10, 2, []),
])
def test_recursive_chunks(text, size, overlap, want):
    assert chunking.split_text(text, size, overlap, SEPARATORS) == want


def test_recursive_operator(spark):
    long = "word " * 500
    got = chunking.chunk_recursive(docs(spark, long, "", None, "short")).collect()
    by_doc = {d: [c for k, _, c in sorted(got) if k == d] for d in range(4)}
    assert by_doc[0] == chunking.split_text(long, 1000, 100, SEPARATORS) and len(by_doc[0]) == 3
    assert by_doc[1] == by_doc[2] == [] and by_doc[3] == ["short"]


def vectors(spark, matrix, name):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{name} bigint, vector array<float>")


def brute_force(corpus, questions, k, metric):
    c, q = np.float32(corpus).astype(float), np.float32(questions).astype(float)
    out = []
    for i, row in enumerate(q):
        if metric == "l2":
            d = ((c - row) ** 2).sum(1)
        else:
            d = 1 - (c * row).sum(1) / np.sqrt((c * c).sum(1) * (row * row).sum())
        order = sorted(range(len(c)), key=lambda j: (d[j], j))[:k]
        out += [(i, j, r + 1) for r, j in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("bounds", [{}, {"max_questions": 3, "cell_rows": 50}])
def test_nearest_is_exact_on_both_paths(spark, metric, bounds):
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(300, 8))
    corpus[100:200] = corpus[0]  # a third of the rows are copies
    questions = np.vstack([corpus[0], rng.normal(size=(9, 8))])
    got = nearest(vectors(spark, corpus, "c").repartition(5), vectors(spark, questions, "q"), ["c"], ["q"], metric=metric, **bounds)
    assert rows(got.select("q", "c", "rank")) == brute_force(corpus, questions, 4, metric)


def test_nearest_with_fewer_rows_than_k_and_no_questions(spark):
    corpus, none = vectors(spark, [[1, 0], [0, 1]], "c"), vectors(spark, [[1, 0]], "q").where("q < 0")
    assert nearest(corpus, vectors(spark, [[1, 0]], "q"), ["c"], ["q"]).count() == 2
    assert nearest(corpus, none, ["c"], ["q"]).count() == 0


def test_corpus_is_not_shuffled(spark):
    plan = nearest(vectors(spark, [[1, 0]], "c"), vectors(spark, [[1, 0]], "q"), ["c"], ["q"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.index("MapInPandas") and text.count("Exchange") == 1
    assert "WindowGroupLimit" in text


def test_hashed_vectors(spark):
    df = spark.createDataFrame([("Red red, blue!",), ("",), (None,)], "t string")
    got = [r["vector"] for r in embedding.hashed_vectors(df, "t").collect()]
    assert sorted(x for x in got[0] if x) == [1.0, 2.0] and len(got[0]) == embedding.DIMENSIONS
    assert sum(got[1]) == sum(got[2]) == 0


def test_model_slot(spark):
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    got = embedding.model_vectors(df, "t", lambda texts: np.array([[len(t), 1.0] for t in texts])).collect()
    assert [r["vector"] for r in got] == [[2.0, 1.0], [0.0, 1.0]]


def test_prompt(spark):
    documents = docs(spark, "red fox", "blue whale", "a red house with a {question} mark")
    questions = spark.createDataFrame([(1, "where is the red fox?")], "item_id bigint, text string")
    chunks = chunking.chunk_fixed(documents)
    ranked = retrieval.retrieve(chunks, questions, k=2)
    row = retrieval.assemble_prompt(ranked, documents, questions).first()
    assert row["n_chunks"] == 2 and row["context"] == "red fox\n\na red house with a {question} mark"
    assert row["prompt"].endswith("Question: where is the red fox?\nAnswer:")
    assert "Context: red fox" in row["prompt"] and "{question} mark" in row["prompt"]


def test_incremental_chunks(spark):
    new = retrieval.incremental_chunks(docs(spark, "a", "b", "c"), docs(spark, "a", "b").select("doc_id"))
    assert rows(new) == [(2, 0, "c")]


def test_chat_history_numbers_long_conversations(spark):
    data = [(1, t, "user", "x") for t in range(0, 50, 3)] + [(2, 5, "b", "y"), (2, 5, "a", "y"), (2, 900, "c", "z")]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    got = retrieval.chat_history(df, block=8)
    assert rows(got.where("conv_id = 1").select("position", "turn")) == sorted(((i + 1, t) for i, t in enumerate(range(0, 50, 3))), key=repr)
    assert rows(got.where("conv_id = 2").select("position", "role")) == [(1, "a"), (2, "b"), (3, "c")]


def test_chat_history_keeps_messages_without_turn_or_conversation(spark):
    data = [(1, None, "a", "x"), (1, 3, "b", "y"), (None, 1, "c", "z"), (None, None, None, None), (1, 3, "b", "y")]
    got = retrieval.chat_history(spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string"))
    assert rows(got.select("conv_id", "position", "turn")) == sorted(
        [(1, 1, None), (1, 2, 3), (1, 3, 3), (None, 1, None), (None, 2, 1)], key=repr)


def test_rows_without_a_vector_are_near_nothing(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "c string, vector array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "q int, vector array<float>")
    assert rows(nearest(corpus, asked, ["c"], ["q"], k=3).select("q", "c")) == [(1, "a")]


def test_nearest_with_text_ids_and_bounded_slices(spark, monkeypatch):
    from touchline.operators import measures

    monkeypatch.setattr(measures, "MAX_PAIRS", 20)
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(120, 4))
    corpus = vectors(spark, matrix, "c").selectExpr("concat('doc', lpad(c, 4, '0')) AS c", "vector")
    found = nearest(corpus, vectors(spark, matrix[:6], "q").selectExpr("concat('q', q) AS q", "vector"), ["c"], ["q"], k=3)
    want = [(f"q{q}", f"doc{c:04d}", r) for q, c, r in brute_force(matrix, matrix[:6], 3, "l2")]
    assert rows(found.select("q", "c", "rank")) == sorted(want, key=repr)


def test_collection_grows_by_new_documents_only(spark, tmp_path):
    path = str(tmp_path / "collection")
    questions = spark.createDataFrame([(1, "green turtle")], "item_id bigint, text string")
    assert retrieval.search_index(spark, path, questions).count() == 0
    retrieval.extend_index(docs(spark, "red fox", "blue whale"), path)
    retrieval.extend_index(docs(spark, "changed text", "blue whale", "green turtle"), path)
    assert rows(spark.read.parquet(path).select("doc_id", "chunk")) == [("0", "red fox"), ("1", "blue whale"), ("2", "green turtle")]
    best = retrieval.search_index(spark, path, questions, k=1).first()
    assert (best["doc_id"], best["seq"], best["rank"]) == ("2", 0, 1)
    retrieval.extend_index(docs(spark, "red fox"), path)
    assert spark.read.parquet(path).count() == 3
