import numpy as np
import pytest
from conftest import rows

from touchline.operators import vector_index
from touchline.operators.neighbours import nearest

SCHEMA = "id long, vector array<float>"


def clustered(seed, n, dims=16, mean=0.0):
    rng = np.random.default_rng(seed)
    hubs = rng.standard_normal((20, dims))
    return (hubs[rng.integers(0, 20, n)] + 0.2 * rng.standard_normal((n, dims)) + mean).astype(np.float32)


def frame(spark, matrix, start=0):
    return spark.createDataFrame([(start + i, v.tolist()) for i, v in enumerate(matrix)], SCHEMA).repartition(4)


def brute(corpus, asked, k, metric):
    x, q = corpus.astype(float), asked.astype(float)
    if metric == "l2":
        d = ((q[:, None] - x[None]) ** 2).sum(2)
    else:
        norm = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None]
        d = 1 - np.divide(q @ x.T, norm, out=np.zeros((len(q), len(x))), where=norm > 0)
    return {(i, int(j), r) for i in range(len(q)) for r, j in enumerate(np.lexsort((np.arange(len(x)), np.round(d[i], 9)))[:k], 1)}


@pytest.mark.parametrize("metric, mean", [("l2", 0.0), ("cosine", 0.0), ("cosine", 2.0)])
def test_search_is_exact_and_measures_few_pairs(spark, tmp_path, metric, mean):
    corpus, asked = clustered(1, 1500, mean=mean), clustered(1, 120, mean=mean)
    corpus[7:12] = corpus[6]  # equal vectors rank by id
    index = vector_index.build_index(frame(spark, corpus), str(tmp_path / "i"), ["id"], metric=metric, share_rows=40)
    questions = frame(spark, asked).withColumnRenamed("id", "q")
    measured = spark.sparkContext.accumulator(0)
    found = vector_index.search(index, questions, ["q"], 5, measured=measured, share_questions=10)
    assert {(r["q"], r["id"], r["rank"]) for r in found.collect()} == brute(corpus, asked, 5, metric)
    assert 0 < measured.value < 0.5 * len(corpus) * len(asked)


def test_probing_recall(spark, tmp_path):
    corpus, asked = clustered(3, 2000), clustered(3, 100)
    index = vector_index.build_index(frame(spark, corpus), str(tmp_path / "i"), ["id"])
    questions = frame(spark, asked).withColumnRenamed("id", "q")
    exact = vector_index.search(index, questions, ["q"], 5)
    probes = vector_index.cells_to_probe(index, questions.where("q < 40"), ["q"], 5)
    assert probes < len(index.cells) / 2
    few = vector_index.search(index, questions, ["q"], 5, probes=probes)
    assert 0.9 <= vector_index.recall(exact, few, ["q", "id"]) <= 1.0
    assert vector_index.recall(exact, exact, ["q", "id"]) == 1.0


def test_only_visited_cells_are_read(spark, tmp_path):
    corpus = clustered(4, 400)
    index = vector_index.build_index(frame(spark, corpus), str(tmp_path / "i"), ["id"], cells=20)
    one = int(index.cells["cell"][0])
    plan = index.rows.where(f"cell in ({one})")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan.replace("PartitionFilters: [cell", "PartitionFilters: [isnotnull(cell")
    assert sorted(r["id"] for r in index.rows.collect()) == list(range(400))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_unusable_and_zero_vectors(spark, tmp_path, metric):
    given = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [0.0, 1.0]), (6, [float("inf"), 0.0]),
             (7, [0.0, 0.0]), (8, [-1.0, 0.0])]
    corpus = spark.createDataFrame(given, SCHEMA)
    good = corpus.where("id in (0, 1, 5, 7, 8)")
    index = vector_index.build_index(corpus, str(tmp_path / "i"), ["id"], metric=metric)
    found = vector_index.search(index, corpus.withColumnRenamed("id", "q"), ["q"], 4)
    expected = nearest(good, good.withColumnRenamed("id", "q"), ["id"], ["q"], k=4, metric=metric)
    assert rows(found.select("q", "id", "rank")) == rows(expected.select("q", "id", "rank"))


def test_empty_sides(spark, tmp_path):
    some, none = frame(spark, clustered(5, 3)), spark.createDataFrame([], SCHEMA)
    index = vector_index.build_index(some, str(tmp_path / "a"), ["id"])
    assert vector_index.search(index, none.withColumnRenamed("id", "q"), ["q"]).count() == 0
    assert vector_index.search(index, some.withColumnRenamed("id", "q"), ["q"], 5).count() == 9
    empty = vector_index.build_index(none, str(tmp_path / "b"), ["id"])
    assert vector_index.search(empty, some.withColumnRenamed("id", "q"), ["q"]).count() == 0


def test_few_rows_meet_many_questions_at_once(spark, tmp_path):
    from pyspark.accumulators import AccumulatorParam

    class Calls(AccumulatorParam):
        def zero(self, value):
            return (0, 0)

        def addInPlace(self, a, b):  # noqa: N802
            calls, pairs = b if isinstance(b, tuple) else (1, b)
            return (a[0] + calls, a[1] + pairs)

    corpus, asked = clustered(6, 100), clustered(6, 600)
    index = vector_index.build_index(frame(spark, corpus), str(tmp_path / "i"), ["id"], cells=1)
    measured = spark.sparkContext.accumulator((0, 0), Calls())
    found = vector_index.search(index, frame(spark, asked).withColumnRenamed("id", "q"), ["q"], 4, measured=measured)
    assert {(r["q"], r["id"], r["rank"]) for r in found.collect()} == brute(corpus, asked, 4, "l2")
    assert measured.value[0] <= 4


def test_a_question_is_sent_to_regions_not_to_cells(spark, tmp_path):
    corpus = np.random.default_rng(7).standard_normal((900, 16)).astype(np.float32)  # no clusters: all cells are visited
    given = frame(spark, corpus)
    index = vector_index.build_index(given, str(tmp_path / "i"), ["id"], cells=30, share_rows=300)
    regions = index.cells.groupby("region")["n"].sum()
    assert len(index.cells) > 20 and 3 <= len(regions) <= 8 and regions.max() <= 300
    going = given.selectExpr("id as q", "vector as _qv", "double('inf') as _limit")
    sent = vector_index._visits(index, going, 4, 2, None, ["q long", "_qv array<float>"])
    assert sent.count() <= 900 * len(regions)
    assert dict(sent.dtypes)["_qv"] == "array<float>"


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e20])
def test_sizes_of_vectors_and_equal_vectors(spark, tmp_path, scale):
    corpus = clustered(8, 300).astype(float) * scale
    corpus[50:200] = corpus[50]
    schema = "id long, vector array<double>"
    given = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], schema).repartition(4)
    index = vector_index.build_index(given, str(tmp_path / "i"), ["id"], share_rows=100)
    found = vector_index.search(index, given.withColumnRenamed("id", "q"), ["q"], 4).collect()
    d = (((corpus[:, None] - corpus[None]) / scale) ** 2).sum(2)
    want = {(i, int(j), r) for i in range(300) for r, j in enumerate(np.lexsort((np.arange(300), np.round(d[i], 9)))[:4], 1)}
    assert {(r["q"], r["id"], r["rank"]) for r in found} == want
