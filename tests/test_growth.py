"""Work that must not grow faster than the tables: partial sums, repeated runs, repeated dimensions."""

import pytest
from conftest import DATA

from touchline.operators.asof import asof_join
from touchline.operators.neighbours import nearest
from touchline.operators.retrieval import retrieve
from touchline.plans import gold
from touchline.session import configure
from touchline.sources.files import read_documents, remove_in_tasks
from touchline.workload import gold_queries, table_queries
from touchline.workload.numeric import exact_sum


def test_partial_sums_are_small(spark):
    df = spark.createDataFrame([(1, 1.5), (1, -0.25), (2, None), (3, 2e12), (3, 1.0)], "k int, v double")
    out = df.groupBy("k").agg(exact_sum("v").alias("s"))
    assert {r["k"]: r["s"] for r in out.collect()} == {1: 1.25, 2: None, 3: 2000000000001.0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_sum" in line)
    assert partial.count("partial_") == 3 and "decimal" not in partial


def _dimensions(spark, monkeypatch, run, module=gold):
    """Plans of the dimensions that a query's lookups are given, and how often each is repeated."""
    given = []
    inner = module.lookup

    def spy(rows, dimension, key, vary, salts=8):
        given.append((dimension._jdf.queryExecution().optimizedPlan().toString(), salts))
        return inner(rows, dimension, key, vary, salts)

    monkeypatch.setattr(module, "lookup", spy)
    run(configure(spark), DATA)
    return given


@pytest.mark.parametrize("query", ["fact_matches", "fact_attendance", "bigtable"])
def test_dimensions_of_known_size(spark, monkeypatch, query):
    given = _dimensions(spark, monkeypatch, getattr(gold_queries, query))
    assert given and all("Aggregate" not in plan and "Join" not in plan for plan, _ in given)


def test_lines_are_summed_once_for_wide_tables(spark, monkeypatch):
    made = []
    inner = gold_queries.frames._line_stats
    monkeypatch.setattr(gold_queries.frames, "_line_stats", lambda *a: made.append(a) or inner(*a))
    for query in (gold_queries.bigtable, gold_queries.kpis_asof):
        query(configure(spark), DATA)
    assert len(made) == 2


def test_asof_runs_what_gives_the_rows_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    rows = spark.createDataFrame([("a", 1), ("a", 3), (None, 2), ("b", None)], "k string, at int").mapInPandas(seen, "k string, at int")
    records = spark.createDataFrame([("a", 2, 5)], "k string, since int, v int")
    out = asof_join(rows, records, ["k"], "at", "since").select("k", "at", "v")
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", 1, None), ("a", 3, 5), ("b", None, None), (None, 2, None)]
    assert runs.value == 4


def test_pairs_about_as_many_as_lines_are_not_repeated(spark, monkeypatch):
    assert [salts for _, salts in _dimensions(spark, monkeypatch, table_queries.join_left_composite, table_queries)] == [1]


def test_documents_are_listed_and_read_by_tasks(spark, tmp_path):
    for name, body in {"a/1.txt": b"x\r\ny \xc3\xa9", "a/2.md": b"no", "a/.3.txt": b"no", "_b/4.txt": b"no", "_c=1/5.txt": b"yes", "6.txt": b""}.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(body)
    made = []
    out = read_documents(spark, str(tmp_path / "in"), made=made)
    assert dict(map(tuple, out.collect())) == {"a/1.txt": "x\r\ny é", "_c=1/5.txt": "yes"}
    assert "FileScan text" not in out._jdf.queryExecution().executedPlan().toString() and made
    remove_in_tasks(spark, str(tmp_path / "in"))
    assert not (tmp_path / "in").exists()


def test_chunk_vectors_are_computed_once(spark):
    chunks = spark.createDataFrame([(1, 0, "one two"), (2, 0, "three")], "doc_id long, seq int, chunk string")
    out = retrieve(chunks, spark.createDataFrame([(7, "three two")], "item_id long, text string"))
    assert sorted((r["doc_id"], r["rank"]) for r in out.collect()) == [(1, 2), (2, 1)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_corpus_rows_without_vector_are_near_nothing(spark):
    corpus = spark.createDataFrame([(1, [1.0]), (2, None), (3, [2.0])], "id long, vector array<float>")
    found = nearest(corpus, spark.createDataFrame([(9, [2.0])], "q long, vector array<float>"), ["id"], ["q"])
    assert sorted((r["id"], r["rank"]) for r in found.collect()) == [(1, 2), (3, 1)]
