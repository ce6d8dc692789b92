import base64
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline import session
from touchline.operators import reconcile
from touchline.plans import jobs
from touchline.sources import files, sinks, tables
from touchline.streaming import feeds


@pytest.fixture
def folder(tmp_path):
    base = tmp_path / "in put+%41é"
    (base / "sub").mkdir(parents=True)
    (base / "a.txt").write_text("alpha\nbeta é")
    (base / "b.bin").write_bytes(bytes(range(256)) * 10)
    (base / "empty.txt").write_bytes(b"")
    (base / "sub" / "a.txt").write_text("nested")
    return base


def test_optional_inputs(spark, tmp_path):
    missing = str(tmp_path / "none.csv")
    assert tables.read_csv_optional(spark, missing, "a INT") is None
    frame = tables.read_parquet_optional(spark, missing, "a INT, b STRING")
    assert frame.count() == 0 and frame.dtypes == [("a", "int"), ("b", "string")]


def test_require_names_what_is_missing():
    tables.require({"matches": 1, "attendance": 1, "team_kpis": 1})
    with pytest.raises(FileNotFoundError, match="team_kpis"):
        tables.require({"matches": 1, "attendance": 1})


def test_listing(spark, folder):
    got = rows(files.list_files(spark, str(folder)).select("rel_path", "filename", "length", "is_top_level"))
    assert got == [("a.txt", "a.txt", 13, True), ("b.bin", "b.bin", 2560, True),
                   ("empty.txt", "empty.txt", 0, True), ("sub/a.txt", "a.txt", 6, False)]


def test_envelope_format(spark, folder):
    listing = files.list_files(spark, str(folder), content=True)
    got = {r["key"]: json.loads(r["value"]) for r in files.envelopes(listing, F.col("content"), F.lit(5)).collect()}
    assert got["sub/a.txt"] == {
        "rel_path": "sub/a.txt", "filename": "a.txt", "content_b64": base64.b64encode(b"nested").decode(),
        "content_type": fv.CONTENT_TYPE, "ts_ms": 5,
    }
    assert got["b.bin"]["content_b64"] == base64.b64encode(bytes(range(256)) * 10).decode()


def test_done_message(spark):
    assert json.loads(files.done_message(spark, 7).first()["value"]) == {"type": "_DONE_", "ts_ms": 7}


def test_documents(spark, folder):
    got = dict(rows(files.read_documents(spark, str(folder))))
    assert got["a.txt"] == "alpha\nbeta é" and got["sub/a.txt"] == "nested" and "b.bin" not in got


def test_land_files(spark, tmp_path):
    target = tmp_path / "out"
    df = spark.createDataFrame([("x/y.bin", bytearray(b"\x00\x01")), ("../evil", bytearray(b"no")), ("/abs", bytearray(b"no"))],
                               "rel_path string, content binary")
    assert rows(files.land_files(df, str(target))) == [("../evil", 2, False), ("/abs", 2, False), ("x/y.bin", 2, True)]
    assert (target / "x" / "y.bin").read_bytes() == b"\x00\x01"
    assert [p.name for p in target.rglob("*") if p.is_file()] == ["y.bin"]
    assert not (tmp_path / "evil").exists()


def test_files_job_copies_and_cleans_top_level(spark, folder, tmp_path):
    target = tmp_path / "landing"
    (target / "old").mkdir(parents=True)
    (target / "stale.txt").write_text("x")
    (target / "old" / "kept.txt").write_text("x")
    (target / "a.txt").write_text("previous")
    assert jobs.run_files(spark, str(folder), str(target), cleanup=True) == 3
    found = {p.relative_to(target).as_posix() for p in target.rglob("*") if p.is_file()}
    assert found == {"a.txt", "b.bin", "sub/a.txt", "old/kept.txt"}
    assert (target / "a.txt").read_text() == "alpha\nbeta é"
    assert (target / "b.bin").read_bytes() == bytes(range(256)) * 10


def test_cleanup_keeps_what_the_source_has_even_if_empty(spark, folder, tmp_path):
    target = tmp_path / "landing"
    target.mkdir()
    for name in ("empty.txt", "stale.txt"):
        (target / name).write_text("x")
    listed = dict(rows(files.list_files(spark, str(folder)).select("rel_path", "length")))
    assert listed["empty.txt"] == 0
    jobs.run_files(spark, str(folder), str(target), cleanup=True)
    assert (target / "empty.txt").exists() and not (target / "stale.txt").exists()
    both = spark.createDataFrame([("empty.txt",), ("gone.txt",)], "rel_path string")
    assert rows(files.delete_files(both, str(target), str(folder))) == [("empty.txt", False), ("gone.txt", True)]


def test_files_job_goes_on_after_a_time_limit(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("many", "out", "state"))
    source.mkdir()
    for i in range(120):
        (source / f"{i}.txt").write_text(f"content {i}")
    args = dict(state=str(state), batch_files=1)
    with pytest.raises(feeds.Unfinished):
        jobs.run_files(spark, str(source), str(target), timeout_s=0.2, **args)
    jobs.run_files(spark, str(source), str(target), timeout_s=300, **args)
    assert {p.name: p.read_text() for p in target.iterdir()} == {f"{i}.txt": f"content {i}" for i in range(120)}
    assert not state.exists()
    with pytest.raises(ValueError):
        jobs.run_files(spark, str(source), str(target), timeout_s=1)


def test_facts_are_read_in_parts():
    parts = sinks.key_ranges("k")
    assert len(parts) == 16 and sum("IS NULL" in p for p in parts) == 1


def test_orphans(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(reconcile.orphans(a, b, ["id"])) == [(1, "x")]
    assert rows(reconcile.additions(b, a, ["id"])) == [(3,)]


def test_jdbc_options_come_from_the_environment():
    env = {"PG_HOST": "h", "PG_DB": "d", "PG_USER": "u", "PG_PASSWORD": "p", "PG_SCHEMA": "gold", "PG_PORT": ""}
    options = sinks.jdbc_options("t", env)
    assert options["url"] == "jdbc:postgresql://h:5432/d" and options["dbtable"] == "gold.t"
    assert options["truncate"] == "true"
    with pytest.raises(KeyError, match="PG_USER, PG_PASSWORD"):
        sinks.jdbc_options("t", {"PG_HOST": "h", "PG_DB": "d"})


def test_load_order_and_counts(spark):
    written = []
    frames = {"b": spark.range(3), "a": spark.range(5)}

    def sink(df, table):
        df.write.format("noop").mode("overwrite").save()
        written.append(table)

    assert sinks.load_tables(frames, sink) == {"a": 5, "b": 3}
    assert written == ["a", "b"]


def test_a_broken_sink_fails_in_the_smoke_test(spark):
    def sink(df, table):
        raise IOError(table)

    with pytest.raises(IOError, match="_smoke_test"):
        sinks.smoke_test(spark, sink)


def test_spread_only_touches_small_scans(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(100).coalesce(1).write.parquet(path)
    assert tables.spread(spark.read.parquet(path), "id").rdd.getNumPartitions() == 8
    many = str(tmp_path / "many.parquet")
    spark.range(100).repartition(9).write.parquet(many)
    wide = spark.read.option("maxPartitionNum", 9).parquet(many)
    plan = tables.spread(wide, "id")._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (wide.rdd.getNumPartitions() < 8)


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
