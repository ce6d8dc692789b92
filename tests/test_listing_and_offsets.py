import pytest
from pyspark.sql import functions as F

from touchline.plans import jobs
from touchline.sources import files
from touchline.streaming import feeds


def test_folders_of_a_level_are_listed_by_many_tasks(spark, tmp_path):
    root, expected = tmp_path / "tree", {}
    for a in range(6):
        for b in range(4):
            place = root / f"a {a}+" / f"b{b}"
            place.mkdir(parents=True)
            for f in range(3):
                (place / f"{f}.txt").write_text("x" * f)
                expected[f"a {a}+/b{b}/{f}.txt"] = (f, False)
    (root / "top.txt").write_text("top")
    (root / "empty folder").mkdir()
    expected["top.txt"] = (3, True)
    made = []
    listed = files.list_files(spark, str(root), made=made)
    assert {r["rel_path"]: (r["length"], r["is_top_level"]) for r in listed.collect()} == expected
    deep = listed.where("not is_top_level")
    assert deep.select(F.spark_partition_id()).distinct().count() > 3
    assert len(made) == 3  # one for each level
    files.remove_folders(spark, made)


def test_a_folder_with_many_entries_is_sent_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LISTED_AT_ONCE", 4)
    for i in range(11):
        (tmp_path / f"{i}.txt").write_text("")
    assert files.list_files(spark, str(tmp_path)).count() == 11


def test_messages_from_servers_need_a_state(spark, tmp_path):
    with pytest.raises(ValueError, match="state"):
        jobs.run_files(spark, str(tmp_path), str(tmp_path / "out"), servers="host:9092")
    assert feeds.kafka_options("h:1", "t", 500)["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in feeds.kafka_options("h:1", "t")


def test_a_second_run_begins_at_its_stored_offsets(spark, tmp_path):
    """Messages landed before are not landed again, also when cleanup has deleted their files."""
    source, sent, target, offsets = (str(tmp_path / n) for n in ("in", "sent", "out", "offsets"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "old.txt").write_text("old")

    def send(ts):
        listed = files.list_files(spark, source, content=True)
        files.envelopes(listed, F.col("content"), F.lit(ts)).select("value").write.mode("append").text(sent)

    send(1)
    assert feeds.land_envelopes(feeds.file_feed(spark, sent, 1), target, offsets) == 1
    (tmp_path / "in" / "old.txt").unlink()
    (tmp_path / "out" / "old.txt").unlink()
    (tmp_path / "in" / "new.txt").write_text("new")
    send(2)
    assert feeds.land_envelopes(feeds.file_feed(spark, sent, 1), target, offsets) == 1
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["new.txt"]
    assert feeds.land_envelopes(feeds.file_feed(spark, sent, 1), target, offsets) == 0
