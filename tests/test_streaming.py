import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.dedup import latest_by
from touchline.plans.performance import normalise_players
from touchline.streaming import feeds


def envelope(path, body="aGk=", ts=1, **more):
    return json.dumps({"rel_path": path, "filename": "f", "content_b64": body, "content_type": "c", "ts_ms": ts, **more})


MESSAGES = [
    envelope("a", "b25l", 1), envelope("a", "dHdv", 2), envelope("b/c"), envelope("", "aGk="), envelope("d", ""),
    json.dumps({"rel_path": "e"}), json.dumps({"content_b64": "aGk="}), "{broken", envelope("f", "!!not base64!!"),
    json.dumps({"type": "_DONE_", "ts_ms": 9}), envelope("g", "Z2c=", 10),
]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_decode(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    decoded = feeds.decode_envelopes(df)
    assert rows(decoded.groupBy("status").count()) == [("done", 1), ("file", 4), ("rejected", 6)]
    assert feeds.rejected_messages(decoded).count() == 6
    got = feeds.accepted_files(decoded).select("rel_path", F.col("content").cast("string"), "ts_ms")
    assert rows(got) == [("a", "one", 1), ("a", "two", 2), ("b/c", "hi", 1), ("g", "gg", 10)]


def test_decode_parses_each_message_once(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    plan = feeds.accepted_files(feeds.decode_envelopes(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("unbase64(") == 1


def test_landing_last_version_wins_and_reruns_are_harmless(spark, tmp_path):
    source, target, offsets, dead = (tmp_path / n for n in ("in", "out", "offsets", "dead"))
    write(source, "1.json", MESSAGES)

    def drain():
        return feeds.land_envelopes(feeds.file_feed(spark, str(source)), str(target), str(offsets), 60, str(dead))

    assert drain() == 3
    assert (target / "a").read_text() == "two" and (target / "b" / "c").read_text() == "hi"
    assert drain() == 0
    write(source, "2.json", [envelope("a", "bmV3", 20)])
    assert drain() == 1
    assert (target / "a").read_text() == "new"
    assert spark.read.parquet(str(dead)).count() == 6


def test_upsert_over_batches_equals_batch_run(spark, tmp_path):
    source, table, offsets = (tmp_path / n for n in ("in", "table", "offsets"))
    schema = "k string, v int, at int"
    data = [(f"k{i % 7}", i, (i * 5) % 31) for i in range(40)]
    for n in range(4):
        write(source, f"{n}.json", [json.dumps(dict(zip("k v at".split(), r))) for r in data[n::4]])
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    assert feeds.upsert_feed(feed, ["k"], ["at"], str(table), str(offsets), 60)
    assert len(list(table.glob("batch_id=*"))) == 4
    current = feeds.current_rows(spark, str(table), schema, ["k"], ["at"])
    batch = latest_by(spark.createDataFrame(data, schema), ["k"], ["at"])
    assert rows(current) == rows(batch)
    # A batch that is written again, as after a failure, changes nothing.
    again = spark.read.schema(schema).parquet(str(table / "batch_id=0")).collect()
    spark.createDataFrame(again, schema).write.mode("overwrite").parquet(str(table / "batch_id=0"))
    assert rows(feeds.current_rows(spark, str(table), schema, ["k"], ["at"])) == rows(batch)
    # Compacted, the log is one snapshot with the same rows, and later batches go on top.
    assert rows(feeds.compact(spark, str(table), schema, ["k"], ["at"])) == rows(batch)
    assert [p.name for p in table.iterdir()] == ["snapshot=3"]
    spark.createDataFrame([("k1", -1, 99)], schema).write.parquet(str(table / "batch_id=4"))
    later = feeds.compact(spark, str(table), schema, ["k"], ["at"])
    assert later.where("k = 'k1'").first()["at"] == 99 and later.count() == 7
    assert [p.name for p in table.iterdir()] == ["snapshot=4"]
    snapshot = spark.createDataFrame([("k0", -1, 1000), ("old", 1, 1)], schema)
    merged = dict((r[0], r[1]) for r in rows(feeds.current_rows(spark, str(table), schema, ["k"], ["at"], snapshot)))
    assert merged["k0"] == -1 and merged["old"] == 1 and len(merged) == 8


def test_current_rows_of_an_empty_table(spark, tmp_path):
    assert feeds.current_rows(spark, str(tmp_path / "none"), "k string, at int", ["k"], ["at"]).count() == 0


def test_drain_stops_at_the_time_limit_and_continues_later(spark, tmp_path):
    import time

    source, offsets = tmp_path / "in", tmp_path / "offsets"
    for n in range(3):
        write(source, f"{n}.json", ["x"])
    seen = []

    def slow(batch, batch_id):
        time.sleep(1.5)
        seen.append(batch.count())

    def writer():
        feed = feeds.file_feed(spark, str(source), max_files=1)
        return feed.writeStream.foreachBatch(slow).option("checkpointLocation", str(offsets))

    assert feeds.drain(writer(), 0.5) is False
    assert len(seen) < 3
    assert feeds.drain(writer(), 60) is True
    assert sum(seen) == 3


def test_drain_raises_what_the_batch_raises(spark, tmp_path):
    write(tmp_path / "in", "1.json", ["x"])

    def broken(batch, batch_id):
        raise ValueError("no good")

    feed = feeds.file_feed(spark, str(tmp_path / "in"))
    with pytest.raises(Exception, match="no good"):
        feeds.drain(feed.writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "o")), 60)


def test_player_events(spark, tmp_path):
    source = tmp_path / "in"
    player = {"Player_Name": "A", "Country": "X", "Position": "FW", "Goals": 1, "Minutes_Played": 90}
    write(source, "1.json", [json.dumps({**player, "Timestamp": "2025-01-01T10:00:00.5"}), "{bad"])
    write(source, "2.json", [json.dumps({**player, "Goals": 4, "Timestamp": "2025-01-01T11:00:00"}),
                             json.dumps({**player, "Player_Name": None}),
                             json.dumps({**player, "Player_Name": "B", "Minutes_Played": None, "Timestamp": "when?"})])
    feed = feeds.file_feed(spark, str(source), max_files=1)
    got = feeds.current_players(feed, str(tmp_path / "t"), str(tmp_path / "o"), 60)
    assert rows(got.select("Player_Name", "Goals", "Position", "is_active")) == [
        ("A", 4, "Forward", True), ("B", 1, "Forward", False)]
    batch = feeds.player_events(spark.read.text(str(source)))
    expected = normalise_players(latest_by(batch, fv.PLAYER_KEY, ["event_ts"]))
    assert rows(got.select(*sorted(got.columns))) == rows(expected.select(*sorted(got.columns)))


def test_kafka_options():
    assert feeds.kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    assert feeds.kafka_options("h:1", "t", 10)["maxOffsetsPerTrigger"] == "10"
