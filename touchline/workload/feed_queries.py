"""Ingest feeds over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources import files
from touchline.streaming import feeds
from touchline.session import scratch_path
from touchline.workload.registry import query
from touchline.workload.tables import SCHEMAS, read_spread


def _document_messages(documents: DataFrame, rel_path) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return files.envelopes(documents, F.encode("text", "UTF-8"), F.col("doc_id"), rel_path=rel_path, filename=name)


@query("""
SELECT source || '/' || doc_id || '.txt' AS rel_path, doc_id || '.txt' AS filename, doc_id AS ts_ms,
  octet_length(encode(text)) AS n_bytes, sha256(text) AS digest
FROM documents WHERE lang <> 'en' AND length(text) > 0
""")
def stream_decode(spark, sf):
    """Messages decoded; those without a path are rejected."""
    path = F.when(
        F.col("lang") != "en", F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    decoded = feeds.decode_envelopes(_document_messages(read_spread(spark, sf, "documents", "doc_id"), path))
    return feeds.accepted_files(decoded).select(
        "rel_path", "filename", "ts_ms",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.sha2("content", 256).alias("digest"),
    )


@query("""
SELECT lang || '/' || source AS rel_path, doc_id AS ts_ms, sha256(text) AS digest FROM documents
WHERE length(text) > 0
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id DESC) = 1
""")
def stream_envelopes(spark, sf):
    """Messages drained as a stream into a table that keeps the last version of a path."""
    stream = feeds.table_feed(spark, sf, "documents", SCHEMAS["documents"])
    decoded = feeds.accepted_files(
        feeds.decode_envelopes(_document_messages(stream, F.concat_ws("/", "lang", "source")))
    )
    table = scratch_path(spark, "stream_envelopes")
    key, order = ["rel_path"], ["ts_ms"]
    feeds.upsert_feed(decoded, key, order, f"{table}/log", f"{table}/offsets", timeout_s=None)
    rows = feeds.current_rows(spark, f"{table}/log", decoded.schema, key, order)
    return rows.select("rel_path", "ts_ms", F.sha2("content", 256).alias("digest"))


@query("""
SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1
""")
def stream_latest_wins(spark, sf):
    """The streaming form of ``latest_wins``."""
    stream = feeds.table_feed(spark, sf, "events", SCHEMAS["events"]).select("user_id", "event_id", "event_type", "value", "ts")
    table = scratch_path(spark, "stream_latest_wins")
    key, order = ["user_id"], ["ts", "event_id"]
    feeds.upsert_feed(stream, key, order, f"{table}/log", f"{table}/offsets", timeout_s=None)
    return feeds.current_rows(spark, f"{table}/log", stream.schema, key, order)


def _player_messages(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.struct(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("Player_Name"),
        F.col("event_type").alias("Country"),
        (F.col("user_id") % 20 + 18).cast("int").alias("Age"),
        F.when(k % 3 == 0, "FW").when(k % 3 == 1, "Keeper").alias("Position"),
        F.when(k > 50, k).alias("Goals"),
        F.floor("value").cast("int").alias("Minutes_Played"),
        (k.cast("double") / 10).alias("Performance_Rating"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("Timestamp"),
    )
    return events.select(F.to_json(body).alias("value"))


@query("""
SELECT 'user ' || user_id AS "Player_Name", event_type AS "Country", (user_id % 20 + 18)::INT AS "Age",
  CASE k % 3 WHEN 0 THEN 'Forward' WHEN 1 THEN 'Keeper' END AS "Position",
  CASE WHEN k > 50 THEN k ELSE 0 END AS "Goals", 0 AS "Assists", floor(value)::INT AS "Minutes_Played",
  k::DOUBLE / 10 AS "Performance_Rating", floor(value) > 0 AS is_active,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts
FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events) e
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY e.ts DESC) = 1
""")
def stream_player_events(spark, sf):
    """Player events drained as a stream; the latest clean row of each player."""
    table = scratch_path(spark, "stream_player_events")
    stream = _player_messages(feeds.table_feed(spark, sf, "events", SCHEMAS["events"]))
    players = feeds.current_players(stream, f"{table}/log", f"{table}/offsets", timeout_s=None)
    return players.select(
        "Player_Name", "Country", "Age", "Position", "Goals", "Assists", "Minutes_Played",
        "Performance_Rating", "is_active", "event_ts",
    )
