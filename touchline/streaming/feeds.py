"""File and player-event feeds.

A feed is a streaming frame with ``value`` (JSON text) and ``position`` (order
of arrival). Progress lives in the checkpoint, state lives in the target; no
operator keeps state in executor memory. Every batch write is repeatable, so a
batch that runs again after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from touchline import fixed_values as fv
from touchline.operators.dedup import latest_by
from touchline.plans.performance import keyed_players, normalise_players
from touchline.schemas import struct
from touchline.sources.files import exists, land_files, remove_folders
from touchline.sources.tables import empty


# --- sources ----------------------------------------------------------------

def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_feed(spark: SparkSession, servers: str, topic: str = fv.FILES_TOPIC, max_offsets: int | None = None) -> DataFrame:
    messages = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets)).load()
    return messages.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("position"))


def publish_kafka(messages: DataFrame, servers: str, topic: str = fv.FILES_TOPIC) -> None:
    """Send (key, value) rows; the key keeps all versions of a path in order."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def file_feed(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Messages stored as lines of text files; newer files arrive later."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrival = F.unix_micros(F.col("_metadata.file_modification_time"))
    return reader.text(folder).select("value", arrival.alias("position"))


def table_feed(spark: SparkSession, folder: str, table: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Parquet table, one file or a folder of files, read as a stream.

    The path is a pattern because a plain stream path must be a folder.
    """
    reader = spark.readStream.schema(struct(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder.rstrip('/')}/{table}[.]parquet")


# --- control ----------------------------------------------------------------

class Unfinished(RuntimeError):
    """The time limit struck; run again with the same checkpoint to go on."""


def drain(writer: DataStreamWriter, timeout_s: float | None = None) -> bool:
    """Process what is there now, at most ``timeout_s`` if given; True when all was read.

    What the time did not allow stays in the checkpoint for the next run with the same
    one. Micro-batches that ended are not done again.
    """
    query = writer.trigger(availableNow=True).start()
    try:
        return bool(query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() or True)
    finally:
        query.stop()


# --- envelopes --------------------------------------------------------------

def decode_envelopes(messages: DataFrame) -> DataFrame:
    """Parsed messages with ``status``: file, done or rejected.

    Rejected are broken JSON, a missing or empty path or content, and content
    that is not base64.
    """
    carried = [c for c in messages.columns if c in ("value", "position")]
    parsed = messages.select(*carried, once(F.from_json("value", fv.ENVELOPE_SCHEMA)))
    content = F.try_to_binary("content_b64", F.lit("base64"))
    decoded = parsed.select("*", once(F.struct(content.alias("content"))))
    is_file = (F.length("rel_path") > 0) & (F.length("content_b64") > 0) & F.col("content").isNotNull()
    return decoded.withColumn(
        "status", F.when(F.col("type") == fv.DONE_TYPE, "done").when(is_file, "file").otherwise("rejected")
    ).drop("content_b64", "type")


def once(struct: Column) -> Column:
    """Fields of a costly struct as columns, computed one time per row.

    Filters on the fields stay above the generator; pushed below a projection
    they would repeat the parsing or decoding for every condition.
    """
    return F.inline(F.array(struct))


def accepted_files(decoded: DataFrame) -> DataFrame:
    return decoded.where("status = 'file'").drop("status", "value")


def rejected_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where("status = 'rejected'").select("value")


def land_envelopes(
    feed: DataFrame, target: str, checkpoint: str, timeout_s: float | None = None,
    dead_letters: str | None = None,
) -> int:
    """Write each file of the feed below ``target``; the last version of a path wins.

    Returns the number of files written; raises ``Unfinished`` when the limit struck.
    The winner of a path is chosen without its content, which is not sorted or shuffled
    for that.
    """
    landed = 0

    def batch(rows: DataFrame, batch_id: int) -> None:
        nonlocal landed
        decoded = decode_envelopes(rows).persist(StorageLevel.DISK_ONLY)
        files = accepted_files(decoded).withColumn("_digest", F.xxhash64("content"))
        keys = ["rel_path", "ts_ms", "position", "_digest"]
        newest = latest_by(files.select(*keys), ["rel_path"], ["ts_ms", "position"]).select(*keys)
        winners = files.join(newest, keys, "left_semi").drop("_digest")
        landed += land_files(winners, target).where("landed").select("rel_path").distinct().count()
        if dead_letters:
            rejected_messages(decoded).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
        decoded.unpersist()

    done = drain(feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), timeout_s)
    if not done:
        raise Unfinished(f"{landed} files landed before the limit of {timeout_s} s; run again to land the rest")
    return landed


# --- keyed state in a table -------------------------------------------------

def upsert_feed(
    feed: DataFrame, key: Sequence[str], order: Sequence[str], table: str, checkpoint: str,
    timeout_s: float | None = None,
) -> bool:
    """Append the newest row per key of each batch to the log of ``table``.

    A batch owns one folder and replaces it when it runs again. The cost of a
    batch depends on the batch, not on the size of the table.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        newest = latest_by(rows, key, order)
        newest.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    return drain(feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), timeout_s)


def current_rows(
    spark: SparkSession, table: str, schema, key: Sequence[str], order: Sequence[str],
    base: DataFrame | None = None,
) -> DataFrame:
    """Newest row per key over the last snapshot, the log since then and an optional ``base``."""
    fields = struct(schema)
    newest, batches, _ = _parts(spark, table)
    paths = [f"{table}/snapshot={newest}"] * (newest >= 0) + [f"{table}/batch_id={b}" for b in batches]
    log = spark.read.schema(fields).parquet(*paths) if paths else empty(spark, fields)
    rows = log.select(*fields.names)
    if base is not None:
        rows = rows.unionByName(base.select(*fields.names))
    return latest_by(rows, key, order)


def compact(spark: SparkSession, table: str, schema, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Turn the log of ``table`` into one snapshot of the newest rows; returns it.

    The snapshot is written beside the log under the number of the last batch it holds,
    complete only with its success marker; then the batches it holds and older snapshots
    are removed. Run again after a failure it ends in the same state, and a reader in
    between sees rows twice at most, which the newest-row rule absorbs.
    """
    newest, batches, snapshots = _parts(spark, table)
    if batches:
        held = f"{table}/snapshot={max(batches)}"
        current_rows(spark, table, schema, key, order).write.mode("overwrite").parquet(held)
        remove_folders(spark, [f"{table}/snapshot={s}" for s in snapshots if s < max(batches)])
        remove_folders(spark, [f"{table}/batch_id={b}" for b in batches])
    return current_rows(spark, table, schema, key, order)


def _parts(spark: SparkSession, table: str) -> tuple[int, list[int], list[int]]:
    """Last complete snapshot (-1: none), batches after it, and all snapshots."""
    place = spark._jvm.org.apache.hadoop.fs.Path(table)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    numbers = lambda kind: sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))
    snapshots = numbers("snapshot")
    newest = max((s for s in snapshots if exists(spark, f"{table}/snapshot={s}/_SUCCESS")), default=-1)
    return newest, [b for b in numbers("batch_id") if b > newest], snapshots


# --- player events ----------------------------------------------------------

EVENT_SCHEMA = fv.PLAYER_SCHEMA + ", Timestamp STRING"


def player_events(messages: DataFrame) -> DataFrame:
    """Player rows of JSON messages with their event time; rows without a key are dropped."""
    parsed = messages.select(once(F.from_json("value", EVENT_SCHEMA)))
    return keyed_players(parsed).withColumn("event_ts", F.try_to_timestamp("Timestamp")).drop("Timestamp")


def current_players(
    feed: DataFrame, table: str, checkpoint: str, timeout_s: float | None = None
) -> DataFrame:
    """Drain the event feed and return the clean latest row of each player.

    Raises ``Unfinished`` when the limit struck, as the rows would not be complete.
    """
    events = player_events(feed)
    order = ["event_ts"]
    if not upsert_feed(events, fv.PLAYER_KEY, order, table, checkpoint, timeout_s):
        raise Unfinished(f"the limit of {timeout_s} s struck; run again with the same checkpoint")
    newest = current_rows(feed.sparkSession, table, events.schema, fv.PLAYER_KEY, order)
    return normalise_players(newest)
