"""Files as rows: listings, message envelopes, text documents, landing files."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.sources.tables import stored


LISTED = "path string, length bigint, modified_at timestamp"


def list_files(spark: SparkSession, folder: str, content: bool = False, made: list[str] | None = None) -> DataFrame:
    """Every file below ``folder``: rel_path, filename, length, modified_at, is_top_level[, content].

    The listing has empty files too and opens none; it is kept in scratch folders, which are added to ``made``.
    With ``content`` only files that have some are listed, as the feed carries no empty ones.
    """
    if content:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        files = files.withColumnRenamed("modificationTime", "modified_at")
    else:
        files = _listing(spark, folder, made)
    rel = relative_path(F.col("path"), folder)
    columns = [
        rel.alias("rel_path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("filename"),
        F.col("length"),
        F.col("modified_at"),
        (F.instr(rel, "/") == 0).alias("is_top_level"),
    ]
    return files.select(*columns, *(["content"] if content else []))


#: Entries sent on at once while folders are listed.
LISTED_AT_ONCE = 10_000


def _listing(spark: SparkSession, folder: str, made: list[str] | None) -> DataFrame:
    """Files below ``folder``, walked level by level: the folders found on one level are dealt to tasks, one call
    for each, and what they hold is stored before the next level begins."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, _ = _open(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = filesystem.get_file_info(fs.FileSelector(path, recursive=False))
                for start in range(0, len(found), LISTED_AT_ONCE):
                    part = found[start:start + LISTED_AT_ONCE]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i.path for i in part], pa.string()),
                         pa.array([i.size if i.type == fs.FileType.File else -1 for i in part], pa.int64()),
                         pa.array([i.mtime for i in part], pa.timestamp("us", tz="UTC"))],
                        ["path", "length", "modified_at"])

    _, root = _open(folder)
    frontier, files, tasks = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string"), [], 1
    while tasks:
        listed = stored(frontier.repartition(tasks).mapInArrow(entries, LISTED), "listing", made)
        files.append(listed.where("length >= 0"))
        frontier = listed.where("length < 0").select("path")
        tasks = min(frontier.count(), 4 * spark.sparkContext.defaultParallelism)
    return reduce(DataFrame.unionByName, files)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders that a job made for itself."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_in_tasks(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a job made for itself; what its own folders hold is deleted by tasks."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _open(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem.delete_dir_contents(path)
            yield batch

    from pyarrow import fs

    filesystem, root = _open(folder)
    inside = [(i.path,) for i in filesystem.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory]
    if inside:
        spark.createDataFrame(inside, "path string").repartition(min(len(inside), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(
            remove, "path string").write.format("noop").mode("overwrite").save()
    remove_folders(spark, [folder])


def relative_path(path: Column, folder: str) -> Column:
    """``path`` below ``folder``, whatever scheme prefix the listing carries."""
    bare = re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", folder).rstrip("/")
    start = F.regexp_replace(path, r"^[a-z][a-z0-9+.-]*:(//[^/]*)?/+", "/")
    return F.substring(start, len(bare) + 2, 2**31 - 1)


def envelopes(
    files: DataFrame, content: Column, ts_ms: Column, rel_path: Column | None = None,
    filename: Column | None = None,
) -> DataFrame:
    """Files as JSON messages: key = path, value = envelope with base64 content."""
    body = F.struct(
        (F.col("rel_path") if rel_path is None else rel_path).alias("rel_path"),
        (F.col("filename") if filename is None else filename).alias("filename"),
        plain_base64(content).alias("content_b64"),
        F.lit(fv.CONTENT_TYPE).alias("content_type"),
        ts_ms.cast("bigint").alias("ts_ms"),
    )
    return files.select(body.alias("_e")).select(
        F.col("_e.rel_path").alias("key"), F.to_json("_e").alias("value")
    )


def plain_base64(content: Column) -> Column:
    """Base64 without the line breaks some encoders insert."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def done_message(spark: SparkSession, ts_ms: int) -> DataFrame:
    """The end-of-run marker that follows the last file."""
    row = F.to_json(F.struct(F.lit(fv.DONE_TYPE).alias("type"), F.lit(ts_ms).alias("ts_ms")))
    return spark.range(1).select(F.lit(None).cast("string").alias("key"), row.alias("value"))


#: Files that one task reads, and bytes sent on at once.
READ_FILES, READ_BYTES = 2_000, 8_000_000


def read_documents(spark: SparkSession, folder: str, extension: str = "txt", made: list[str] | None = None) -> DataFrame:
    """Text documents below ``folder``: doc_id (relative path) and whole text.

    Files that cannot be read are skipped, as are empty and hidden ones. Folders are listed and files opened by tasks, so that
    no number of files burdens the driver; the listing is kept in scratch folders, which are added to ``made``.
    """

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _open(folder)
        out, size = ([], []), 0
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], ["doc_id", "content"])
        for batch in batches:
            for rel in batch.column(0).to_pylist():
                try:
                    with filesystem.open_input_stream(posixpath.join(root, rel), compression=None) as file:
                        body = file.read()
                except FileNotFoundError:
                    raise
                except OSError:
                    continue
                out[0].append(rel)
                out[1].append(body)
                size += len(body)
                if size > READ_BYTES:
                    yield rows()
                    out, size = ([], []), 0
        yield rows()

    shown = ~F.col("rel_path").rlike(r"(^|/)(\.|_[^=/]*(/|$))|\._COPYING_$")  # as Spark's readers have it
    listed = list_files(spark, folder, made=made).where(F.col("filename").endswith(f".{extension}") & (F.col("length") > 0) & shown)
    tasks = max(spark.sparkContext.defaultParallelism, -(-listed.count() // READ_FILES))
    read = listed.select("rel_path").repartition(tasks, "rel_path").mapInArrow(bodies, "doc_id string, content binary")
    return read.select("doc_id", F.col("content").cast("string").alias("text"))


def land_files(files: DataFrame, target: str) -> DataFrame:
    """Write ``content`` to ``target``/``rel_path`` from the executors.

    Each file is written under a temporary name and renamed, so a task that is
    retried or lost never leaves half a file under the real name. Paths that
    leave the target are refused. Returns rel_path, n_bytes, landed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(target)
        ready: set[str] = set()
        for batch in batches:
            sizes, landed = [], []
            for rel, body in zip(*(c.to_pylist() for c in batch.columns)):
                safe = _inside(rel)
                if safe:
                    path = posixpath.join(root, rel)
                    if posixpath.dirname(path) not in ready:
                        fs.create_dir(posixpath.dirname(path), recursive=True)
                        ready.add(posixpath.dirname(path))
                    _replace(fs, path, body)
                sizes.append(len(body))
                landed.append(safe)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(landed, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["rel_path", "n_bytes", "landed"])

    return files.select("rel_path", "content").mapInArrow(
        run, "rel_path string, n_bytes bigint, landed boolean"
    )


def delete_files(paths: DataFrame, target: str, unless_in: str | None = None) -> DataFrame:
    """Delete ``target``/``rel_path`` for each row; missing files count as deleted.

    A file that the folder ``unless_in`` has, empty or not, is looked up again and kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        fs, root = _open(target)
        source, source_root = _open(unless_in) if unless_in else (None, "")
        for batch in batches:
            done = []
            for rel in batch.column(0).to_pylist():
                safe = _inside(rel)
                if safe and source:
                    safe = source.get_file_info(posixpath.join(source_root, rel)).type == FileType.NotFound
                if safe:
                    try:
                        fs.delete_file(posixpath.join(root, rel))
                    except FileNotFoundError:
                        pass
                done.append(safe)
            columns = [batch.column(0), pa.array(done, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["rel_path", "deleted"])

    return paths.select("rel_path").mapInArrow(run, "rel_path string, deleted boolean")


def _open(target: str):
    from pyarrow import fs

    if not re.match(r"^[a-z][a-z0-9+.-]*:", target):
        return fs.LocalFileSystem(), posixpath.abspath(target)
    filesystem, root = fs.FileSystem.from_uri(target)
    return filesystem, unquote(root)


def _inside(rel: str) -> bool:
    return not posixpath.isabs(rel) and ".." not in rel.split("/")


def _replace(fs, path: str, body: bytes) -> None:
    import uuid

    draft = f"{posixpath.dirname(path)}/.{posixpath.basename(path)}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(body)
    try:
        fs.move(draft, path)
    except OSError:
        # Some file systems refuse to rename onto an existing file.
        fs.delete_file(path)
        fs.move(draft, path)
