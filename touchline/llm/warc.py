"""WARC archives of Zstandard frames: one frame a record, the dictionary in a leading skippable frame.

Tasks write archives through the file system of the shared folder and report what they
wrote; an attempt that is lost leaves files that no report names. Readers take the
reported archives, load the dictionary, decode one frame at a time and check every record.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import cut, spread_join
from touchline.session import scratch_path

#: The frame that holds a dictionary, and the start of any Zstandard frame.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of so many bytes are stored once.
REVISIT_BYTES = 100
#: An archive is closed beyond this size. A reader asks for CHUNK bytes at a time.
ARCHIVE_BYTES, CHUNK = 64 << 20, 64 << 10
#: The dictionary is learnt from at most so many pages, and so many bytes of each.
DICTIONARY_PAGES, DICTIONARY_SAMPLE, DICTIONARY_BYTES = 400, 16 << 10, 32 << 10


class Record(NamedTuple):
    headers: dict[str, str]
    payload: bytes


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary of the samples; empty when they are too few to learn from."""
    samples = [s for s in samples if s]
    if len(samples) < 16 or sum(map(len, samples)) < 8 * size:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def encode(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A record: an HTTP response, or a revisit without payload."""
    http = b"" if refers_to is not None else (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = b"" if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # the table has no time of capture
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", IDENTICAL)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def decode(record: bytes) -> Record:
    """Headers and payload; ValueError for a record whose form, lengths or digest do not hold."""
    head, parted, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    if not parted or not version.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    if missing := {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} - headers.keys():
        raise ValueError(f"headers missing: {sorted(missing)}")
    length = int(headers["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{headers['WARC-Record-ID']}: block is not {length} bytes long")
    if headers["WARC-Type"] == "revisit":
        if length or "WARC-Refers-To" not in headers:
            raise ValueError(f"{headers['WARC-Record-ID']}: revisit with a block or without its original")
        return Record(headers, b"")
    http, parted, payload = rest[:length].partition(b"\r\n\r\n")
    told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if not parted or int(told["Content-Length"]) != len(payload) or int(headers["X-Payload-Length"]) != len(payload):
        raise ValueError(f"{headers['WARC-Record-ID']}: payload length does not hold")
    if headers["WARC-Payload-Digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise ValueError(f"{headers['WARC-Record-ID']}: payload digest does not hold")
    return Record(headers, payload)


def read_archive(stream) -> Iterator[Record]:
    """Records of an open archive, one frame in memory at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no leading dictionary frame")
    words = stream.read(size)
    if len(words) != size:
        raise ValueError("dictionary frame is cut short")
    if words[:4] == ZSTD_FRAME:
        words = zstandard.ZstdDecompressor().decompress(words)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    data = stream.read(CHUNK)
    while data:
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not data and not (data := stream.read(CHUNK)):
                raise ValueError("last frame is cut short")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
        yield decode(b"".join(parts))
        data = data or stream.read(CHUNK)


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of records whose payload an earlier page holds.

    ``pages``: (page_id, digest, payload_bytes). Counts come from partial sums, so a
    payload that very many pages share reaches no task whole.
    """
    ids = pages.where((F.col("payload_bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last"))
    first = first.where("_last > refers_to").drop("_last")
    again = spread_join(ids.select("digest", "page_id").distinct(), first, "digest", "page_id")
    return again.where("page_id > refers_to").select("page_id", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Archives of all ``pages`` in ``folder``; returns (path, records, bytes), computed once.

    A null payload is empty. Rows without an id are responses; so are repeated rows of the
    smallest id with a payload. An empty table writes nothing.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("digest"))
    samples = rows.where(F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0).select(
        F.substring(F.col("html"), 1, DICTIONARY_SAMPLE).alias("s")).limit(DICTIONARY_PAGES).collect()
    words = train_dictionary([r["s"].encode() for r in samples])
    marks = revisits(rows.select("page_id", "digest", F.octet_length("html").alias("payload_bytes")))
    marked = rows.join(marks, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        files.create_dir(base, recursive=True)
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words) if words else None)
        name, out, done = "", None, []
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, count = posixpath.join(base, f"{uuid.uuid4().hex}.warc.zst"), 0
                    out = files.open_output_stream(name, compression=None)
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(words)) + words)
                out.write(writer.compress(encode(page_id, url, html.encode(), digest, refers_to)))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    done.append((name, count, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, count, out.tell()))
            out.close()
        if done:
            paths, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"])

    return cut(marked.mapInArrow(run, "path string, records long, bytes long"))


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives that ``write_archives`` reported.

    (page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload); the
    payload of a revisit is null, as another record holds it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else fs.LocalFileSystem()
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("refers_to", pa.int64()), ("payload", pa.string())])
        number = lambda uri: int(x) if uri and (x := uri[len("<urn:page:"):-1]) else None
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, size, count = [], 0, 0
                with files.open_input_stream(path, compression=None) as stream:
                    for headers, payload in read_archive(stream):
                        kind = headers["WARC-Type"]
                        found.append((number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
                                      headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"]),
                                      number(headers.get("WARC-Refers-To")), payload.decode() if kind == "response" else None))
                        size, count = size + len(payload), count + 1
                        if size > 8 << 20 or len(found) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                            found, size = [], 0
                if count != records:
                    raise ValueError(f"{path}: {count} records, {records} were written")
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    n = max(1, min(archives.count(), 10_000))
    return archives.select("path", "records").repartition(n).mapInArrow(
        run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload string")


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """All ``pages`` written as archives in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **columns), folder)
