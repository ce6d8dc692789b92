"""Split documents into overlapping chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from touchline import fixed_values as fv


# Windows cut from one block; long texts are cut in two steps because finding a
# character position scans the text from its start.
BLOCK_WINDOWS = 64


def chunk_fixed(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text",
    size: int = fv.CHUNK_SIZE, overlap: int = fv.CHUNK_OVERLAP,
) -> DataFrame:
    """Windows of ``size`` characters that start every ``size - overlap``.

    Row-local: no shuffle, and Catalyst pushes filters on the document below it.
    An empty text has no chunk.
    """
    step = size - overlap
    stride = step * BLOCK_WINDOWS
    blocks = df.where(f"length({text}) > 0").selectExpr(
        doc_id, f"{text} AS _text",
        f"explode(sequence(0, {_last_window(text, stride, overlap)})) AS _block",
    ).selectExpr(
        doc_id, "_block", f"substring(_text, _block * {stride} + 1, {stride + overlap}) AS _part"
    )
    return blocks.selectExpr(
        doc_id, "_block", "_part",
        f"explode(sequence(0, {_last_window('_part', step, overlap)})) AS _window",
    ).selectExpr(
        doc_id, f"CAST(_block * {BLOCK_WINDOWS} + _window AS INT) AS seq",
        f"substring(_part, _window * {step} + 1, {size}) AS chunk",
    )


def _last_window(text: str, step: int, overlap: int) -> str:
    """Index of the last window that starts before the final ``overlap`` characters."""
    return f"greatest(length({text}) - 1 - {overlap}, 0) div {step}"


def chunk_recursive(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text",
    size: int = fv.CHUNK_SIZE, overlap: int = fv.CHUNK_OVERLAP,
    separators: Sequence[str] = tuple(fv.CHUNK_SEPARATORS),
) -> DataFrame:
    """Chunks of at most ``size`` characters cut at the coarsest separator that fits.

    The cut points depend on all text before them, which no built-in expression
    can follow, so the texts go through Python in Arrow batches. Still row-local.
    """
    key_type = df.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, seqs, chunks = [], [], []
            for owner, body in enumerate(batch.column(1).to_pylist()):
                pieces = split_text(body or "", size, overlap, separators)
                owners.extend([owner] * len(pieces))
                seqs.extend(range(len(pieces)))
                chunks.extend(pieces)
            ids = batch.column(0).take(pa.array(owners, pa.int64()))
            columns = [ids, pa.array(seqs, pa.int32()), pa.array(chunks, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [doc_id, "seq", "chunk"])

    return df.select(doc_id, text).mapInArrow(run, f"{doc_id} {key_type}, seq int, chunk string")


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Chunks of one text. Pieces keep their leading separator; chunks are trimmed."""
    level = next(i for i, s in enumerate(separators) if s == "" or s in text)
    finer = separators[level + 1 :] if separators[level] else ()
    out: list[str] = []
    fitting: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            fitting.append(piece)
            continue
        out.extend(_pack(fitting, size, overlap))
        fitting = []
        out.extend(split_text(piece, size, overlap, finer) if finer else [piece])
    out.extend(_pack(fitting, size, overlap))
    return out


def _pieces(text: str, separator: str) -> list[str]:
    if not separator:
        return list(text)
    head, *tail = text.split(separator)
    return [p for p in [head, *(separator + t for t in tail)] if p]


def _pack(pieces: Iterable[str], size: int, overlap: int) -> Iterator[str]:
    """Greedy packing; each chunk starts with up to ``overlap`` of its predecessor."""
    window: deque[str] = deque()
    length = 0
    for piece in pieces:
        if window and length + len(piece) > size:
            yield from _trimmed(window)
            while window and (length > overlap or length + len(piece) > size):
                length -= len(window.popleft())
        window.append(piece)
        length += len(piece)
    yield from _trimmed(window)


def _trimmed(window: Iterable[str]) -> Iterator[str]:
    chunk = "".join(window).strip()
    if chunk:
        yield chunk
