"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents are tokenised, cut into pieces of at most ``size`` tokens and ranked within
their length, all on Spark. Pieces of one length are interchangeable, and so are open
sequences with one gap, so both sorted sides are held as runs: (length, count) and
(gap, count). There are at most ``size`` different lengths whatever the corpus, so the
rounds work on runs and their cost does not grow with the documents. A round sweeps all
lengths from the longest: each run takes the gaps that follow it, smallest first and one
piece a gap, conflicts going by rank; then the gaps are updated and the next round begins.
The result is a list of runs that tells each (length, rank) its sequence and offset.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import cut
from touchline.llm.quality import blocks

SIZE, END_ID = 1024, 2
#: A length is ranked in so many parts, so that a hot one is spread.
SHARES = 64
#: Fixed value: how byte-level BPE parts a text before merging.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond ASCII and the Latin letters.
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7E\u00C0-\u024F]")


class WordTokenizer:
    """Token ids of whole texts, as little-endian 32-bit numbers, by a byte-level BPE file of ``tokenizers``.

    The file's own vocabulary and merge order are run by the faster encoder of ``tiktoken``.
    Both part texts alike where all characters are plain Latin; other texts go to
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {t["content"] for t in told["added_tokens"]}
        # ``tokenizers`` gives such a string in a text its one id, the faster encoder would cut it
        self.added = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        octet = _octets()
        ranks = {bytes(octet[c] for c in word): i for word, i in told["model"]["vocab"].items() if word not in special}
        self.fast = tiktoken.Encoding("from file", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [None if _UNUSUAL.search(t) or self.added.search(t) else self.fast.encode_ordinary(t) for t in texts]
        odd = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(odd, self.exact.encode_batch([texts[i] for i in odd], add_special_tokens=False)):
            found[i] = ids.ids
        return [np.array(ids, "<u4").tobytes() for ids in found]


def _octets() -> dict[str, int]:
    """Byte of each character with which byte-level BPE files write bytes: printable ones as themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32), with_ids: and ids, of every row; a null text is empty.

    Each document ends with END_ID. One with more than ``size`` ids is cut from its end
    into pieces of ``size``, so only its first piece may be shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _TOKENIZERS.setdefault(tokenizer, None) or WordTokenizer(tokenizer)
        _TOKENIZERS[tokenizer] = encoder
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist(), 0
            for block in blocks([t or b"" for t in texts]):
                rows, found = [], []
                for i, tokens in enumerate(encoder.encode([t.decode() for t in block])):
                    tokens += end
                    n = len(tokens) // 4
                    cuts = [0, *range(n % size or size, n, size), n] if n > size else [0, n]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = tokens[4 * a:4 * b]
                        rows.append((at + i, k, a, b - a, zlib.crc32(part)))
                        found.append(np.frombuffer(part, "<u4") if with_ids else None)
                at += len(block)
                rows_of, *numbers = zip(*rows)
                columns = [ids.take(pa.array(rows_of)), pa.array(numbers[0], pa.int32()), *(pa.array(c, pa.int64()) for c in numbers[1:])]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(found, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def best_fit(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place every piece.

    ``counts``: number of pieces of each length. The i-th piece of a run goes to the i-th
    sequence from the first, at the offset.
    """
    left, ranked, runs, opened = dict(counts), defaultdict(int), [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, count)

    def place(length: int, sequence: int, n: int, gap: int, into) -> None:
        runs.append((length, ranked[length], n, sequence, size - gap))
        ranked[length] += n
        left[length] -= n
        if gap > length:
            into[gap - length].append((sequence, n))

    while any(left.values()):
        # pieces that no gap holds begin sequences: all that cannot share one, else the longest
        widest = max((g for g, r in gaps.items() if r), default=0)
        waiting = sorted((s for s, n in left.items() if n and s > widest), reverse=True)
        for i, length in enumerate(waiting):
            if i and 2 * length <= size:
                break
            n = -(-left[length] // max(1, size // length))
            place(length, opened, n, size, gaps)
            opened += n
        # one sweep: each length, longest first, takes the smallest gaps that hold it; one piece a gap
        after: dict[int, list[tuple[int, int]]] = defaultdict(list)
        free = sorted(g for g, r in gaps.items() if r)
        for length in sorted((s for s, n in left.items() if n), reverse=True):
            for gap in free[np.searchsorted(free, length):]:
                while left[length] and gaps[gap]:
                    first, n = gaps[gap].pop()
                    if n > left[length]:
                        gaps[gap].append((first + left[length], n - left[length]))
                        n = left[length]
                    place(length, first, n, gap, after)
                if not left[length]:
                    break
        for gap, found in after.items():
            gaps[gap] += found
    return runs


def ranked(found: DataFrame, id_col: str) -> DataFrame:
    """``found`` with ``_rank``, 0, 1, 2, ... within each length, in any order.

    Parts of a length are numbered apart and shifted by the sizes of the parts before:
    at most size x SHARES counts.
    """
    share = F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(SHARES)).cast("int")
    rows = found.withColumn("_share", share)
    counts = rows.groupBy("length", "_share").count()
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.col("length").alias("_length"), F.col("_share").alias("_part"),
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    order = Window.partitionBy("length", "_share").orderBy(id_col, "piece")
    numbered = rows.withColumn("_number", F.row_number().over(order) - 1)
    joined = numbered.join(F.broadcast(shifts), (F.col("length") == F.col("_length")) & (F.col("_share") == F.col("_part")))
    return joined.withColumn("_rank", F.col("_number") + F.col("_shift")).drop("_share", "_part", "_length", "_number", "_shift")


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    Sequences hold at most ``size`` tokens and have no gap before their last. A null or
    empty text is one token (its end). Repeated rows are packed as often as they come;
    rows without an id too. An empty table gives an empty one.
    """
    found = cut(pieces(docs, tokenizer, size, id_col, text_col))
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # ``size`` rows at most
    runs = np.array(sorted(best_fit(counts, size)), np.int64).reshape(-1, 5)
    starts = (runs[:, 0] << 48) | runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column("_rank").to_numpy(), batch.column("length").to_numpy()
            of = np.searchsorted(starts, (length << 48) | rank, "right") - 1
            place = runs[of, 3] + rank - runs[of, 1]
            kept = [batch.column(c) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(place), pa.array(runs[of, 4])],
                                             names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kind = dict(found.dtypes)[id_col]
    rows = ranked(found, id_col).select(F.col(id_col).alias("id"), "piece", "start", "length", "ids_crc32", F.col("_rank").cast("long"))
    placed = rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
