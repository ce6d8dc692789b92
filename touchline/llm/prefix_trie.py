"""Trie of the common prefixes of conversations, by ROLLUP over positional turn columns.

The turns of a conversation stand in blocks of BLOCK columns. One ROLLUP over the columns
of all blocks gives every prefix with its members; a block is told from its equals by the
node that its conversation had reached before it, so a conversation of any length
is some rows more, not more columns. A node is named by 128 bits: the exclusive or of hashes
of (position, turn), so each row can name its node, its parent and the node before its block
without a join.

Sums over subtrees come from a second ROLLUP, over the nodes. What hangs below the
last column of a block is summed before, block by block, by doubling distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import cut, hot_join
from touchline.operators.retrieval import chat_history

#: Turns in one row.
BLOCK = 8
TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
KEY = ["ka", "kb"]
#: Fixed value: a word is a run of anything but these.
WORD = r"[^\x20\x09-\x0D]+"


def _bits(position: Column, turn: Column) -> list[Column]:
    """What a turn at a position adds to the two halves of a node's name; nothing without a turn."""
    there = F.coalesce(turn.getField("id").isNotNull(), F.lit(False))
    return [F.when(there, h).otherwise(F.lit(0).cast("long")) for h in (
        F.xxhash64(position, turn["id"]), F.xxhash64(F.lit("b"), position, turn["id"]))]


def _xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 1, turn struct<id, words>) in order of turn (null first), role and text."""
    filled = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    name = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    words = F.regexp_count("text", F.lit(WORD)).cast("long")
    return chat_history(filled).select(
        "conv_id", "position", F.struct(name.alias("id"), words.alias("words")).alias("turn"))


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations that share the opening of their group; (conv_id, position, turn), null once for one without turns.

    With h = crc32(decimal conv_id) mod ``most``, conversation c begins with the first h turns
    of conversation c - c % ``group`` (fewer, if that has fewer) and goes on with its own turns after the first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    lengths = cut(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("_base_n"))
    convs = cut(lengths.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
                .join(bases, "base", "left")
                .select("conv_id", "n", "h", "base", F.least("h", F.coalesce("_base_n", F.lit(0))).alias("taken")))
    own = hot_join(turns, convs.select("conv_id", "n", "h", "taken"), ["conv_id"], "n", "position", "inner").where(
        "position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "turn")
    heads = turns.where(F.col("position") < most).select(F.col("conv_id").alias("base"), "position", "turn")
    opening = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("position <= taken")
    none = convs.where((F.col("taken") == 0) & (F.col("n") <= F.col("h"))).select(
        "conv_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"))
    return own.union(opening.select("conv_id", "position", "turn")).union(none)


def blocks(turns: DataFrame) -> DataFrame:
    """One row for BLOCK turns of a conversation: conv_id, block, pa and pb (name of the node
    before the block), ka and kb (of the node after it), depth after it, last (no block follows), t1...

    Names run over the blocks of a conversation by a window; its rows are a BLOCK-th of the turns and small.
    """
    slot = F.pmod(F.col("position") - 1, F.lit(BLOCK)) + 1
    halves = _bits(F.col("position"), F.col("turn"))
    wide = turns.withColumn("block", F.coalesce(F.floor((F.col("position") - 1) / BLOCK), F.lit(0))).groupBy("conv_id", "block").agg(
        F.count("position").alias("_n"), *(F.bit_xor(x).alias(f"_{k}") for k, x in zip(KEY, halves)),
        *(F.max(F.when(slot == i, F.col("turn"))).alias(t) for i, t in enumerate(TURNS, 1)))
    order = Window.partitionBy("conv_id").orderBy("block")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    named = wide.select("*", *(F.bit_xor(f"_{k}").over(so_far).alias(k) for k in KEY), F.lead("block").over(order).isNull().alias("last"))
    return named.select(
        "conv_id", "block", F.col("ka").bitwiseXOR(F.col("_ka")).alias("pa"), F.col("kb").bitwiseXOR(F.col("_kb")).alias("pb"),
        *KEY, (F.col("block") * BLOCK + F.col("_n")).alias("depth"), "last", *TURNS)


def _by_prefix(rows: DataFrame, aggregates: str) -> DataFrame:
    """ROLLUP over the turn columns: ``aggregates`` for each prefix, with block, pa, pb, t1... (null after it), depth, the
    prefix's name (ka, kb) and its last turn.

    Prefixes longer than their rows, and the empty prefixes of later blocks, say nothing and are left out.
    """
    columns = f"block, pa, pb, {', '.join(TURNS)}"
    found = rows.sparkSession.sql(
        f"SELECT {columns}, {BLOCK} - bit_count(grouping_id()) AS slot, {aggregates}"
        f" FROM {{rows}} GROUP BY block, pa, pb, ROLLUP({', '.join(TURNS)})", rows=rows)
    found = found.withColumn("turn", F.get(F.array(*TURNS), F.col("slot") - 1)).where("turn.id is not null or slot = 0 and block = 0")
    added = [_bits(F.col("block") * BLOCK + i, F.col(t)) for i, t in enumerate(TURNS, 1)]
    return found.withColumns({
        "depth": F.col("block") * BLOCK + F.col("slot"),
        "ka": _xor([F.col("pa"), *(a for a, _ in added)]), "kb": _xor([F.col("pb"), *(b for _, b in added)]),
    }).drop("slot")


def prefixes(rows: DataFrame) -> DataFrame:
    """Every node: block, pa, pb, t1..., depth, conv_id, n_convs, ka, kb, words of its last turn, and the parent's name."""
    found = _by_prefix(rows, "min(conv_id) AS conv_id, count(*) AS n_convs")
    last = _bits(F.col("depth"), F.col("turn"))
    parent = {f"parent_{k}": F.col(k).bitwiseXOR(x) for k, x in zip(KEY, last)}
    return found.withColumns({"words": F.coalesce("turn.words", F.lit(0)), **parent}).drop("turn")


def below_blocks(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(ka, kb, *sums) for each node that later blocks begin from: sums over all that hangs below it.

    After r rounds a node has what lies fewer than 2^r blocks below it, and knows the node 2^r blocks above.
    """
    own = nodes.where("block > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(*(F.sum(s).alias(s) for s in sums))
    above = nodes.where(F.col("depth") == (F.col("block") + 1) * BLOCK).select(
        *KEY, *(F.when(F.col("block") > 0, F.col(p)).alias(u) for p, u in (("pa", "ua"), ("pb", "ub"))))
    held = cut(own.join(above, KEY))
    while held.where("ua is not null").limit(1).count():
        sent = held.where("ua is not null").groupBy(F.col("ua").alias("ka"), F.col("ub").alias("kb")).agg(
            F.count("*").alias("_n"), *(F.sum(s).alias(f"_{s}") for s in sums))
        grown = cut(held.join(sent, KEY, "left").select(
            *KEY, "ua", "ub", F.coalesce("_n", F.lit(0)).alias("_n"),
            *((F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums)))
        steps = grown.where("_n > 0").select(F.col("ka").alias("ua"), F.col("kb").alias("ub"), F.col("ua").alias("_ua"), F.col("ub").alias("_ub"), "_n")
        held = cut(hot_join(grown.drop("_n"), steps, ["ua", "ub"], "_n", "ka").select(*KEY, F.col("_ua").alias("ua"), F.col("_ub").alias("ub"), *sums))
    return held.select(*KEY, *sums)


def trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and which conversation ends at which node.

    ``turns``: (conv_id, position, turn struct<id, words>), with a row of null position and turn for a conversation
    without turns. Nodes: ka, kb (name), conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs
    (members), n_children, n_leaves (childless nodes in the subtree, itself included), saved_tokens (over the subtree,
    (n_convs - 1) times the words of the node's last turn). Ends: ka, kb, conv_id. Without conversations both are empty.
    """
    rows = cut(blocks(turns))
    found = cut(prefixes(rows))
    children = found.where("depth > 0").groupBy(*(F.col(f"parent_{k}").alias(k) for k in KEY)).agg(F.count("*").alias("n_children"))
    nodes = cut(found.join(children, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "leaves": F.col("n_children").isNull().cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words"),
    }))
    sums = ["leaves", "saved"]
    deeper = below_blocks(nodes, sums).select(*KEY, *(F.col(s).alias(f"_{s}") for s in sums))
    whole = nodes.join(deeper, KEY, "left").select("block", "pa", "pb", *TURNS, *(
        (F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums))
    totals = _by_prefix(whole, "sum(leaves) AS n_leaves, sum(saved) AS saved_tokens").select(*KEY, "n_leaves", "saved_tokens")
    parents = nodes.where("n_children > 0").select(
        F.col("ka").alias("parent_ka"), F.col("kb").alias("parent_kb"), F.col("conv_id").alias("_parent"), "n_children")
    placed = hot_join(nodes.select(*KEY, "conv_id", "depth", "n_convs", F.col("n_children").alias("_children"), "parent_ka", "parent_kb"),
                      parents, ["parent_ka", "parent_kb"], "n_children", "ka")
    result = placed.join(totals, KEY).select(
        *KEY, "conv_id", "depth", F.when(F.col("depth") > 0, F.col("_parent")).alias("parent_conv_id"), "n_convs",
        F.col("_children").alias("n_children"), "n_leaves", "saved_tokens")
    return result, rows.where("last").select(*KEY, "conv_id")


def prefix_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``trie`` of rebuilt conversations.

    Rows without a conv_id belong to no conversation and are left out; a null role or text is empty; turns of one
    number (and those without, which come first) stand in order of role and text; repeated rows are turns of their own.
    Texts and conversations may be of any length; the turns of a long conversation are dealt over tasks.
    """
    return trie(cut(rebuilt(cut(turns_of(conversations)))))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256): the ids that end at a node, ascending, as decimals joined by commas, hashed in a stream.

    SHA-256 is sequential, so the ids of one node pass one task, in sorted batches that are not kept.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            done = []
            for ka, kb, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (ka, kb) == name:
                    digest.update(f",{conv}".encode())
                    continue
                if digest:
                    done.append((*name, digest.hexdigest()))
                name, digest = (ka, kb), hashlib.sha256(str(conv).encode())
            yield table_of(done)
        yield table_of([(*name, digest.hexdigest())] if digest else [])

    def table_of(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, names=["ka", "kb", "ends_sha256"])

    return ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(run, "ka long, kb long, ends_sha256 string")
