r"""Chat formatting that reads back to exactly what went in.

Grammar of a formatted conversation::

    conversation := turn ("\n" turn)*        turn := "### " role ": " body "</turn>"

Neither role nor body holds ``###`` or ``</turn>``; a role holds no colon. A backslash
starts an escape: ``\b`` is a backslash, ``\h`` is ``###``, ``\t`` is ``</turn>`` and
``\c`` a colon. A turn is written as it is, read with the parser, and compared with its
source; only when the two differ is its content escaped and compared again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, BETWEEN = "### ", "</turn>", ": "
#: Control strings and their escapes; the backslash is escaped first and read last.
ESCAPES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")]
COLON = (":", "\\c")


def escape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    for raw, safe in pairs:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    """Inverse of ``escape``: each backslash of an escaped text starts one escape."""
    for raw, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(BETWEEN), body, F.lit(CLOSE))


def parse(turn: Column) -> Column:
    """Struct (role, text) of a turn without its closing mark; null where it breaks the grammar."""
    content = F.substring(turn, len(OPEN) + 1, 2**31 - 1)
    at = F.instr(content, BETWEEN)
    body = F.substring(content, at + F.lit(len(BETWEEN)), F.lit(2**31 - 1))
    fits = turn.startswith(OPEN) & (at > 0) & ~F.contains(content, F.lit("###")) & ~F.contains(content, F.lit(CLOSE))
    return F.when(fits, F.struct(
        unescape(F.substring(content, F.lit(1), at - F.lit(1)), [*ESCAPES, COLON]).alias("role"),
        unescape(body).alias("text")))


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with ``rendered``, escaped only where reading back needs it."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    for attempt in range(2):
        if attempt:
            write = render(escape(F.col("role"), [*ESCAPES, COLON]), escape(F.col("text")))
            rows = rows.withColumn("rendered", F.when(F.col("_same"), F.col("rendered")).otherwise(write))
        else:
            rows = rows.withColumn("rendered", render(F.col("role"), F.col("text")))
        read = parse(F.substring("rendered", F.lit(1), F.length("rendered") - F.lit(len(CLOSE))))
        rows = rows.withColumn("_read", read)
        same = F.col("_read").isNotNull() & F.col("_read.role").eqNullSafe(F.col("role"))
        rows = rows.withColumn("_same", same & F.col("_read.text").eqNullSafe(F.col("text"))).drop("_read")
    return rows.drop("_same")


def format_conversations(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans (start, length in code points).

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows
    have one order. Null roles and texts count as empty. Turns without a conversation form
    one of their own (null conv_id). ``loss_spans`` cover the bodies of ``learn_role`` as
    they stand in ``formatted``, escapes included. A conversation is one text and so one
    row: its size is bounded by its own turns only. An empty table gives an empty one.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("rendered").cast("long") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = format_turns(turns).withColumn("_at", F.coalesce(before, F.lit(0).cast("long")))
    head = F.instr("rendered", BETWEEN).cast("long") + F.lit(len(BETWEEN) - 1)
    span = F.struct((F.col("_at") + head).alias("start"),
                    (F.length("rendered") - head - F.lit(len(CLOSE))).cast("long").alias("length"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "_at", "rendered", F.when(F.col("role") == learn_role, span).alias("span")))).alias("t"))
    return grouped.select(
        "conv_id",
        F.array_join(F.col("t.rendered"), "\n").alias("formatted"),
        F.filter(F.col("t.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns array of (role, text)) read back from ``formatted`` alone."""
    pieces = F.split("formatted", CLOSE)  # after the last mark nothing is left
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1)),
                        lambda t, i: parse(F.when(i > 0, F.substring(t, 2, 2**31 - 1)).otherwise(t)))
    return formatted.withColumn("turns", turns)
