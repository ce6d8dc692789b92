"""Scalar clean-up rules: categories, flags, ratios, outcomes, casts, markup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import fixed_values as fv
from touchline.schemas import struct


# Number formats, and the characters a text trim removes.
INTEGER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def canonical(column: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """Replace each known spelling; unknown values and nulls pass through."""
    result = None
    for name, spellings in aliases.items():
        hit = column.isin(*spellings)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return column if result is None else result.otherwise(column)


def rollup_category(column: Column, parents: Mapping[str, str], default: str = fv.UNKNOWN) -> Column:
    """Parent category of a value; unknown values and nulls get ``default``."""
    result = F.lit(default)
    for value, parent in parents.items():
        result = F.when(column == value, parent).otherwise(result)
    return result


def is_positive(column: Column) -> Column:
    """True when above zero; null counts as False."""
    return F.coalesce(column > 0, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0 where the denominator is not above zero."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def outcome(home: Column, away: Column) -> Column:
    """Result of a match; a missing score counts as a draw."""
    return (
        F.when(home > away, fv.HOME_WIN).when(home < away, fv.AWAY_WIN).otherwise(fv.DRAW)
    )


def soft_cast(column: Column, target: str, from_text: bool = True) -> Column:
    """Cast that yields null for malformed text; decimal text truncates to int.

    The text is checked first: a failed cast raises inside the JVM, which costs
    far more than the check when much of a column is malformed.
    """
    if not from_text or target not in ("int", "bigint", "double"):
        return column.try_cast(target)
    number = F.when(column.rlike(NUMBER), column)
    if target == "double":
        return number.try_cast(target)
    fraction = F.when(F.instr(column, ".") > 0, number).try_cast("double").try_cast(target)
    return F.coalesce(F.when(column.rlike(INTEGER), column).try_cast(target), fraction)


def coerce(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Shape ``df`` to ``schema``: soft casts, missing columns become null."""
    actual = {f.name: f.dataType for f in df.schema}
    out = []
    for field in struct(schema):
        kind = field.dataType.simpleString()
        if field.name not in actual:
            column = F.lit(None).cast(kind)
        elif actual[field.name] == field.dataType:
            column = F.col(field.name)
        else:
            from_text = isinstance(actual[field.name], T.StringType)
            column = soft_cast(F.col(field.name), kind, from_text)
        out.append(column.alias(field.name))
    return df.select(*out)


def strip_markup(text: Column) -> Column:
    """Text without list, heading and link markup, trimmed of all white space."""
    for mark in fv.SPEECH_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    for pattern, replacement in fv.SPEECH_PATTERNS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.btrim(text, F.lit(WHITE_SPACE))
