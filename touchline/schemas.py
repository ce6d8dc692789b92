"""Helpers over the declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def measures(schema: str) -> list[str]:
    """Numeric columns of a declared schema, in order."""
    return [f.name for f in struct(schema) if isinstance(f.dataType, T.NumericType)]
