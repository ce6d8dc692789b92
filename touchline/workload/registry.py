"""Register of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import configure
from touchline.workload.numeric import comparable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, means: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives its result.

    ``means`` are columns shown rounded, as the last digits of a mean depend on row order.
    """

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(configure(spark), sf_dir)
            return plain_types(out.withColumns({c: comparable(F.col(f"`{c}`")) for c in means}) if means else out)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Dates and times as text, so results compare equal across engines."""
    formats = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampType: "yyyy-MM-dd HH:mm:ss",
        T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss",
    }
    dated = {f.name: formats[type(f.dataType)] for f in df.schema if type(f.dataType) in formats}
    return df.withColumns({n: F.date_format(F.col(f"`{n}`"), p) for n, p in dated.items()}) if dated else df
