"""Writers for mart tables: parquet folders or a relational database."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, str], None]


def parquet_sink(folder: str, partition_by: Mapping[str, list[str]] | None = None) -> Sink:
    """Overwrite ``folder/<table>``; ``partition_by`` names columns per table."""
    layout = partition_by or {}

    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").partitionBy(*layout.get(table, [])).parquet(f"{folder}/{table}")

    return write


def catalog_sink(database: str, buckets: Mapping[str, tuple[int, str]] | None = None, folder: str | None = None) -> Sink:
    """Overwrite ``database.<table>``; ``buckets`` gives (count, column) per table.

    Tables bucketed alike on their join column are joined without a shuffle.
    """
    layout = buckets or {}

    def write(df: DataFrame, table: str) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        if table in layout:
            count, column = layout[table]
            writer = writer.bucketBy(count, column).sortBy(column)
        if folder:
            writer = writer.option("path", f"{folder}/{table}")
        writer.saveAsTable(f"{database}.{table}")

    return write


def jdbc_options(table: str, env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Connection and writer options. Credentials come from the environment only."""
    absent = [k for k in ("PG_HOST", "PG_DB", "PG_USER", "PG_PASSWORD") if not env.get(k)]
    if absent:
        raise KeyError(f"set {', '.join(absent)}")
    schema = env.get("PG_SCHEMA")
    return {
        "url": f"jdbc:postgresql://{env['PG_HOST']}:{env.get('PG_PORT') or '5432'}/{env['PG_DB']}",
        "dbtable": f"{schema}.{table}" if schema else table,
        "user": env["PG_USER"],
        "password": env["PG_PASSWORD"],
        "driver": "org.postgresql.Driver",
        # Keep the table and its grants on overwrite; bounded parallel writers
        # and large batches protect the database.
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": env.get("PG_WRITERS") or "16",
    }


def jdbc_sink(env: Mapping[str, str] = os.environ, mode: str = "overwrite") -> Sink:
    def write(df: DataFrame, table: str) -> None:
        df.write.format("jdbc").options(**jdbc_options(table, env)).mode(mode).save()

    return write


#: Facts are read by the first digit of their hash key, each part over a connection of its own.
SPLIT_KEYS = {"fact_performance": "performance_id"}


def key_ranges(column: str) -> list[str]:
    """Conditions that part the rows by the first hexadecimal digit of a hash key; null is with the first."""
    digits = "0123456789abcdef"
    return [f"{column} LIKE '{d}%'" + (f" OR {column} IS NULL" if d == "0" else "") for d in digits]


def read_jdbc(spark: SparkSession, table: str, env: Mapping[str, str] = os.environ) -> DataFrame:
    """Table of the serving database; filters and columns are pushed to it, facts are read in parts."""
    keep = ("url", "dbtable", "user", "password", "driver")
    options = {k: v for k, v in jdbc_options(table, env).items() if k in keep}
    if table in SPLIT_KEYS:
        properties = {k: options[k] for k in ("user", "password", "driver")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=key_ranges(SPLIT_KEYS[table]), properties=properties)
    return spark.read.format("jdbc").options(**options).load()


def smoke_test(spark: SparkSession, sink: Sink, table: str = "_smoke_test") -> None:
    """Write one row first, so a broken sink fails before any real work."""
    sink(spark.range(1).select(F.lit(1).alias("id"), F.lit("ok").alias("status")), table)


def load_tables(tables: Mapping[str, DataFrame], sink: Sink) -> dict[str, int]:
    """Write all tables in name order; return rows written per table.

    Rows are counted while they are written, not by a second run of the plan.
    """
    written = {}
    for name in sorted(tables):
        seen = Observation(f"rows_{name}")
        sink(tables[name].observe(seen, F.count(F.lit(1)).alias("rows")), name)
        written[name] = seen.get["rows"]
        log.info("wrote %s: %d rows", name, written[name])
    return written
