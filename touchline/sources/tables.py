"""Columnar tables and CSV files with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchline import fixed_values as fv
from touchline.functions.cleaning import coerce
from touchline.schemas import struct
from touchline.session import scratch_path


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """Parquet table; column pruning and filters reach the scan.

    With a declared schema no file is opened to build the plan.
    """
    reader = spark.read.schema(struct(schema)) if schema else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Rows of a scan over all cores, when its files make fewer tasks than that.

    For costly per-row work on a small input. A large input has enough splits
    and passes through unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)


def stored(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back.

    The folder is added to ``made``, for the job to remove when it ends.

    Readers scan only the columns they need, a lost executor does not recompute
    what came before, and Spark knows the size when it picks a join.
    """
    path = scratch_path(df.sparkSession, name)
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; malformed values become null."""
    return (
        spark.read.schema(struct(schema))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_csv_optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """CSV matched by header name and coerced to ``schema``, or None if absent.

    Columns are read as text, so no extra pass infers types, and then cast
    softly; columns the file lacks become null.
    """
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if missing_path(error):
            return None
        raise
    return coerce(raw, struct(schema))


def read_parquet_optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Parquet at ``path``, or an empty frame of the full schema if absent."""
    try:
        return spark.read.schema(struct(schema)).parquet(path)
    except AnalysisException as error:
        if missing_path(error):
            return empty(spark, schema)
        raise


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], struct(schema))


def read_gold_inputs(spark: SparkSession, folder: str, prefix: str = fv.GOLD_PREFIX) -> dict[str, DataFrame | None]:
    """All gold inputs by logical name, each from its exact file name; absent files are None."""
    schemas = {
        "matches": fv.MATCH_SCHEMA,
        "attendance": fv.ATTENDANCE_SCHEMA,
        "team_kpis": fv.TEAM_KPI_SCHEMA,
        "marketing": fv.MARKETING_SCHEMA,
        "player_match": fv.PLAYER_MATCH_SCHEMA,
        "standings": fv.STANDINGS_SCHEMA,
        "snapshot": fv.SNAPSHOT_SCHEMA,
    }
    return {
        name: read_csv_optional(spark, f"{folder.rstrip('/')}/{file.format(prefix=prefix)}", schemas[name])
        for name, file in fv.GOLD_FILES.items()
    }


def require(inputs: Mapping[str, object | None], names: Iterable[str] = fv.REQUIRED_GOLD_INPUTS) -> None:
    """Raise when a required input is absent."""
    absent = [n for n in names if inputs.get(n) is None]
    if absent:
        raise FileNotFoundError(f"required inputs are missing: {', '.join(absent)}")
