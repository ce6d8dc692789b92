"""Vectors for text chunks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 64


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def hash_buckets(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Bucket of each token: its MD5 prefix modulo the vector length."""
    return F.transform(
        tokens(text),
        lambda t: F.pmod(
            F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"), F.lit(dimensions)
        ).cast("int"),
    )


def hashed_vectors(df: DataFrame, text: str, dimensions: int = DIMENSIONS, vector: str = "vector") -> DataFrame:
    """Token counts per bucket. Hashing stays in the JVM; Python only counts."""

    @F.pandas_udf("array<float>")
    def count(buckets: pd.Series) -> pd.Series:
        sizes = buckets.map(len).to_numpy(dtype=np.int64)
        flat = np.concatenate([*buckets, np.empty(0, np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        counts = np.bincount(row * dimensions + flat, minlength=len(sizes) * dimensions)
        return pd.Series(list(counts.reshape(len(sizes), dimensions).astype(np.float32)))

    filled = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn(vector, count(hash_buckets(filled, dimensions)))


def model_vectors(
    df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], vector: str = "vector"
) -> DataFrame:
    """Vectors from any local function that maps a list of texts to a matrix."""

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        matrix = np.asarray(model(texts.fillna("").tolist()), dtype=np.float32)
        return pd.Series(list(matrix))

    return df.withColumn(vector, encode(F.col(text)))
