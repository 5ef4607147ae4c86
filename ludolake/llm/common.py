"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.session import scratch_path, ship_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back; cuts its lineage.

    The files outlive lost executors, and later steps read them instead of computing them again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_name(label: str) -> str:
    """A column name that no input column has."""
    return f"__{label}_{uuid.uuid4().hex[:8]}"


def as_text(column: str | Column) -> Column:
    """The column as a string; null counts as the empty text."""
    column = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def fold_of(key: Column, folds: int) -> Column:
    """Fold number from the key's text by CRC-32; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def agreed(labels: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key (key, value): rows with nulls, and keys whose labels contradict, are left out."""
    return (labels.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key)
            .agg(F.min(value).alias(value), F.max(value).alias("__most"))
            .filter(F.col(value) == F.col("__most")).drop("__most"))


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``bounds``."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
