"""Small frame helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames side by side. The others enter as scalar subqueries, not as joins."""
    for i, other in enumerate(others):
        packed = other.select(F.struct(*other.columns).alias("s")).scalar()
        first = first.withColumn(f"__s{i}", packed)
        first = first.select(*[c for c in first.columns if not c.startswith("__s")], f"__s{i}.*")
    return first


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenation by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def last_n(df: DataFrame, n: int, ts_column: str, id_column: str) -> DataFrame:
    """The newest ``n`` rows; ties on time fall to the larger id."""
    return df.orderBy(F.col(ts_column).desc(), F.col(id_column).desc()).limit(n)


def top_counts(df: DataFrame, column: str, k: int | None = None, name: str = "events") -> DataFrame:
    """Counts per value without nulls, most frequent first, ties by value."""
    counted = (df.filter(F.col(column).isNotNull()).groupBy(column)
               .agg(F.count(F.lit(1)).alias(name)))
    return counted if k is None else counted.orderBy(F.col(name).desc(), F.col(column)).limit(k)


def unpivot_row(df: DataFrame, key: str, value: str, columns: list[str], cast: str) -> DataFrame:
    """A one-row frame turned into (key, value) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(key), F.col(f"`{c}`").cast(cast).alias(value)) for c in columns])))


def counted(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)
