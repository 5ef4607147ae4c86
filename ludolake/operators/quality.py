"""Checks over file listings (path, length, modificationTime)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.functions.predicates import hours_before, moment
from ludolake.operators.frames import beside

# Expected warehouse tables, retention in days, smallest sound file.
EXPECTED_TABLES = ["reviews", "games", "logs", "configs", "catalog"]
RETENTION_DAYS = {"raw": 90, "logs": 30, "metrics": 365}
MIN_FILE_BYTES = 1024


def table_name(path: str = "path") -> Column:
    return F.regexp_extract(path, r"([^/]+)\.parquet(/|$)", 1)


def missing_tables(files: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Expected tables that have no file."""
    names = files.sparkSession.createDataFrame([(t,) for t in (expected or EXPECTED_TABLES)], "table_name STRING")
    present = files.select(table_name().alias("table_name")).distinct()
    return names.join(present, "table_name", "left_anti")


def file_completeness(files: DataFrame, expected: list[str] | None = None) -> DataFrame:
    names = expected or EXPECTED_TABLES
    gaps = missing_tables(files, names).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("table_name")).alias("missing_files"))
    return gaps.select(((F.lit(float(len(names))) - F.col("n")) / F.lit(float(len(names))) * F.lit(100.0))
                       .alias("score"), "missing_files")


def file_freshness(files: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Share of files changed within the last hours; 0 without files."""
    fresh = F.count_if((F.col("modificationTime") > hours_before(as_of, hours))
                       & (F.col("modificationTime") <= moment(as_of)))
    return files.agg(
        F.coalesce(F.try_divide(fresh, F.count(F.lit(1))) * F.lit(100.0), F.lit(0.0)).alias("score"),
        fresh.alias("fresh_files"), F.count(F.lit(1)).alias("total_files"))


def file_size_check(files: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """Share of files of a plausible size; 100 without files."""
    small = F.count_if(F.col("length") < min_bytes)
    n = F.count(F.lit(1))
    return files.agg(F.coalesce(F.try_divide(n - small, n) * F.lit(100.0), F.lit(100.0)).alias("score"),
                     small.alias("small_files"))


def small_files(files: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    return files.filter(F.col("length") < min_bytes)


def quality_score(files: DataFrame, as_of, expected: list[str] | None = None) -> DataFrame:
    """Mean of completeness, freshness and size scores, its grade, and the issues found."""
    row = beside(
        file_completeness(files, expected).select(F.col("score").alias("completeness"), "missing_files"),
        file_freshness(files, as_of).select(F.col("score").alias("freshness")),
        file_size_check(files).select(F.col("score").alias("size_consistency"), "small_files"))
    overall = (F.col("completeness") + F.col("freshness") + F.col("size_consistency")) / F.lit(3.0)
    issues = F.filter(F.array(
        F.when(F.size("missing_files") > 0, F.concat(F.lit("Missing files: "), F.array_join("missing_files", ", "))),
        F.when(F.col("freshness") < 50, F.lit("Data freshness below 50%")),
        F.when(F.col("small_files") > 0, F.lit("Suspiciously small files"))), lambda x: x.isNotNull())
    return row.withColumns({"overall_score": overall, "issues": issues}).withColumn(
        "grade", F.when(F.col("overall_score") >= 90, F.lit("excellent"))
        .when(F.col("overall_score") >= 70, F.lit("needs attention")).otherwise(F.lit("critical")))


def expired_files(files: DataFrame, days: int, as_of) -> DataFrame:
    """Files past their retention. Only reported; nothing is deleted."""
    return files.filter(F.col("modificationTime") < hours_before(as_of, days * 24))


def storage_stats(files: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Files, megabytes and counted records."""
    size = files.agg(F.count(F.lit(1)).alias("total_files"),
                     F.coalesce(F.sum("length") / F.lit(1024.0 * 1024.0), F.lit(0.0)).alias("total_size_mb"))
    counts = [t.agg(F.count(F.lit(1)).alias(f"{name}__n")) for name, t in tables.items()]
    row = beside(size, *counts)
    total = F.lit(0).cast("bigint")
    for name in tables:
        total = total + F.col(f"{name}__n")
    return row.select("total_files", "total_size_mb", total.alias("total_records"))
