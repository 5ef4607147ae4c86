"""Batch and stream writers. Nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ludolake.functions.features import CLUSTER_FEATURES
from ludolake.sources.files import table_path

CLUSTER_COLUMNS = ["app_id", "title", "rating", "user_reviews", "cluster"]


def batch_columns(df: DataFrame, ingest_time: Column) -> DataFrame:
    """Adds the columns micro-batches are laid out by."""
    return df.withColumns({
        "ingest_time": ingest_time.cast("timestamp"),
        "ingest_date": F.to_date(ingest_time.cast("timestamp")),
        "ingest_hour": F.hour(ingest_time.cast("timestamp")),
    })


LAYOUT = ["ingest_date", "ingest_hour"]
FILES_AN_HOUR = 4  # files of an hour where their number is fixed: compaction, and games that a fit reads


def _gathered(df: DataFrame) -> DataFrame:
    """Rows dealt by hour: a write adds one file to an hour, and one more for each advisory partition size that the hour exceeds.

    So the number of files follows from the hours and the bytes, and a busy hour has as many tasks as its size asks for.
    """
    return df.hint("rebalance", *LAYOUT)


def _limited(df: DataFrame, files: int) -> DataFrame:
    """Rows dealt so that a write adds at most ``files`` files to an hour, whatever its size."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    return df.repartition(*LAYOUT, salt)


def write_stream_batches(stream: DataFrame, event_type: str, root: str, checkpoint: str,
                         ingest_time: Column | None = None, trigger: dict | None = None,
                         files: int | None = None) -> StreamingQuery:
    """Micro-batch Parquet sink, every 30 seconds unless told otherwise.

    With ``files``, each hour is spread evenly over so many files; else their number follows from its bytes.

    Each event type has its own folder, as the log of committed files belongs to one query. The
    rows per batch are capped at the source (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``).
    Offsets and files are tracked, so a restart neither loses nor repeats rows.
    """
    stamped = batch_columns(stream, F.current_timestamp() if ingest_time is None else ingest_time)
    dealt = _gathered(stamped) if files is None else _limited(stamped, files)
    return (dealt.writeStream.format("parquet").partitionBy(*LAYOUT)
            .option("path", f"{root}/{event_type}").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def write_batches(df: DataFrame, event_type: str, root: str, ingest_time: Column) -> None:
    """The same layout from a batch frame."""
    stamped = batch_columns(df, ingest_time)
    _gathered(stamped).write.mode("append").partitionBy(*LAYOUT).parquet(f"{root}/{event_type}")


def compact_batches(spark: SparkSession, root: str, event_type: str, target: str, day: str,
                    files: int = FILES_AN_HOUR) -> None:
    """The micro-batches of a past day written again under ``target``, with at most ``files`` files an hour.

    The stream's folder and its log stay as they are; running again replaces the day, nothing else.
    """
    rows = spark.read.parquet(f"{root}/{event_type}").filter(F.col("ingest_date") == F.lit(day).cast("date"))
    (_limited(rows, files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LAYOUT).parquet(f"{target}/{event_type}"))


def write_clusters(df: DataFrame, base: str, run_stamp: str) -> tuple[str, str]:
    """The clusters table under its run stamp, then as ``latest``, read back from the first write."""
    present = CLUSTER_COLUMNS + [c for c in CLUSTER_FEATURES if c not in CLUSTER_COLUMNS]
    stamped = table_path(f"{base}/clusters", f"games_clusters_{run_stamp}")
    latest = table_path(f"{base}/latest", "games_clusters_latest")
    df.select(*[c for c in present if c in df.columns]).write.mode("overwrite").parquet(stamped)
    df.sparkSession.read.parquet(stamped).write.mode("overwrite").parquet(latest)
    return stamped, latest


def write_cluster_analysis(document: DataFrame, base: str, run_stamp: str) -> tuple[str, str]:
    """The analysis document as JSON, stamped and latest."""
    stamped = f"{base}/analysis/cluster_analysis_{run_stamp}.json"
    latest = f"{base}/latest/cluster_analysis_latest.json"
    document.write.mode("overwrite").json(stamped)
    document.sparkSession.read.schema(document.schema).json(stamped).write.mode("overwrite").json(latest)
    return stamped, latest


def write_warehouse_table(df: DataFrame, zone: str, name: str, mode: str = "overwrite") -> str:
    path = table_path(zone, name)
    df.write.mode(mode).parquet(path)
    return path


def _json_safe(column: str, dtype: T.DataType) -> Column:
    c = F.col(f"`{column}`")
    return F.when(~F.isnan(c), c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c


def to_kafka_records(df: DataFrame, key_column: str) -> DataFrame:
    """(key, value): text key and one JSON object per row; NaN is written as null."""
    body = F.struct(*[_json_safe(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
    return df.select(F.col(key_column).cast("string").alias("key"),
                     F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_report(report: DataFrame, path: str) -> str:
    """Audit and quality reports as JSON lines."""
    report.write.mode("overwrite").json(path)
    return path
