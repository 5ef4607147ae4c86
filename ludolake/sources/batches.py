"""Recent micro-batches and the combined batch + stream view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.functions.predicates import hours_before, moment
from ludolake.operators.frames import union_all

# Combined data type, (warehouse table or None, stream type).
COMBINED_SOURCES = {
    "reviews": ("reviews", "game_reviews"),
    "logs": ("logs", "server_logs"),
    "player_events": (None, "player_events"),
    "player_stats": (None, "player_stats"),
    "game_metrics": (None, "game_metrics"),
}


def recent_batches(stream: DataFrame, hours_back: float, as_of) -> DataFrame:
    """Rows of batches written from ``hours_back`` before ``as_of`` up to ``as_of``.

    The bounds on ``ingest_date`` and ``ingest_hour`` are partition filters, so older folders are
    not listed as input; ``ingest_time`` then cuts exactly.
    """
    cutoff = hours_before(as_of, hours_back)
    day, hour = F.to_date(cutoff), F.hour(cutoff)
    return stream.filter(
        F.col("ingest_date").between(day, F.to_date(moment(as_of)))
        & ((F.col("ingest_date") > day) | (F.col("ingest_hour") >= hour))
        & F.col("ingest_time").between(cutoff, moment(as_of)))


def read_recent_batches(spark: SparkSession, root: str, event_type: str, hours_back: float,
                        as_of, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return recent_batches(reader.parquet(f"{root}/{event_type}"), hours_back, as_of)


def read_flat_batches(spark: SparkSession, folder: str, hours_back: float, as_of,
                      schema: str | None = None) -> DataFrame:
    """Older layout: ``batch_<yyyyMMdd_HHmmss>.parquet`` files (or folders) in one place.

    Names that do not parse are skipped. The time comes from the file path, a metadata column.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"/batch_([0-9]{8}_[0-9]{6})\.parquet(/|$)", 1)
    written = F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmmss"))
    return (reader.option("recursiveFileLookup", True).option("mergeSchema", schema is None)
            .parquet(folder).filter(written.between(hours_before(as_of, hours_back), moment(as_of))))


def combined_view(data_type: str, batch: DataFrame | None, stream: DataFrame | None) -> DataFrame | None:
    """Batch and stream rows together, by column name; whichever exists; None if neither does."""
    if data_type not in COMBINED_SOURCES:
        raise ValueError(f"unknown data type: {data_type}")
    has_table, _ = COMBINED_SOURCES[data_type]
    frames = [f for f in (batch if has_table else None, stream) if f is not None]
    return union_all(*frames) if frames else None
