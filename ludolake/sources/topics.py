"""Event topics: JSON values decoded with one schema per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.schemas import EVENT_SCHEMAS, TOPICS


def decode_records(records: DataFrame, topic_key: str) -> DataFrame:
    """Key and JSON value (binary or text) to event columns; records that are not JSON are dropped."""
    body = F.from_json(F.col("value").cast("string"), EVENT_SCHEMAS[topic_key], {"mode": "PERMISSIVE"})
    return (records.select(F.col("key").cast("string").alias("record_key"), body.alias("e"))
            .filter(F.col("e").isNotNull()).select("record_key", "e.*"))


def read_event_stream(spark: SparkSession, topic_key: str, servers: str,
                      max_offsets: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Decoded stream of one topic, from the latest offsets; offsets live in the sink's checkpoint."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", TOPICS[topic_key]).option("startingOffsets", "latest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return decode_records(reader.load(), topic_key)


def read_record_files(spark: SparkSession, path: str, topic_key: str,
                      max_files: int | None = None) -> DataFrame:
    """The same stream out of Parquet files of (key, value) records, for replays and tests."""
    reader = spark.readStream.schema("key STRING, value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode_records(reader.parquet(path), topic_key)
