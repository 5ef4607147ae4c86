"""File readers. Each takes an explicit schema or explicit patterns and stays splittable where
the format allows it (CSV, line logs, review blocks, XML rows, separated YAML documents)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake import schemas

# Review block separator, log line pattern, player pattern.
REVIEW_SEPARATOR = "-" * 80
LOG_LINE = r"^\[(.*?)\] (\w+): (.*?) - (.*)"
PLAYER = r"player_[0-9]+"


def read_games_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GAMES).option("header", True).csv(path)


def _field(name: str) -> Column:
    """Value of the last ``name:`` line of a block, trimmed; null when the block has none."""
    lines = F.regexp_extract_all("value", F.lit(rf"(?md)^[ \t]*{name}:([^\n]*)$"), F.lit(1))
    return F.btrim(F.try_element_at(lines, F.lit(-1)), F.lit(" \t\r"))


def read_review_records(spark: SparkSession, path: str) -> DataFrame:
    """Reviews from text blocks closed by a line of 80 dashes.

    The separator line is the record delimiter, so large files split across tasks.
    """
    blocks = spark.read.text(path, lineSep=f"\n{REVIEW_SEPARATOR}\n")
    votes = F.regexp_extract_all(_field("Helpful"), F.lit("([0-9]+)"), F.lit(1))
    both = F.size(votes) == 2
    hours = F.regexp_extract(_field("Playtime"), "([0-9]+)", 1)
    parsed = blocks.select(
        _field("Review ID").alias("review_id"), _field("Date").alias("timestamp"),
        hours.try_cast("int").alias("playtime_hours"),
        F.when(both, votes[0].try_cast("int")).alias("helpful_votes"),
        F.when(both, votes[1].try_cast("int")).alias("total_votes"),
        _field("Review").alias("text"))
    present = [F.col(c).isNotNull() for c in ("review_id", "timestamp", "playtime_hours", "text")]
    keep = present[0]
    for check in present[1:]:
        keep = keep | check
    return parsed.filter(keep)


def read_games_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested games. A JSON array needs ``multi_line`` (one task per file); JSON lines split."""
    return spark.read.schema(schemas.GAMES_DOCUMENT).json(path, multiLine=multi_line)


def _flatten_documents(names: list[str]):

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for text in batch["value"]:
                for document in yaml.safe_load_all(text):
                    if not isinstance(document, dict):
                        continue
                    flat = {}
                    for key, value in document.items():
                        if isinstance(value, dict):
                            flat.update({f"{key}_{inner}": v for inner, v in value.items()})
                        else:
                            flat[key] = value
                    rows.append([flat.get(n) for n in names])
            yield pd.DataFrame(rows, columns=names).astype(object).where(lambda x: x.notna(), None)

    return parse


def read_config_yaml(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """YAML documents, one level flattened to ``<section>_<key>``.

    Files may hold one document or many, separated by ``---`` lines; the separator is the record
    delimiter, so a large file of many documents still splits.
    """
    schema = schema or schemas.SERVER_CONFIG
    documents = spark.read.text(path, lineSep="\n---\n")
    return documents.mapInPandas(_flatten_documents(schemas.names(schema)), schema)


def read_catalog_xml(spark: SparkSession, path: str) -> DataFrame:
    """Catalog entries; elements that are absent become null."""
    raw = (spark.read.format("xml").option("rowTag", "game")
           .schema(schemas.CATALOG_ELEMENT).load(path))
    return raw.select(
        F.col("_id").alias("id"), F.col("basic_info.name").alias("name"),
        F.col("basic_info.developer").alias("developer"),
        F.col("basic_info.release_date").alias("release_date"),
        F.col("reviews_summary.total_count").alias("total_reviews"),
        F.col("reviews_summary.average_rating").alias("avg_rating"),
        F.col("reviews_summary.recommendation_rate").alias("recommendation_rate"),
        F.col("pricing.base_price._VALUE").alias("base_price"),
        F.col("pricing.current_price._VALUE").alias("current_price"))


def parse_server_logs(lines: DataFrame) -> DataFrame:
    """Log lines (column ``value``) to timestamp, level, action, player_id; others are dropped."""
    def part(i: int) -> Column:
        return F.regexp_extract("value", LOG_LINE, i)

    return (lines.filter(F.col("value").rlike(LOG_LINE))
            .select(part(1).alias("timestamp"), part(2).alias("level"), part(3).alias("action"),
                    F.nullif(F.regexp_extract(part(4), PLAYER, 0), F.lit("")).alias("player_id")))


def read_server_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_server_logs(spark.read.text(path))


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, zone: str, name: str, schema: str | None = None) -> DataFrame:
    """A warehouse table; with ``schema``, columns the files lack come as null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(zone, name))


def batch_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length, modificationTime of the files below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root)
            .select("path", "length", "modificationTime"))
