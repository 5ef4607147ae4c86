"""Topics with their rejects: every record ends up accepted or rejected, once, also after a kill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ludolake.functions.predicates import REQUIRED_GAME_FIELDS
from ludolake.operators.enrich import ENRICHERS
from ludolake.schemas import EVENT_SCHEMAS

_CORRUPT = "_corrupt"


def judged_records(records: DataFrame, topic_key: str) -> DataFrame:
    """Key/value records with their decoded body ``e``, and ``reason``: null if accepted.

    Reasons: ``undecodable`` (null, no JSON object, or a field of another kind than the topic's schema says) and
    ``missing_fields`` (a streamed game without a required field, named in ``missing_fields``).
    """
    schema = T.StructType([*T.StructType.fromDDL(EVENT_SCHEMAS[topic_key]).fields, T.StructField(_CORRUPT, T.StringType())])
    value = F.col("value").cast("string")
    body = F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = records.select(F.col("key").cast("string").alias("record_key"), value.alias("value"), body.alias("e"))
    bad = F.col("e").isNull() | F.col(f"e.{_CORRUPT}").isNotNull()
    missing = F.array().cast("array<string>")
    if topic_key == "games_stream":
        missing = F.filter(F.array(*[F.when(F.col(f"e.{c}").isNull(), F.lit(c)) for c in REQUIRED_GAME_FIELDS]),
                           lambda name: name.isNotNull())
    return (rows.withColumn("missing_fields", F.when(~bad, missing))
            .withColumn("reason", F.when(bad, F.lit("undecodable")).when(F.size("missing_fields") > 0, F.lit("missing_fields"))))


def accepted_events(judged: DataFrame, topic_key: str, processed_at: Column | None = None) -> DataFrame:
    """The accepted records as enriched events."""
    events = judged.filter("reason is null").select("record_key", "e.*").drop(_CORRUPT)
    return ENRICHERS[topic_key](events, processed_at)


def rejected_records(judged: DataFrame) -> DataFrame:
    """The rejected records as they came, with the reason."""
    return judged.filter("reason is not null").select("record_key", "value", "reason", "missing_fields")


def stream_with_rejects(records: DataFrame, topic_key: str, root: str, checkpoint: str,
                        processed_at: Column | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Writes each micro-batch's accepted and rejected records under ``root``, then the batch's commit.

    The outputs of a batch are folders named by its id. A batch that was killed at any point runs again with the same
    records and id and overwrites what it left, and readers (``committed``) only see batches with a commit, so
    accepted and rejected records together are always exactly the records of the committed batches.
    """
    def write(batch: DataFrame, number: int) -> None:
        judged = judged_records(batch, topic_key).persist()
        try:
            accepted_events(judged, topic_key, processed_at).write.mode("overwrite").parquet(
                _folder(root, "accepted", topic_key, number))
            rejected_records(judged).write.mode("overwrite").parquet(_folder(root, "rejected", topic_key, number))
            (judged.agg(F.count_if(F.col("reason").isNull()).alias("accepted"),
                        F.count_if(F.col("reason").isNotNull()).alias("rejected"))
             .write.mode("overwrite").parquet(_folder(root, "commits", topic_key, number)))
        finally:
            judged.unpersist()

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def _folder(root: str, kind: str, topic_key: str, number: int) -> str:
    return f"{root}/{kind}/{topic_key}/batch={number}"


def commits(spark: SparkSession, root: str, topic_key: str) -> DataFrame:
    """(batch, accepted, rejected) of the committed batches."""
    return (spark.read.schema("accepted BIGINT, rejected BIGINT, batch BIGINT")
            .parquet(f"{root}/commits/{topic_key}"))


def committed(spark: SparkSession, root: str, kind: str, topic_key: str, schema: T.StructType | str) -> DataFrame:
    """``accepted`` or ``rejected`` rows of the committed batches, with their ``batch``."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(
        f"{root}/{kind}/{topic_key}")
    return rows.join(commits(spark, root, topic_key).select("batch").distinct(), "batch", "left_semi")


REJECTED = "record_key STRING, value STRING, reason STRING, missing_fields ARRAY<STRING>"


def reject_counts(spark: SparkSession, root: str, topic_keys: list[str]) -> DataFrame:
    """Committed records by topic and outcome; outcomes other than ``accepted`` are reasons."""
    parts = []
    for topic in topic_keys:
        parts.append(commits(spark, root, topic).groupBy(F.lit("accepted").alias("outcome")).agg(F.sum("accepted").alias("records"))
                     .select(F.lit(topic).alias("topic"), "outcome", "records"))
        parts.append(committed(spark, root, "rejected", topic, REJECTED).groupBy(F.col("reason").alias("outcome"))
                     .agg(F.count(F.lit(1)).alias("records")).select(F.lit(topic).alias("topic"), "outcome", "records"))
    return reduce(DataFrame.unionByName, parts)
