"""Versioned cluster models, and a stream that takes a new version at the next micro-batch."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ludolake.operators.kmeans import assign_clusters, fit_clusters, preprocess_features
from ludolake.operators.ranks import label_ranks

VERSIONS = "version BIGINT, path STRING, games BIGINT"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, path, games) of the published models; empty before the first."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{root}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def current(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, path) of the newest model, if there is one."""
    newest = versions(spark, root).orderBy(F.col("version").desc(), F.col("path").desc()).first()
    return (newest["version"], newest["path"]) if newest else None


def publish(games: DataFrame, root: str, **settings) -> int:
    """Fits on raw ``games``, saves the model with its rating ranks, then makes it the newest version.

    The version's one row is written last, in one file that a commit makes visible as a whole: readers see the old version or
    the complete new one, and a refit killed before that leaves a folder that nobody reads. One refit may run at a time.
    """
    spark = games.sparkSession
    path = f"{root}/models/{uuid.uuid4().hex}"
    label_ranks(games, "rating").write.parquet(f"{path}/ranks")
    ready = preprocess_features(games, spark.read.parquet(f"{path}/ranks"))
    fit_clusters(ready, **settings).save(f"{path}/pipeline")
    newest = current(spark, root)
    version = 1 + (newest[0] if newest else 0)
    row = ready.agg(F.lit(version).cast("bigint").alias("version"), F.lit(path).alias("path"), F.count(F.lit(1)).alias("games"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return version


class Scorer:
    """Labels raw games by a published model; keeps the one version it used last."""

    def __init__(self, root: str):
        self.root = root
        self._version, self._model, self._path = 0, None, ""

    def refresh(self, spark: SparkSession) -> int:
        newest = current(spark, self.root)
        if newest is None:
            raise ValueError(f"no model is published under {self.root}")
        if newest[0] != self._version:
            self._version, self._path = newest
            self._model = PipelineModel.load(f"{self._path}/pipeline")
        return self._version

    def label(self, games: DataFrame) -> DataFrame:
        """Valid games with ``cluster`` and ``model_version``; ratings that the fit didn't see rank last, as in the fit."""
        version = self.refresh(games.sparkSession)
        ready = preprocess_features(games, games.sparkSession.read.parquet(f"{self._path}/ranks"))
        labelled = assign_clusters(self._model, ready).drop("features_raw", "features")
        return labelled.withColumn("model_version", F.lit(version).cast("bigint"))


def score_stream(games: DataFrame, root: str, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Scores streamed raw games; each micro-batch looks up the newest version once, when it begins.

    A batch is one folder named by its id. A batch killed at any point runs again and overwrites it, perhaps with a
    newer version, but always one version for the whole batch; ``scored`` reads finished batches only.
    """
    scorer = Scorer(root)

    def write(batch: DataFrame, number: int) -> None:
        scorer.label(batch).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        done = batch.sparkSession.range(1).select(F.lit(number).cast("bigint").alias("number"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{out}/done/batch={number}")

    return (games.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def scored(spark: SparkSession, out: str) -> DataFrame:
    """Labelled games of the finished batches, each row once, with their ``batch``."""
    finished = spark.read.schema("number BIGINT, batch BIGINT").parquet(f"{out}/done").select("batch").distinct()
    return spark.read.parquet(f"{out}/rows").withColumn("batch", F.col("batch").cast("bigint")).join(finished, "batch", "left_semi")
