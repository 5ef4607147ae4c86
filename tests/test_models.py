"""Versioned models: a running stream takes a refit at a batch boundary."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ludolake.streaming import models


@pytest.fixture
def games(spark):
    from ludolake.plans.views import Lake

    return spark.createDataFrame(Lake(spark, "/root/testdata/sf0.001").games.collect()).persist()


def test_a_refit_changes_the_running_stream(spark, games, tmp_path):
    root, out, arriving = str(tmp_path / "models"), str(tmp_path / "out"), str(tmp_path / "in")
    assert models.current(spark, root) is None and models.versions(spark, root).count() == 0
    first, second = games.filter("app_id % 2 = 0"), games.filter("app_id % 2 = 1")
    assert models.publish(games, root, k=2, initSteps=2) == 1
    first.write.parquet(f"{arriving}/a")
    stream = spark.readStream.schema(games.schema).option("recursiveFileLookup", True).parquet(arriving)
    run = models.score_stream(stream, root, out, str(tmp_path / "checkpoint"), {"processingTime": "100 milliseconds"})
    try:
        run.processAllAvailable()
        before = run.runId
        assert models.publish(games, root, k=4, initSteps=2) == 2
        second.write.parquet(f"{arriving}/b")
        run.processAllAvailable()
        assert run.isActive and run.runId == before
    finally:
        run.stop()
        run.awaitTermination()
    rows = models.scored(spark, out).groupBy("model_version", F.col("app_id") % 2).agg(
        F.count(F.lit(1)).alias("n"), F.max("cluster").alias("top")).orderBy("model_version").collect()
    assert [(r.model_version, r[1], r.n) for r in rows] == [(1, 0, first.count()), (2, 1, second.count())]
    assert rows[0].top <= 1 < rows[1].top

    # batch scoring by the same version gives the labels that the stream gave
    batch = models.Scorer(root).label(games).select("app_id", "cluster")
    stream_rows = models.scored(spark, out).filter("model_version = 2").select("app_id", "cluster")
    assert stream_rows.exceptAll(batch).count() == 0

    # an unfinished batch and an unpublished model aren't read
    games.withColumn("cluster", F.lit(0)).write.parquet(f"{out}/rows/batch=99")
    games.write.parquet(f"{root}/models/halfway/ranks")
    assert models.scored(spark, out).filter("batch = 99").count() == 0
    assert models.current(spark, root)[0] == 2


def test_unknown_ratings_and_no_model(spark, games, tmp_path):
    root = str(tmp_path / "models")
    with pytest.raises(ValueError, match="no model"):
        models.Scorer(root).refresh(spark)
    models.publish(games, root, k=2, initSteps=2)
    odd = games.limit(2).withColumn("rating", F.lit("Never seen"))
    labels = models.Scorer(root).label(odd.unionByName(games.limit(1).withColumn("rating", F.lit(None).cast("string"))))
    known = games.select("rating").distinct().count()
    assert {r.rating_encoded for r in labels.collect()} == {float(known)}
    assert models.Scorer(root).label(games.limit(0)).count() == 0
