"""Many K-Means fits in shared passes, against Spark ML's fits of one."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ludolake.operators import kmeans
from ludolake.operators.kmeans_many import fit_many, with_labels


def rows_of(spark, points):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "app_id INT, v0 DOUBLE, v1 DOUBLE")
    return df.withColumn("draw", F.xxhash64("app_id", "v0", "v1"))


def test_costs_are_those_of_single_fits(spark):
    rng = random.Random(5)
    points = [(rng.gauss(0, 0.3) + i % 4 * 3, rng.gauss(0, 0.3) + i % 2 * 4) for i in range(400)]
    df = rows_of(spark, points)
    packed = df.select(array_to_vector(F.array("v0", "v1")).alias("features")).persist()
    found = kmeans.best_of(df, ["v0", "v1"], [2, 4], 6, 42)
    labels = with_labels(df, ["v0", "v1"], {f"c{k}": c for k, (c, _) in found.items()}).collect()
    for k, (centers, cost) in found.items():
        single = min(KMeans(k=k, seed=42 + i, maxIter=100).fit(packed).summary.trainingCost for i in range(6))
        x, mine = np.array([r[:2] for r in labels]), np.array([r[f"c{k}"] for r in labels])
        assert cost <= single * 1.001 and len(centers) == k
        assert cost == pytest.approx(((x - centers[mine]) ** 2).sum())
        assert centers == pytest.approx(np.array([x[mine == j].mean(axis=0) for j in range(k)]), abs=1e-3)
    packed.unpersist()


def test_partitions_change_nothing(spark):
    rng = random.Random(6)
    df = rows_of(spark, [(rng.random(), rng.random()) for _ in range(300)])
    fits = [(3, 1), (3, 2), (7, 1)]
    one, other = (fit_many(df.repartition(n), ["v0", "v1"], fits) for n in (1, 7))
    for (a, x), (b, y) in zip(one, other):
        assert x == pytest.approx(y) and a == pytest.approx(b)


def test_fewer_distinct_rows_than_centers(spark):
    df = rows_of(spark, [(1.0, 1.0), (5.0, 5.0)] * 10)
    (centers, cost), = fit_many(df, ["v0", "v1"], [(4, 3)])
    assert cost == pytest.approx(0.0) and sorted(map(tuple, centers)) == [(1.0, 1.0), (5.0, 5.0)]
    with pytest.raises(ValueError):
        fit_many(df.limit(0), ["v0", "v1"], [(2, 1)])


def test_a_sweep_shares_its_passes(spark):
    """The number of jobs follows from the slowest fit, not from the number of fits."""
    rng = random.Random(8)
    df = rows_of(spark, [(rng.gauss(i % 3 * 9, 1), rng.gauss(i % 3 * 9, 1)) for i in range(150)]).drop("draw")
    spark.sparkContext.setJobGroup("sweep", "sweep")
    try:
        scores = kmeans.sweep_k(df, ["v0", "v1"], ks=range(2, 8), restarts=10)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.k for r in scores.orderBy("k").collect()] == list(range(2, 8))
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("sweep")) < 200
