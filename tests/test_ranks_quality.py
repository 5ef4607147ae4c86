"""Rank index, label ranks, and quality measures of one or many clusterings against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ludolake.operators import clusters, kmeans
from ludolake.operators.ranks import RankIndex, label_ranks


def test_label_ranks_are_those_of_the_indexer(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["Mixed", "Positive", "Ünï", "x", None]),) for _ in range(200)] + [(f"l{i % 900}",) for i in range(1500)]
    df = spark.createDataFrame(rows, "rating STRING")
    for order in ("frequencyDesc", "alphabetAsc"):
        indexer = StringIndexer(inputCol="rating", outputCol="i", handleInvalid="keep", stringOrderType=order)
        both = indexer.fit(df).transform(kmeans.encode_rating(df, order))
        assert both.count() == 1700 and both.filter("NOT i <=> rating_encoded").count() == 0
    assert label_ranks(df.limit(0), "rating").count() == 0
    assert kmeans.encode_rating(df.filter("rating IS NULL").limit(1)).first()["rating_encoded"] == 0.0


def test_pages_by_rank(spark, capsys):
    rng = random.Random(1)
    rows = [(rng.choice([None, "", "a", "zoë", f"t{rng.randint(0, 99)}"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "title STRING, id INT")
    index = RankIndex.build(df, [F.col("title").asc_nulls_first(), F.col("id")], ranges=12)
    plain = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    for offset, limit in ((2700, 100), (2990, 50), (3000, 10), (1, 2999)):
        page = index.page(offset, limit).collect()
        assert [(r.title, r.id) for r in page] == plain[offset:offset + limit]
        assert all(r.total == 3000 and r.has_more == (offset + limit < 3000) for r in page)
    assert [(r.title, r.id) for r in index.numbered().orderBy("place").collect()] == plain
    ranges = index.ranges().collect()
    assert len(ranges) > 4 and sum(r.n for r in ranges) == 3000
    index.page(2700, 20).explain()
    assert "dynamicpruning" in capsys.readouterr().out
    assert RankIndex.build(df.limit(0), [F.col("id")]).page(0, 10).count() == 0


def plain_scores(points, labels):
    """Inertia, Calinski-Harabasz, Davies-Bouldin and squared silhouette, straight from their definitions."""
    x, y = np.array(points), np.array(labels)
    names, center = sorted(set(labels)), x.mean(axis=0)
    mean = {c: x[y == c].mean(axis=0) for c in names}
    inertia = sum(((x[y == c] - mean[c]) ** 2).sum() for c in names)
    between = sum((y == c).sum() * ((mean[c] - center) ** 2).sum() for c in names)
    spread = {c: np.sqrt(((x[y == c] - mean[c]) ** 2).sum(axis=1)).mean() for c in names}
    worst = [max((spread[a] + spread[b]) / np.linalg.norm(mean[a] - mean[b]) for b in names if b != a) for a in names]
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    values = []
    for i, c in enumerate(labels):
        own = (y == c).sum()
        if own == 1:
            values.append(0.0)
            continue
        a, b = far[i][y == c].sum() / (own - 1), min(far[i][y == o].mean() for o in names if o != c)
        values.append((b - a) / max(a, b))
    k, n = len(names), len(points)
    return inertia, between / (k - 1) / (inertia / (n - k)), sum(worst) / k, sum(values) / n


@pytest.mark.parametrize("broadcast_bytes, tile", [(1 << 25, 1024), (0, 3)])
def test_many_clusterings_at_once(spark, broadcast_bytes, tile):
    rng = random.Random(7)
    points = [[rng.gauss(0, 1), rng.gauss(5, 2), rng.random()] for _ in range(120)]
    rows = [(g, "hot" if rng.random() < 0.5 else f"c{i % g}", *p) for g in (2, 5, 11) for i, p in enumerate(points)]
    rows += [(5, "alone", 9.0, 9.0, 9.0), (5, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g INT, label STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    axes = ["a", "b", "c"]
    found = {r.g: r for r in clusters.cluster_quality(df, axes, "label", ["g"], broadcast_bytes, tile).collect()}
    shapes = {r.g: r.silhouette for r in clusters.silhouettes(df, axes, "label", ["g"]).collect()}
    for g in (2, 5, 11):
        mine = [r for r in rows if r[0] == g and r[1] is not None]
        want = plain_scores([r[2:] for r in mine], [r[1] for r in mine])
        row = found[g]
        got = (row.inertia, row.calinski_harabasz, row.davies_bouldin, shapes[g])
        assert row.n == len(mine) and row.k == len({r[1] for r in mine})
        assert all(math.isclose(p, q, rel_tol=1e-9) for p, q in zip(want, got))
        one = clusters.cluster_quality(df.filter(f"g = {g}"), axes, "label", None, broadcast_bytes, tile).first()
        assert math.isclose(one.davies_bouldin, row.davies_bouldin, rel_tol=1e-9) and one.k == row.k


def test_silhouette_is_that_of_the_evaluator(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i % 4, rng.random() + i % 4, rng.random()) for i in range(400)], "cluster INT, a DOUBLE, b DOUBLE")
    packed = df.select("cluster", array_to_vector(F.array("a", "b")).alias("features"))
    assert math.isclose(clusters.silhouettes(df, ["a", "b"]).first()[0], kmeans.silhouette(packed), rel_tol=1e-9)


def test_no_rows_and_one_label(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0)], "cluster INT, a DOUBLE")
    one = clusters.cluster_quality(df, ["a"]).first()
    assert (one.k, one.n, one.inertia, one.calinski_harabasz, one.davies_bouldin) == (1, 2, 2.0, None, None)
    empty = clusters.cluster_quality(df.limit(0), ["a"]).first()
    assert empty.k == 0 and empty.calinski_harabasz is None


def test_rows_of_a_small_file_are_not_broadcast(spark, tmp_path):
    """Exploded rows of a file below the broadcast limit stay where they are; both ways give one result."""
    spark.range(3000).selectExpr("id % 7 AS a", "id % 5 * 1.5 AS b", "id").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).withColumn("g", F.explode(F.lit([2, 3, 4])))
    rows = rows.withColumn("label", F.col("id") % F.col("g"))
    means = clusters.silhouettes(rows, ["a", "b"], "label", ["g"])
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    salted = clusters.silhouettes(rows, ["a", "b"], "label", ["g"], broadcast_bytes=0)
    assert "BroadcastHashJoin" not in salted._jdf.queryExecution().executedPlan().toString()
    one, other = ({r.g: r.silhouette for r in df.collect()} for df in (means, salted))
    assert one.keys() == other.keys() == {2, 3, 4} and all(math.isclose(one[g], other[g], rel_tol=1e-9) for g in one)
