"""K-Means on Spark ML: feature preparation, fitting, evaluation and the search for k."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.functions.features import CLUSTER_FEATURES, fill_defaults, with_features
from ludolake.functions.predicates import valid_games
from ludolake.operators.clusters import cluster_distribution, cluster_quality, silhouettes
from ludolake.operators.kmeans_many import fit_many, with_labels
from ludolake.operators.ranks import label_ranks
from ludolake.operators.search import sample_rows
from ludolake.session import scratch_path

# Fit settings of the clustering job and of the study.
JOB = {"k": 13, "seed": 42, "maxIter": 100, "tol": 1e-4, "initMode": "k-means||", "initSteps": 5}
STUDY = {"ks": range(2, 16), "restarts": 10, "seed": 42, "sample_size": 5000}
STUDY_FEATURES = ["positive_ratio", "user_reviews", "price_final", "discount", "rating_encoded",
                  "platform_count", "price_category", "steam_deck"]


def encode_rating(df: DataFrame, order: str = "frequencyDesc", column: str = "rating",
                  ranks: DataFrame | None = None) -> DataFrame:
    """Label index by frequency (ties by label) or by alphabet (``alphabetAsc``); missing and unknown labels come last.

    Counts, ranks and the join back are distributed, so any number of labels may occur. ``ranks`` are those of an
    earlier frame (see ``label_ranks``), else of this one.
    """
    ranks = label_ranks(df, column, order == "frequencyDesc") if ranks is None else ranks
    labels = ranks.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = df.join(ranks.withColumnRenamed("label", "__label"), F.col(column) == F.col("__label"), "left")
    return (placed.withColumn(f"{column}_encoded", F.coalesce("place", labels).cast("double"))
            .drop("__label", "place"))


def preprocess_features(df: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """Feature columns, rating index, valid rows, defaults: in this order, as the index is
    fitted on all rows unless ``ranks`` brings one."""
    return fill_defaults(valid_games(encode_rating(with_features(df), ranks=ranks)))


def clustering_stages(features: list[str] | None = None, **settings) -> Pipeline:
    options = {**JOB, **settings}
    return Pipeline(stages=[
        VectorAssembler(inputCols=features or CLUSTER_FEATURES, outputCol="features_raw",
                        handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
        KMeans(featuresCol="features", predictionCol="cluster", **options),
    ])


def fit_clusters(df: DataFrame, features: list[str] | None = None, **settings) -> PipelineModel:
    return clustering_stages(features, **settings).fit(df)


def assign_clusters(model: PipelineModel, games: DataFrame) -> DataFrame:
    """Cluster labels for games, batch or stream."""
    return model.transform(games)


def silhouette(df: DataFrame, features: str = "features", label: str = "cluster") -> float:
    """Squared-Euclidean silhouette in linear time."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=label, metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(df)


def evaluate_clusters(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row with silhouette, total and number of clusters; distribution per cluster)."""
    score = silhouette(df)
    distribution = cluster_distribution(df)
    totals = distribution.agg(F.sum("n").alias("total_records"), F.count(F.lit(1)).alias("num_clusters"))
    return totals.withColumn("silhouette_score", F.lit(float(score))), distribution


def standardised(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns plus the standardised ``features`` vector."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(f"x_{c}") for c in features])
    assembled = VectorAssembler(inputCols=[f"x_{c}" for c in features], outputCol="features_raw",
                                handleInvalid="skip").transform(typed)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)
    return scaler.fit(assembled).transform(assembled).select(*keep, "features")


def _side_by_side(spark, calls: list, parallel: int) -> list:
    """Results of independent driver calls, run in a few threads so their Spark jobs overlap."""
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda call: call()), calls))


def _axes(features: list[str]) -> list[str]:
    return [f"v{i}" for i in range(len(features))]


def _spread(vectors: DataFrame, features: list[str], key: str) -> DataFrame:
    """The vectors as one column for each feature, dealt evenly by a hash of the row, ``draw``; written once for all passes."""
    values = vector_to_array("features")
    rows = vectors.select(key, *[values[i].alias(v) for i, v in enumerate(_axes(features))])
    path = scratch_path(vectors.sparkSession, "vectors")
    rows.withColumn("draw", F.xxhash64(F.lit(STUDY["seed"]), key, *_axes(features))).repartition("draw").write.parquet(path)
    return vectors.sparkSession.read.parquet(path)


def best_of(rows: DataFrame, axes: list[str], ks, restarts: int, seed: int, max_iter: int = 100) -> dict[int, tuple]:
    """By k, (centers, cost) of the fit with the lowest cost out of ``restarts`` seeds; all fits share their passes."""
    fits = [(k, seed + i) for k in ks for i in range(restarts)]
    found: dict[int, tuple] = {}
    for (k, _), (centers, cost) in zip(fits, fit_many(rows, axes, fits, max_iter)):
        if k not in found or cost < found[k][1]:
            found[k] = (centers, cost)
    return found


def score_labels(df: DataFrame, axes: list[str], by: str, parallel: int = 2) -> dict:
    """By value of ``by``: silhouette, Calinski-Harabasz and Davies-Bouldin of the rows labelled ``cluster``."""
    quality, shapes = _side_by_side(df.sparkSession, [
        lambda: cluster_quality(df, axes, by=[by]).collect(), lambda: silhouettes(df, axes, by=[by]).collect()], parallel)
    shape = {r[by]: r["silhouette"] for r in shapes}
    return {r[by]: {"silhouette": shape[r[by]], "calinski_harabasz": r["calinski_harabasz"],
                    "davies_bouldin": r["davies_bouldin"]} for r in quality}


def _labelled(rows: DataFrame, axes: list[str], models: dict[int, tuple]) -> DataFrame:
    """The rows with a label for each k, ``cluster_<k>``, written once."""
    path = scratch_path(rows.sparkSession, "labelled")
    with_labels(rows.drop("draw"), axes, {f"cluster_{k}": centers for k, (centers, _) in models.items()}).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def sweep_k(df: DataFrame, features: list[str], ks=STUDY["ks"], restarts: int = STUDY["restarts"],
            seed: int = STUDY["seed"], sample_size: int | None = None, key: str = "app_id",
            parallel: int = 4) -> DataFrame:
    """k, inertia, silhouette, Calinski-Harabasz, Davies-Bouldin for each k.

    The standardised frame is written once. Every pass over it serves all fits of all k that still
    move, so the number of jobs follows from the slowest fit, not from the number of fits; the measures of all k share
    their passes, too. ``parallel`` measures are computed side by side.
    """
    spark, axes, ks = df.sparkSession, _axes(features), list(ks)
    base = standardised(df, features, [key])
    if sample_size is not None:
        base = sample_rows(base, sample_size, key, seed)
    rows = _spread(base, features, key)
    models = best_of(rows, axes, ks, restarts, seed)
    labelled = _labelled(rows, axes, models)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"cluster_{k}").alias("cluster")) for k in ks]))
    scores = score_labels(labelled.select(*axes, each.alias("fit")).select(
        *axes, F.col("fit.k").alias("asked"), F.col("fit.cluster").alias("cluster")), axes, "asked", parallel)
    return spark.createDataFrame(
        [(k, models[k][1], scores[k]["silhouette"], scores[k]["calinski_harabasz"], scores[k]["davies_bouldin"]) for k in ks],
        "k INT, inertia DOUBLE, silhouette DOUBLE, calinski_harabasz DOUBLE, davies_bouldin DOUBLE")


def final_fit(df: DataFrame, features: list[str], k: int, restarts: int = STUDY["restarts"],
              seed: int = STUDY["seed"], key: str = "app_id") -> tuple[DataFrame, dict[str, float]]:
    """All rows with their cluster, and the quality of the chosen fit."""
    axes = _axes(features)
    rows = _spread(standardised(df, features, [key]), features, key)
    models = best_of(rows, axes, [k], restarts, seed)
    labelled = _labelled(rows, axes, models).withColumnRenamed(f"cluster_{k}", "cluster")
    scores = score_labels(labelled.withColumn("asked", F.lit(k)), axes, "asked")[k]
    scores["inertia"] = models[k][1]
    return labelled.select(key, array_to_vector(F.array(*axes)).alias("features"), "cluster"), scores


def project_2d(vectors: DataFrame, centers: list | None = None, column: str = "features"):
    """(rows with x and y, explained variance ratios, projected centers or None)."""
    model = PCA(k=2, inputCol=column, outputCol="plane").fit(vectors)
    plane = vector_to_array("plane")
    points = model.transform(vectors).withColumns({"x": plane[0], "y": plane[1]}).drop("plane")
    projected = None
    if centers is not None:
        rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
        frame = vectors.sparkSession.createDataFrame(rows, "cluster INT, c ARRAY<DOUBLE>")
        lifted = frame.select("cluster", array_to_vector("c").alias(column))
        projected = model.transform(lifted).select("cluster", plane[0].alias("x"), plane[1].alias("y"))
    return points, [float(v) for v in model.explainedVariance.toArray()], projected
