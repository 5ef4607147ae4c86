"""Descriptions and quality measures of a given clustering (a frame with a label column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolake.functions.features import CLUSTER_FEATURES
from ludolake.operators.frames import beside


def cluster_distribution(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows and share in percent per cluster."""
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percentage", F.col("n") / total * F.lit(100.0))


def cluster_profile(df: DataFrame, features: list[str] | None = None,
                    cluster: str = "cluster") -> DataFrame:
    """Size, mean reviews and mean of each feature per (non-empty) cluster."""
    names = CLUSTER_FEATURES if features is None else features
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("game_count"), F.avg("user_reviews").alias("avg_user_reviews"),
        *[F.avg(c).alias(f"avg_{c}") for c in names if c in df.columns])


def cluster_summary(profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Totals over a profile: weighted mean price, largest and best rated cluster."""
    n = F.col("game_count")
    tie = -F.col(cluster)
    return profile.agg(
        F.sum(n).cast("bigint").alias("total_games"), F.count(F.lit(1)).alias("total_clusters"),
        F.coalesce(F.round(F.try_divide(F.sum(F.col("avg_price_final") * n), F.sum(n)), 2),
                   F.lit(0.0)).alias("avg_price_overall"),
        F.max_by(cluster, F.struct(n, tie)).alias("largest_cluster"),
        F.max(n).alias("largest_count"),
        F.max_by(cluster, F.struct(F.col("avg_positive_ratio"), tie)).alias("highest_rated_cluster"),
        F.max("avg_positive_ratio").alias("highest_positive_ratio"))


def cluster_characteristics(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Prices, most frequent rating, mean reviews and ratio, platform counts per cluster.

    Grouped by rating first: the modal label comes from a few counts per cluster, and every
    other measure is put together from the same partial sums.
    """
    def summed(flag: str) -> Column:
        return F.sum(F.col(flag).cast("int")).alias(flag)

    parts = df.groupBy(cluster, "rating").agg(
        F.count(F.lit(1)).alias("n"), F.count("price_final").alias("price_n"),
        F.sum("price_final").alias("price_sum"), F.min("price_final").alias("price_min"),
        F.max("price_final").alias("price_max"), F.count("user_reviews").alias("review_n"),
        F.sum("user_reviews").alias("review_sum"), F.count("positive_ratio").alias("ratio_n"),
        F.sum("positive_ratio").alias("ratio_sum"),
        *[summed(f) for f in ("win", "mac", "linux", "steam_deck")])
    label_order = F.when(F.col("rating").isNotNull(), F.struct((-F.col("n")).alias("n"), "rating"))
    return parts.groupBy(cluster).agg(
        F.sum("n").alias("game_count"),
        (F.sum("price_sum") / F.sum("price_n")).alias("avg_price"),
        F.min("price_min").alias("min_price"), F.max("price_max").alias("max_price"),
        F.min_by("rating", label_order).alias("top_rating"),
        (F.sum("review_sum") / F.sum("review_n")).alias("avg_reviews"),
        (F.sum("ratio_sum") / F.sum("ratio_n")).alias("avg_positive_ratio"),
        *[F.sum(f).alias(f) for f in ("win", "mac", "linux", "steam_deck")])


# ---- quality measures -------------------------------------------------------------------

BROADCAST_BYTES = 32 << 20  # centroids up to this size travel to the rows, larger ones meet them by label and salt
SALTS = 32
TILE = 1024                 # centroids compared with as many others in one group


def centroids(df: DataFrame, features: list[str], label: str = "cluster", by: list[str] | None = None) -> DataFrame:
    """(by, label, n, centroid) with the centroid as an array of doubles."""
    return (df.groupBy(*(by or []), F.col(label).alias("label"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array(*[F.avg(F.col(c).cast("double")) for c in features]).alias("centroid")))


def _squared_distance(left: list[Column], right: list[Column]) -> Column:
    total = F.lit(0.0)
    for a, b in zip(left, right):
        total = total + (a - b) * (a - b)
    return total


def _array_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _beside_rows(rows: DataFrame, means: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Each row with the centroid of its keys: broadcast where the caller has measured it as small, else salted."""
    if small:
        return rows.join(F.broadcast(means), keys)
    means = means.hint("merge")  # never the rows: stored files or exploded rows may look small enough to be broadcast
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    copies = means.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(copies, [*keys, "__salt"]).drop("__salt")


def _with_totals(rows: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    fields = F.struct(*[c for c in totals.columns if c not in by]).alias("t")
    if not by:
        return rows.withColumn("t", totals.select(fields).scalar())
    return rows.join(totals.select(*by, fields), by)


def cluster_quality(df: DataFrame, features: list[str], label: str = "cluster", by: list[str] | None = None,
                    broadcast_bytes: int = BROADCAST_BYTES, tile: int = TILE) -> DataFrame:
    """k, n, inertia, Calinski-Harabasz and Davies-Bouldin of the labelled rows: one row, or one for each value of ``by``.

    Two passes: centroids, then distances of each row to its own centroid. The labels are counted first; centroids of up to
    ``broadcast_bytes`` are broadcast, so no row moves; beyond, rows and centroids meet by label and salt, so that a
    hot label is spread. Centroids are compared with each other in tiles. Rows without a label take no part.
    """
    by, d = by or [], len(features)
    labelled = df.filter(F.col(label).isNotNull())
    means = centroids(labelled, features, label, by)
    labels = means.count()
    rows = labelled.select(*by, F.col(label).alias("label"),
                           *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    placed = _beside_rows(rows, means.drop("n"), [*by, "label"], labels * (8 * d + 64) <= broadcast_bytes)
    gap = _squared_distance([F.col(f"f{i}") for i in range(d)], [F.col("centroid")[i] for i in range(d)])
    per_label = (placed.withColumn("gap", gap).groupBy(*by, "label")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("gap").alias("w"),
                      F.avg(F.sqrt("gap")).alias("spread"), F.first("centroid").alias("centroid")))
    totals = per_label.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("w").alias("inertia"),
        F.array(*[F.sum(F.col("centroid")[i] * F.col("n")) / F.sum("n") for i in range(d)]).alias("center"))
    worst = _worst_neighbours(per_label, by, max(1, -(-labels // tile)))
    scored = (_with_totals(per_label, totals, by).join(worst, [*by, "label"], "left")
              .groupBy(*by, F.col("t.k").alias("k"), F.col("t.n").cast("bigint").alias("n"), F.col("t.inertia").alias("inertia"))
              .agg(F.sum(F.col("n") * _array_distance(F.col("centroid"), F.col("t.center"))).alias("between"),
                   F.sum("worst").alias("worst")))
    if not by:  # an empty frame keeps its one row
        scored = totals.select("k", F.col("n").cast("bigint").alias("n"), "inertia").join(
            scored.select("k", "between", "worst"), "k", "left")
    k = F.col("k")
    return scored.select(
        *by, "k", "n", "inertia",
        F.try_divide(F.try_divide(F.col("between"), k - 1), F.try_divide(F.col("inertia"), F.col("n") - k)).alias("calinski_harabasz"),
        F.when(k > 1, F.col("worst") / k).alias("davies_bouldin"))


def _worst_neighbours(per_label: DataFrame, by: list[str], tiles: int) -> DataFrame:
    """(by, label, worst): the largest (spread + spread) / distance to another centroid, tile by tile."""
    tile = F.pmod(F.xxhash64("label"), F.lit(tiles))
    own = per_label.select(*by, "label", "spread", "centroid", tile.alias("a"),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))).alias("b"))
    others = per_label.select(*by, F.col("label").alias("other"), F.col("spread").alias("other_spread"),
                              F.col("centroid").alias("other_centroid"), tile.alias("b"),
                              F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))).alias("a"))
    ratio = F.try_divide(F.col("spread") + F.col("other_spread"),
                         F.sqrt(_array_distance(F.col("centroid"), F.col("other_centroid"))))
    return (own.join(others, [*by, "a", "b"]).filter(F.col("label") != F.col("other"))
            .groupBy(*by, "label").agg(F.max(ratio).alias("worst")))


def silhouettes(df: DataFrame, features: list[str], label: str = "cluster", by: list[str] | None = None,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mean squared-Euclidean silhouette: one row, or one for each value of ``by``; 0 for rows alone in their label.

    Linear in rows: a row's mean distance to a label follows from the label's count, sum and sum of squares. These of all
    labels of a group stand in one array, labels x features doubles, so it is for clusterings with up to thousands of labels.
    The arrays go to the rows as centroids do in ``cluster_quality``: broadcast once counted as small, else by salt.
    """
    by, d = by or [], len(features)
    rows = df.filter(F.col(label).isNotNull()).select(
        *by, F.col(label).alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    sums = rows.groupBy(*by, "label").agg(
        F.count(F.lit(1)).alias("m"), F.sum(squares).alias("psi"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("y"))
    stats = sums.groupBy(*by).agg(F.collect_list(F.struct("label", "m", "psi", "y")).alias("labels"))
    q = F.col("q")

    def mean_distance(g: Column) -> Column:
        dot = F.aggregate(F.zip_with(F.col("x"), g["y"], lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
        return q + g["psi"] / g["m"] - F.lit(2.0) * dot / g["m"]

    far = F.transform(F.col("t.labels"), lambda g: F.struct(
        (g["label"] == F.col("label")).alias("own"), g["m"].alias("m"), mean_distance(g).alias("d")))
    squared = rows.withColumn("q", squares)
    if by:
        packed = stats.select(*by, F.struct("labels").alias("t"))
        placed = _beside_rows(squared, packed, by, sums.count() * (8 * d + 64) <= broadcast_bytes)
    else:
        placed = _with_totals(squared, stats, by)
    placed = placed.withColumn("far", far)
    own = F.filter("far", lambda g: g["own"])[0]
    scored = placed.select(
        *by, own["m"].alias("m"), (own["d"] * own["m"] / F.nullif(own["m"] - 1, F.lit(0))).alias("a"),
        F.array_min(F.transform(F.filter("far", lambda g: ~g["own"]), lambda g: g["d"])).alias("b"))
    a, b = F.col("a"), F.col("b")
    value = (F.when(F.col("m") == 1, 0.0).when(a < b, F.lit(1.0) - a / b).when(a > b, b / a - F.lit(1.0)).otherwise(0.0))
    return scored.groupBy(*by).agg(F.avg(value).alias("silhouette"))


def elbow_table(scores: DataFrame) -> DataFrame:
    """Drop of inertia in percent from the next smaller k; one row per k, so one small window."""
    before = F.lag("inertia").over(Window.partitionBy(F.lit(1)).orderBy("k"))
    return scores.select("k", "inertia",
                         (F.abs(F.col("inertia") - before) / before * F.lit(100.0)).alias("drop_pct"))


def recommend_k(scores: DataFrame) -> DataFrame:
    """Best k per measure and their majority; without one, the silhouette's choice."""
    best = scores.agg(
        F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k_silhouette"),
        F.max_by("k", F.struct("calinski_harabasz", -F.col("k"))).alias("k_calinski"),
        F.min_by("k", F.struct("davies_bouldin", "k")).alias("k_davies"))
    s, c, d = F.col("k_silhouette"), F.col("k_calinski"), F.col("k_davies")
    return best.withColumn("recommended_k", F.when(c == d, c).otherwise(s))


def cluster_analysis(df: DataFrame, metrics: DataFrame, run_stamp: str, samples: DataFrame,
                     features: list[str] | None = None) -> DataFrame:
    """The nested analysis document: one row with metrics and an array of cluster profiles.

    ``samples`` holds a few example rows per cluster (see ``sample_per_cluster``).
    """
    names = [c for c in ("app_id", "title", "price_final") if c in samples.columns]
    examples = samples.groupBy("cluster").agg(
        F.sort_array(F.collect_list(F.struct(*names))).alias("sample_games"))
    profile = cluster_profile(df, features).join(examples, "cluster", "left")
    fields = [c for c in profile.columns if c not in ("cluster", "sample_games")]
    body = profile.agg(F.sort_array(F.collect_list(F.struct(
        F.col("cluster").alias("cluster_id"), *fields, "sample_games"))).alias("cluster_analysis"))
    packed = metrics.select(F.struct(*metrics.columns).alias("clustering_metrics"))
    return beside(body.withColumn("timestamp", F.lit(run_stamp)), packed).select(
        "timestamp", "clustering_metrics", "cluster_analysis")
