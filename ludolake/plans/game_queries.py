"""Search, recommendation and clustering (ids T, J1-J2, C and the cluster metrics among A)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.operators import clusters, kmeans, recommend, search
from ludolake.operators.ranks import RankIndex
from ludolake.operators.recommend_all import recommend_all
from ludolake.plans.registry import query, written_once
from ludolake.plans.views import Lake

# ---- search and listing -------------------------------------------------------------------


@query("t2_paginate", """
    SELECT app_id, title, (SELECT count(*) FROM games) AS total, 300 < (SELECT count(*) FROM games) AS has_more
    FROM games ORDER BY app_id LIMIT 100 OFFSET 200""")
def _(lake):
    return search.paginate(lake.games.select("app_id", "title"), 100, 200)


@query("t2_page_by_rank", """
    SELECT l_orderkey, l_linenumber, l_quantity, (SELECT count(*) FROM lineitem) AS total, true AS has_more FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 100 OFFSET 4000""")
def page_by_rank(lake):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    index = RankIndex.build(lake.table("lineitem").select(*keys, "l_quantity"), [F.col(k) for k in keys])
    return index.page(4000, 100).select("l_orderkey", "l_linenumber", "l_quantity", "total", "has_more")


@query("t3_search_games", """
    WITH f AS (SELECT *, CASE WHEN lower(title) = 'red ring' THEN 100 WHEN starts_with(lower(title), 'red ring') THEN 50
                              ELSE 10 END AS relevance_score FROM clustered WHERE contains(lower(title), 'red ring'))
    SELECT app_id, title, user_reviews, relevance_score, (SELECT count(*) FROM f) AS total_count
    FROM f ORDER BY relevance_score DESC, user_reviews DESC, app_id LIMIT 10""")
def search_titles(lake):
    return search.search_games(lake.clustered, " Red Ring ").select(
        "app_id", "title", "user_reviews", "relevance_score", "total_count")


@query("t4_suggest_titles", """
    SELECT app_id, title FROM games WHERE contains(lower(title), 'bo') ORDER BY app_id LIMIT 8""")
def _(lake):
    return search.suggest_titles(lake.games, "bo")


@query("t6_sample_rows", """
    SELECT app_id, title FROM games ORDER BY md5(app_id || ':42'), app_id LIMIT 500""")
def _(lake):
    return search.sample_rows(lake.games.select("app_id", "title"), 500, "app_id", 42)


@query("t7_sample_per_cluster", """
    SELECT cluster, app_id, title FROM clustered
    QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY app_id) <= 5""")
def _(lake):
    return search.sample_per_cluster(lake.clustered.select("cluster", "app_id", "title"), 5).drop("sample_rank")


# ---- recommendation -----------------------------------------------------------------------

def similar_sql(reference: str, candidates: str, order: str, limit: int) -> str:
    """Scores of the candidates against the one reference row ``ref``."""
    return f"""ref AS ({reference}),
    cand AS (SELECT c.* FROM clustered c, ref WHERE c.app_id <> ref.app_id {candidates}),
    top AS (SELECT max(price_final) AS p FROM cand),
    sim AS (SELECT cand.*, (1 - abs(cand.price_final - ref.price_final) / greatest(top.p, ref.price_final, 1.0e0)) * 0.3e0
            + (1 - CAST(abs(cand.positive_ratio - ref.positive_ratio) AS DOUBLE) / 100) * 0.4e0
            + least(CAST(cand.user_reviews + 1 AS DOUBLE) / (ref.user_reviews + 1), 2.0e0) * 0.3e0 AS score
            FROM cand, ref, top),
    best AS (SELECT app_id, title, rating, positive_ratio, user_reviews, price_final, cluster,
                    round(score, 9) AS similarity_score FROM sim ORDER BY {order} LIMIT {limit})"""


def _nine(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity_score", F.round("similarity_score", 9))


@query("j1_attach_reference", """
    SELECT c.app_id, r.app_id AS ref_app_id, c.price_final - r.price_final AS price_gap
    FROM clustered c, (SELECT * FROM clustered WHERE app_id = 100) r""")
def _(lake):
    reference = lake.clustered.filter("app_id = 100")
    return recommend.attach_reference(lake.clustered, reference).select(
        "app_id", F.col("ref.app_id").alias("ref_app_id"),
        (F.col("price_final") - F.col("ref.price_final")).alias("price_gap"))


@query("j2_recommend_many", """
    WITH refs AS (SELECT * FROM clustered
                  QUALIFY row_number() OVER (PARTITION BY cluster, rating ORDER BY user_reviews DESC, app_id) = 1),
    tops AS (SELECT cluster, max(price_final) AS p FROM clustered GROUP BY cluster),
    sim AS (SELECT r.app_id AS ref_app_id, c.app_id, c.title, c.user_reviews, c.cluster,
        (1 - abs(c.price_final - r.price_final) / greatest(t.p, r.price_final, 1.0e0)) * 0.3e0
        + (1 - CAST(abs(c.positive_ratio - r.positive_ratio) AS DOUBLE) / 100) * 0.4e0
        + least(CAST(c.user_reviews + 1 AS DOUBLE) / (r.user_reviews + 1), 2.0e0) * 0.3e0 AS score
        FROM clustered c JOIN refs r ON c.cluster = r.cluster AND c.app_id <> r.app_id
             JOIN tops t ON t.cluster = c.cluster)
    SELECT ref_app_id, CAST(row_number() OVER (PARTITION BY ref_app_id ORDER BY score DESC, user_reviews DESC, app_id)
           AS INTEGER) AS place, app_id, title, round(score, 9) AS similarity_score FROM sim
    QUALIFY place <= 10""")
def recommend_many(lake):
    """References: the most reviewed game of each cluster and rating."""
    most = F.max_by(F.struct(*recommend.REFERENCE_FIELDS), F.struct("user_reviews", -F.col("app_id")))
    references = lake.clustered.groupBy("cluster", "rating").agg(most.alias("r")).select("r.*")
    return _nine(recommend.recommend_many(lake.clustered, references, 10)).select(
        "ref_app_id", "place", "app_id", "title", "similarity_score")


@query("j2_recommend_all", """
    WITH tops AS (SELECT cluster, max(price_final) AS p FROM clustered GROUP BY cluster),
    sim AS (SELECT r.app_id AS ref_app_id, c.app_id, c.title, c.user_reviews, c.cluster,
        (1 - abs(c.price_final - r.price_final) / greatest(t.p, r.price_final, 1.0e0)) * 0.3e0
        + (1 - CAST(abs(c.positive_ratio - r.positive_ratio) AS DOUBLE) / 100) * 0.4e0
        + least(CAST(c.user_reviews + 1 AS DOUBLE) / (r.user_reviews + 1), 2.0e0) * 0.3e0 AS score
        FROM clustered c JOIN clustered r ON c.cluster = r.cluster AND c.app_id <> r.app_id
             JOIN tops t ON t.cluster = c.cluster)
    SELECT ref_app_id, CAST(row_number() OVER (PARTITION BY ref_app_id ORDER BY score DESC, user_reviews DESC, app_id)
           AS INTEGER) AS place, app_id, title, cluster, round(score, 9) AS similarity_score FROM sim
    QUALIFY place <= 10""")
def _(lake):
    """Every game of the table is a reference."""
    return _nine(recommend_all(lake.clustered, 10)).select(
        "ref_app_id", "place", "app_id", "title", "cluster", "similarity_score")


@query("c13_recommend_by_id", "WITH " + similar_sql(
    "SELECT * FROM clustered WHERE app_id = 100", "AND c.cluster = ref.cluster", "score DESC, user_reviews DESC, app_id", 10)
    + " SELECT * FROM best")
def by_id(lake):
    return _nine(recommend.recommend_by_id(lake.clustered, 100))


@query("c13_recommend_any_cluster", "WITH " + similar_sql(
    "SELECT * FROM clustered WHERE app_id = 100", "", "score DESC, user_reviews DESC, app_id", 10) + " SELECT * FROM best")
def _(lake):
    return _nine(recommend.recommend_by_id(lake.clustered, 100, same_cluster_only=False))


@query("c14_recommend_by_title", """
    WITH f AS (SELECT *, CASE WHEN lower(title) = 'hot bolt' THEN 100 WHEN starts_with(lower(title), 'hot bolt')
               THEN 80 ELSE 50 END AS match_score FROM clustered WHERE contains(lower(title), 'hot bolt')), """
       + similar_sql("SELECT * FROM f ORDER BY match_score DESC, user_reviews DESC, app_id LIMIT 1", "",
                     "score DESC, user_reviews DESC, app_id", 8)
       + """ SELECT best.*, ref.title AS matched_title, ref.match_score, (SELECT count(*) FROM f) AS total_matches
             FROM best, ref""")
def by_title(lake):
    return _nine(recommend.recommend_by_title(lake.clustered, "Hot Bolt "))


@query("c15_list_clustered", """
    SELECT app_id, title, rating, positive_ratio, user_reviews, price_final, cluster, platform_count,
           (SELECT count(*) FROM clustered WHERE cluster = 3) AS total,
           35 < (SELECT count(*) FROM clustered WHERE cluster = 3) AS has_more
    FROM clustered WHERE cluster = 3 ORDER BY app_id LIMIT 25 OFFSET 10""")
def _(lake):
    listed = search.list_clustered(lake.clustered, 3, 25, 10, include_features=True)
    return listed.drop("steam_deck_numeric", "user_reviews_log", "release_year", "price_category")


# ---- descriptions of a clustering ---------------------------------------------------------

PROFILE_FEATURES = ["positive_ratio", "user_reviews_log", "price_final", "discount", "platform_count",
                    "price_category", "steam_deck_numeric", "release_year"]
PROFILE_SQL = ("SELECT cluster, count(*) AS game_count, round(avg(user_reviews), 6) AS avg_user_reviews, "
               + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in PROFILE_FEATURES)
               + " FROM clustered GROUP BY cluster")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


@query("a27_cluster_distribution", """
    SELECT cluster, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 6) AS percentage
    FROM clustered GROUP BY cluster""")
def _(lake):
    return _rounded(clusters.cluster_distribution(lake.clustered))


@query("a28_cluster_profile", PROFILE_SQL)
def profile(lake):
    return _rounded(clusters.cluster_profile(lake.clustered))


@query("a29_cluster_summary", """
    WITH p AS (SELECT cluster, count(*) AS n, avg(price_final) AS price, avg(positive_ratio) AS ratio
               FROM clustered GROUP BY cluster)
    SELECT CAST(sum(n) AS BIGINT) AS total_games, count(*) AS total_clusters,
           round(sum(price * n) / sum(n), 2) AS avg_price_overall,
           (SELECT cluster FROM p ORDER BY n DESC, cluster LIMIT 1) AS largest_cluster, max(n) AS largest_count,
           (SELECT cluster FROM p ORDER BY ratio DESC, cluster LIMIT 1) AS highest_rated_cluster,
           round(max(ratio), 6) AS highest_positive_ratio FROM p""")
def _(lake):
    return _rounded(clusters.cluster_summary(clusters.cluster_profile(lake.clustered)))


@query("a30_cluster_characteristics", """
    WITH top AS (SELECT cluster, rating FROM clustered GROUP BY cluster, rating
                 QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, rating) = 1)
    SELECT c.cluster, count(*) AS game_count, round(avg(price_final), 6) AS avg_price, min(price_final) AS min_price,
           max(price_final) AS max_price, any_value(top.rating) AS top_rating,
           round(avg(user_reviews), 6) AS avg_reviews, round(avg(positive_ratio), 6) AS avg_positive_ratio,
           CAST(sum(CAST(win AS INTEGER)) AS BIGINT) AS win, CAST(sum(CAST(mac AS INTEGER)) AS BIGINT) AS mac,
           CAST(sum(CAST(linux AS INTEGER)) AS BIGINT) AS linux,
           CAST(sum(CAST(steam_deck AS INTEGER)) AS BIGINT) AS steam_deck
    FROM clustered c JOIN top ON c.cluster = top.cluster GROUP BY c.cluster""")
def _(lake):
    return _rounded(clusters.cluster_characteristics(lake.clustered))


# ---- quality measures on fixed labels -----------------------------------------------------

QUALITY = """l AS (SELECT g, id, label, unnest(x) AS v, unnest(range(len(x))) AS i FROM pts),
    c AS MATERIALIZED (SELECT g, label, i, avg(v) AS c, sum(v) AS y, count(*) AS n FROM l GROUP BY g, label, i),
    m AS (SELECT g, i, avg(v) AS m FROM l GROUP BY g, i),
    d AS (SELECT l.g, l.id, l.label, sum((v - c) * (v - c)) AS d FROM l
          JOIN c ON l.g = c.g AND l.label = c.label AND l.i = c.i GROUP BY ALL),
    w AS MATERIALIZED (SELECT g, label, count(*) AS n, sum(d) AS w, avg(sqrt(d)) AS s FROM d GROUP BY g, label),
    b AS (SELECT c.g, sum(c.n * (c.c - m.m) * (c.c - m.m)) AS b FROM c JOIN m ON c.g = m.g AND c.i = m.i GROUP BY c.g),
    p AS (SELECT a.g, a.label, o.label AS other, sqrt(sum((a.c - o.c) * (a.c - o.c))) AS dist
          FROM c a JOIN c o ON a.g = o.g AND a.i = o.i AND a.label <> o.label GROUP BY ALL),
    r AS (SELECT p.g, p.label, max((w1.s + w2.s) / p.dist) AS r FROM p
          JOIN w w1 ON p.g = w1.g AND p.label = w1.label JOIN w w2 ON p.g = w2.g AND p.other = w2.label
          GROUP BY p.g, p.label),
    db AS (SELECT g, avg(r) AS db FROM r GROUP BY g),
    tot AS (SELECT g, count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(w) AS inertia FROM w GROUP BY g),
    quality AS (SELECT tot.g, k, n, inertia, (b / (k - 1)) / (inertia / (n - k)) AS calinski_harabasz,
                       db AS davies_bouldin FROM tot JOIN b ON tot.g = b.g JOIN db ON tot.g = db.g)"""
SILHOUETTE = """nrm AS (SELECT g, id, label, sum(v * v) AS q FROM l GROUP BY ALL),
    psi AS (SELECT g, label, count(*) AS n, sum(q) AS psi FROM nrm GROUP BY g, label),
    dots AS (SELECT l.g, l.id, l.label, c.label AS other, sum(v * y) AS dot FROM l
             JOIN c ON l.g = c.g AND l.i = c.i GROUP BY ALL),
    far AS (SELECT dots.g, dots.id, dots.label, dots.other, psi.n, nrm.q + psi.psi / psi.n - 2 * dot / psi.n AS d
            FROM dots JOIN nrm ON dots.g = nrm.g AND dots.id = nrm.id
            JOIN psi ON dots.g = psi.g AND dots.other = psi.label),
    ab AS (SELECT g, id, max(d * n / (n - 1)) FILTER (other = label) AS a, min(d) FILTER (other <> label) AS b
           FROM far GROUP BY g, id),
    sil AS (SELECT g, avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) AS silhouette
            FROM ab GROUP BY g)"""
VECTORS = "pts AS (SELECT 0 AS g, vec_id AS id, label, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings)"
STUDY_AXES = [f"v{i}" for i in range(len(kmeans.STUDY_FEATURES))]
STUDY_KS = range(2, 16)
LABELLED = ("ratings AS (SELECT rating AS label, row_number() OVER (ORDER BY rating) - 1 AS place FROM featured "
            "WHERE rating IS NOT NULL GROUP BY rating), "
            "raw AS (SELECT app_id, CAST(positive_ratio AS DOUBLE) AS v0, CAST(user_reviews AS DOUBLE) AS v1, "
            "CAST(price_final AS DOUBLE) AS v2, CAST(discount AS DOUBLE) AS v3, CAST(place AS DOUBLE) AS v4, "
            "CAST(platform_count AS DOUBLE) AS v5, CAST(price_category AS DOUBLE) AS v6, "
            "CAST(CAST(steam_deck AS INTEGER) AS DOUBLE) AS v7 FROM featured JOIN ratings ON rating = label), "
            "scales AS (SELECT " + ", ".join(f"avg(v{i}) AS m{i}, stddev_samp(v{i}) AS s{i}" for i in range(8))
            + " FROM raw), pts AS (SELECT CAST(g AS INTEGER) AS g, app_id AS id, app_id % g AS label, ["
            + ", ".join(f"coalesce((v{i} - m{i}) / nullif(s{i}, 0), 0)" for i in range(8))
            + "] AS x FROM raw, scales, (SELECT unnest(range(2, 16)) AS g))")


def _vectors(lake: Lake) -> DataFrame:
    axes = [F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(64)]
    return lake.table("embeddings").select("vec_id", "label", *axes)


@query("c8_calinski_harabasz", f"""WITH {VECTORS}, {QUALITY}
    SELECT k, n, round(inertia + 1e-6, 4) AS inertia, round(calinski_harabasz, 6) AS calinski_harabasz FROM quality""")
def quality_of_vectors(lake):
    scores = clusters.cluster_quality(_vectors(lake), [f"v{i}" for i in range(64)], "label")
    return scores.select("k", "n", F.round(F.col("inertia") + 1e-6, 4).alias("inertia"),
                         F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@query("c9_davies_bouldin",
       f"WITH {VECTORS}, {QUALITY} SELECT k, round(davies_bouldin, 6) AS davies_bouldin FROM quality")
def _(lake):
    scores = clusters.cluster_quality(_vectors(lake), [f"v{i}" for i in range(64)], "label")
    return scores.select("k", F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query("c7_silhouette",
       f"WITH {VECTORS}, {QUALITY}, {SILHOUETTE} SELECT round(silhouette, 6) AS silhouette FROM sil")
def _(lake):
    score = clusters.silhouettes(_vectors(lake), [f"v{i}" for i in range(64)], "label")
    return score.select(F.round("silhouette", 6).alias("silhouette"))


def _study_labels(lake: Lake) -> DataFrame:
    """The standardised features of all games, written once, with a fixed label for each k of the study."""
    def write(path: str) -> None:
        vectors = kmeans.standardised(_study_frame(lake), kmeans.STUDY_FEATURES, ["app_id"])
        values = vector_to_array("features")
        vectors.select("app_id", *[values[i].alias(v) for i, v in enumerate(STUDY_AXES)]).write.parquet(path)

    games = lake.spark.read.parquet(written_once(lake, "study_features", write))
    return (games.withColumn("g", F.explode(F.lit(list(STUDY_KS))))
            .withColumn("label", F.col("app_id") % F.col("g")))


@query("c6_elbow_table", f"""WITH {LABELLED}, {QUALITY}
    SELECT k, round(inertia + 1e-6, 4) AS inertia, round(abs(inertia - lag(inertia) OVER (ORDER BY k))
           / lag(inertia) OVER (ORDER BY k) * 100, 6) AS drop_pct FROM quality""")
def _(lake):
    table = clusters.elbow_table(clusters.cluster_quality(_study_labels(lake), STUDY_AXES, "label", ["g"]))
    return table.select("k", F.round(F.col("inertia") + 1e-6, 4).alias("inertia"), F.round("drop_pct", 6).alias("drop_pct"))


@query("c10_recommend_k", f"""WITH {LABELLED}, {QUALITY}, {SILHOUETTE},
    best AS (SELECT (SELECT k FROM quality JOIN sil USING (g) ORDER BY silhouette DESC, k LIMIT 1) AS s,
                    (SELECT k FROM quality ORDER BY calinski_harabasz DESC, k LIMIT 1) AS c,
                    (SELECT k FROM quality ORDER BY davies_bouldin, k LIMIT 1) AS d)
    SELECT s AS k_silhouette, c AS k_calinski, d AS k_davies, CASE WHEN c = d THEN c ELSE s END AS recommended_k
    FROM best""")
def _(lake):
    labelled = _study_labels(lake)
    scores = clusters.cluster_quality(labelled, STUDY_AXES, "label", ["g"])
    return clusters.recommend_k(scores.join(clusters.silhouettes(labelled, STUDY_AXES, "label", ["g"]), "g"))


# ---- fitting ------------------------------------------------------------------------------

@query("c1_preprocess_features", """
    WITH ranked AS (SELECT rating, row_number() OVER (ORDER BY count(*) DESC, rating) - 1 AS place,
                           count(*) OVER () AS labels
                    FROM gappy_games WHERE rating IS NOT NULL GROUP BY rating)
    SELECT app_id, positive_ratio, round(CASE WHEN user_reviews > 0 THEN log10(user_reviews + 1) ELSE 0 END, 9)
               AS user_reviews_log, price_final, coalesce(discount, 0.0e0) AS discount,
           CAST(coalesce(place, (SELECT max(labels) FROM ranked)) AS DOUBLE) AS rating_encoded,
           1 + CAST(mac AS INTEGER) + CAST(linux AS INTEGER) AS platform_count,
           CASE WHEN price_final = 0 THEN 0 WHEN price_final <= 5 THEN 1 WHEN price_final <= 20 THEN 2
                WHEN price_final <= 50 THEN 3 ELSE 4 END AS price_category,
           CAST(steam_deck AS INTEGER) AS steam_deck_numeric,
           coalesce(CAST(left(date_release, 4) AS INTEGER), 2020) AS release_year
    FROM gappy_games LEFT JOIN ranked ON gappy_games.rating = ranked.rating
    WHERE positive_ratio BETWEEN 0 AND 100 AND user_reviews IS NOT NULL AND price_final IS NOT NULL""")
def _(lake):
    ready = kmeans.preprocess_features(lake.gappy_games).select("app_id", *kmeans.CLUSTER_FEATURES)
    return ready.withColumn("user_reviews_log", F.round("user_reviews_log", 9))


def fitted(lake: Lake) -> str:
    """Folder of the job's model, fitted once on all games."""
    return written_once(lake, "model", lambda path: kmeans.fit_clusters(
        kmeans.preprocess_features(lake.games)).write().overwrite().save(path))


def assigned(lake: Lake) -> DataFrame:
    model = kmeans.PipelineModel.load(fitted(lake))
    return kmeans.assign_clusters(model, kmeans.preprocess_features(lake.games))


@query("c2_cluster_fit")
def _(lake):
    return assigned(lake).select("app_id", "cluster")


@query("c3_evaluate_clusters")
def _(lake):
    totals, distribution = kmeans.evaluate_clusters(assigned(lake))
    return distribution.select("cluster", "n", "percentage", totals.select("silhouette_score").scalar().alias("silhouette"))


@query("c4_assign_clusters")
def _(lake):
    model = kmeans.PipelineModel.load(fitted(lake))
    return kmeans.assign_clusters(model, kmeans.preprocess_features(lake.gappy_games)).select("app_id", "cluster")


def _study_frame(lake: Lake) -> DataFrame:
    encoded = kmeans.encode_rating(lake.featured, "alphabetAsc")
    return encoded.withColumn("steam_deck", F.col("steam_deck").cast("int"))


@query("c5_sweep_k")
def _(lake):
    return kmeans.sweep_k(_study_frame(lake), kmeans.STUDY_FEATURES, parallel=8)


@query("c11_final_fit")
def _(lake):
    labelled, scores = kmeans.final_fit(_study_frame(lake), kmeans.STUDY_FEATURES, k=8)
    sizes = clusters.cluster_distribution(labelled)
    return sizes.withColumns({name: F.lit(value) for name, value in scores.items()})


@query("c12_project_2d")
def _(lake):
    vectors = kmeans.standardised(_study_frame(lake), kmeans.STUDY_FEATURES, ["app_id"])
    points, explained, _ = kmeans.project_2d(vectors)
    return points.select("app_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"),
                         F.lit(sum(explained)).alias("explained"))
