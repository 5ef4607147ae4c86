"""Similar games. The score mixes price, rating and popularity similarity to a reference game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolake.functions.predicates import title_contains
from ludolake.operators.search import title_match

# Weights of price, rating and popularity; popularity is capped.
WEIGHTS = (0.3, 0.4, 0.3)
POPULARITY_CAP = 2

REFERENCE_FIELDS = ["app_id", "title", "cluster", "price_final", "positive_ratio", "user_reviews"]


def similarity(price: Column, ratio: Column, reviews: Column, ref_price: Column, ref_ratio: Column,
               ref_reviews: Column, max_price: Column) -> dict[str, Column]:
    one = F.lit(1)
    scale = F.greatest(max_price, ref_price, F.lit(1.0))
    return {
        "price_similarity": one - F.abs(price - ref_price) / scale,
        "rating_similarity": one - F.abs(ratio - ref_ratio) / F.lit(100),
        "popularity_factor": F.least((reviews + one) / (ref_reviews + one), F.lit(float(POPULARITY_CAP))),
    }


def _combined() -> Column:
    return (F.col("price_similarity") * F.lit(WEIGHTS[0]) + F.col("rating_similarity") * F.lit(WEIGHTS[1])
            + F.col("popularity_factor") * F.lit(WEIGHTS[2]))


def packed(reference: DataFrame) -> Column:
    """The one reference row as a struct, read by a scalar subquery that all its uses share.

    More than one row is an error.
    """
    return reference.select(F.struct(*reference.columns).alias("ref")).scalar()


def attach_reference(candidates: DataFrame, reference: DataFrame) -> DataFrame:
    """Every candidate next to the one reference row (no join)."""
    return candidates.withColumn("ref", packed(reference.select(*REFERENCE_FIELDS)))


def similar_games(df: DataFrame, ref: Column, limit: int, same_cluster_only: bool) -> DataFrame:
    """The ``limit`` games most similar to the reference, a struct of ``REFERENCE_FIELDS``.

    Equal scores are ordered by reviews, then by id, here and in ``recommend_many``.
    """
    keep = F.col("app_id") != ref["app_id"]
    if same_cluster_only:
        keep = keep & (F.col("cluster") == ref["cluster"])
    candidates = df.filter(keep)
    top_price = candidates.agg(F.max("price_final").alias("p")).scalar()
    scored = (candidates
              .withColumns(similarity(F.col("price_final"), F.col("positive_ratio"), F.col("user_reviews"),
                                      ref["price_final"], ref["positive_ratio"], ref["user_reviews"], top_price))
              .withColumn("similarity_score", _combined()))
    return scored.orderBy(F.col("similarity_score").desc(), F.col("user_reviews").desc(), F.col("app_id")).limit(limit)


RESULT_COLUMNS = ["app_id", "title", "rating", "positive_ratio", "user_reviews", "price_final",
                  "cluster", "similarity_score"]


def recommend_by_id(df: DataFrame, app_id: int, limit: int = 10,
                    same_cluster_only: bool = True) -> DataFrame:
    """Of several rows with the id, the first by title is the reference."""
    fields = F.struct(*REFERENCE_FIELDS)
    reference = (df.filter(F.col("app_id") == F.lit(app_id)).agg(F.min_by(fields, F.struct("title", fields)).alias("r"))
                 .filter("r is not null").select("r.*"))
    return similar_games(df, packed(reference), limit, same_cluster_only).select(*RESULT_COLUMNS)


def best_title_match(df: DataFrame, title: str) -> DataFrame:
    """The best match as one row with its match_score and the number of matches; one pass, no sort."""
    wanted = title.strip()
    found = df.filter(title_contains(wanted)).withColumn("match_score", title_match(wanted, 100, 80, 50))
    rank = F.struct(F.col("match_score"), F.col("user_reviews"), -F.col("app_id"))
    best = F.max_by(F.struct(*REFERENCE_FIELDS, "match_score"), rank)
    return (found.agg(best.alias("best"), F.count(F.lit(1)).alias("total_matches"))
            .filter(F.col("total_matches") > 0).select("best.*", "total_matches"))


def recommend_by_title(df: DataFrame, title: str, limit: int = 8,
                       same_cluster_only: bool = False) -> DataFrame:
    """Games like the best match; a match without candidates comes back alone, in a row of its own."""
    matched = best_title_match(df, title)
    best = packed(matched)
    found = similar_games(df, best, limit, same_cluster_only).select(
        *RESULT_COLUMNS, best["title"].alias("matched_title"), best["match_score"].alias("match_score"),
        best["total_matches"].alias("total_matches"))
    none = found.agg(F.count(F.lit(1)).alias("n")).scalar() == 0
    alone = matched.filter(none).select(
        *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in RESULT_COLUMNS],
        F.col("title").alias("matched_title"), "match_score", "total_matches")
    return found.unionByName(alone)


def recommend_many(df: DataFrame, references: DataFrame, limit: int = 10) -> DataFrame:
    """Same-cluster recommendations for many reference games at once.

    Candidates are thinned first and exactly: games of one cluster with equal price and ratio
    differ for every reference only by reviews, so beyond the ``limit + 1`` most reviewed of them
    none can be recommended. The rank filters are window group limits, applied on the map side,
    which keeps a huge cluster from travelling. Whether the references are broadcast is left to the
    size that the run measures.
    """
    tops = df.groupBy("cluster").agg(F.max("price_final").alias("max_price"))
    refs = (references.join(tops, "cluster").select(
        *[F.col(c).alias(f"ref_{c}") for c in REFERENCE_FIELDS if c != "title"], "max_price"))
    alike = Window.partitionBy("cluster", "price_final", "positive_ratio").orderBy(
        F.col("user_reviews").desc(), F.col("app_id"))
    thinned = (df.select(*RESULT_COLUMNS[:-1])
               .join(refs.select(F.col("ref_cluster").alias("cluster")), "cluster", "left_semi")
               .withColumn("place", F.row_number().over(alike))
               .filter(F.col("place") <= limit + 1).drop("place"))
    paired = thinned.join(refs, (F.col("cluster") == F.col("ref_cluster"))
                          & (F.col("app_id") != F.col("ref_app_id")))
    scored = (paired
              .withColumns(similarity(F.col("price_final"), F.col("positive_ratio"), F.col("user_reviews"),
                                      F.col("ref_price_final"), F.col("ref_positive_ratio"),
                                      F.col("ref_user_reviews"), F.col("max_price")))
              .withColumn("similarity_score", _combined()))
    best = Window.partitionBy("ref_app_id").orderBy(
        F.col("similarity_score").desc(), F.col("user_reviews").desc(), F.col("app_id"))
    return (scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= limit)
            .select("ref_app_id", "place", *RESULT_COLUMNS))
