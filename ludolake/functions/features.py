"""Feature columns for games, as column expressions that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rating label, score.
RATING_SCORES = {
    "Overwhelmingly Positive": 9,
    "Very Positive": 8,
    "Positive": 6,
    "Mostly Positive": 7,
    "Mixed": 5,
    "Mostly Negative": 3,
    "Negative": 2,
    "Very Negative": 1,
    "Overwhelmingly Negative": 0,
}
UNKNOWN_RATING_SCORE = 4

# The nine clustering features, in assembly order.
CLUSTER_FEATURES = [
    "positive_ratio", "user_reviews_log", "price_final", "discount", "rating_encoded",
    "platform_count", "price_category", "steam_deck_numeric", "release_year",
]

# Defaults for missing feature inputs.
FEATURE_DEFAULTS = {"discount": 0.0, "release_year": 2020}


def banded(value: Column, upper_bounds: list[tuple[float, int]], above: int) -> Column:
    """Code of the first band whose (inclusive) upper bound holds the value."""
    chain = None
    for bound, code in upper_bounds:
        hit = value <= F.lit(bound)
        chain = F.when(hit, F.lit(code)) if chain is None else chain.when(hit, F.lit(code))
    return chain.otherwise(F.lit(above))


def platform_count(win="win", mac="mac", linux="linux") -> Column:
    return sum((F.col(c).cast("int") for c in (mac, linux)), F.col(win).cast("int"))


def steam_deck_numeric(flag="steam_deck") -> Column:
    return F.col(flag).cast("int")


def user_reviews_log(reviews="user_reviews") -> Column:
    n = F.col(reviews)
    return F.when(n > 0, F.log10(n + F.lit(1))).otherwise(F.lit(0.0))


def release_year(date="date_release") -> Column:
    return F.year(F.try_to_timestamp(F.col(date), F.lit("yyyy-MM-dd")))


def price_category(price="price_final") -> Column:
    """0 free, 1 up to 5, 2 up to 20, 3 up to 50, 4 above (also for a missing price)."""
    p = F.col(price)
    return F.when(p == 0, F.lit(0)).otherwise(banded(p, [(5, 1), (20, 2), (50, 3)], above=4))


def review_category(reviews="user_reviews") -> Column:
    """0 below 100, 1 below 1000, 2 below 10000, 3 from there; not a number counts as 0."""
    n = F.col(reviews).try_cast("bigint")
    return (F.when(n >= 10000, F.lit(3)).when(n >= 1000, F.lit(2)).when(n >= 100, F.lit(1))
            .otherwise(F.lit(0)))


def rating_score(rating="rating") -> Column:
    """Label to score; unknown and missing labels get the middle score."""
    pairs = [F.lit(item) for pair in RATING_SCORES.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(F.col(rating), F.lit(""))),
                      F.lit(UNKNOWN_RATING_SCORE))


def band_score(score: Column) -> Column:
    return F.when(score >= 70, F.lit("good")).when(score >= 50, F.lit("fair")).otherwise(F.lit("poor"))


def with_features(df: DataFrame) -> DataFrame:
    """The five derived feature columns, one projection."""
    return df.withColumns({
        "platform_count": platform_count(),
        "steam_deck_numeric": steam_deck_numeric(),
        "user_reviews_log": user_reviews_log(),
        "release_year": release_year(),
        "price_category": price_category(),
    })


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    return df.fillna(FEATURE_DEFAULTS if defaults is None else defaults)


def with_stream_metadata(df: DataFrame, as_of: Column, batch_id: Column,
                         source: str) -> DataFrame:
    record_id = F.concat_ws("_", F.lit("game"), F.coalesce(F.col("app_id").cast("string"), F.lit("unknown")),
                            F.unix_timestamp(as_of).cast("string"))
    return df.withColumn("streaming_metadata", F.struct(
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(source).alias("source"),
        batch_id.cast("bigint").alias("batch_id"),
        record_id.alias("record_id"),
    ))


def with_feature_struct(df: DataFrame) -> DataFrame:
    """The feature struct sent along with a streamed game; missing inputs count as 0 / False."""
    flags = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("win", "mac", "linux")]
    price = F.when(F.col("price_final").isNull(), F.lit(0)).otherwise(price_category())
    return df.withColumn("features", F.struct(
        (flags[0] + flags[1] + flags[2]).alias("platform_count"),
        price.alias("price_category"),
        review_category().alias("review_category"),
        rating_score().alias("rating_score"),
    ))


# Listing columns, and name parts that mark a feature column.
LISTING_COLUMNS = ["app_id", "title", "rating", "positive_ratio", "user_reviews", "price_final", "cluster"]
FEATURE_NAME_PARTS = ["_encoded", "_count", "_category", "_numeric", "_log", "_year"]


def select_existing(df: DataFrame, columns: list[str] | None = None,
                    include_features: bool = False) -> DataFrame:
    """Listing columns that exist, plus feature columns found by their names."""
    wanted = list(LISTING_COLUMNS if columns is None else columns)
    if include_features:
        wanted += [c for c in df.columns
                   if c not in wanted and any(part in c for part in FEATURE_NAME_PARTS)]
    return df.select(*[c for c in wanted if c in df.columns])
