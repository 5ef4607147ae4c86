"""Feature columns, filters and enrichment (ids P, F, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.functions import features as ft
from ludolake.functions import predicates as pr
from ludolake.operators import enrich, stats
from ludolake.operators.frames import union_all
from ludolake.operators.kmeans import encode_rating
from ludolake.operators.reviews import score_reviews
from ludolake.plans.registry import query
from ludolake.plans.sql_views import AS_OF as SQL_AS_OF
from ludolake.plans.text_sql import SCORED
from ludolake.plans.views import AS_OF, Lake


@query("p1_platform_count", "SELECT app_id, platform_count FROM featured")
def _(lake: Lake) -> DataFrame:
    return lake.games.select("app_id", ft.platform_count().alias("platform_count"))


@query("p2_steam_deck_numeric", "SELECT app_id, steam_deck_numeric FROM featured")
def _(lake):
    return lake.games.select("app_id", ft.steam_deck_numeric().alias("steam_deck_numeric"))


@query("p3_user_reviews_log",
       "SELECT app_id, round(user_reviews_log, 9) AS user_reviews_log FROM featured")
def _(lake):
    return lake.games.select("app_id", F.round(ft.user_reviews_log(), 9).alias("user_reviews_log"))


@query("p4_release_year", "SELECT app_id, release_year FROM featured")
def _(lake):
    return lake.games.select("app_id", ft.release_year().alias("release_year"))


@query("p5_price_category", "SELECT app_id, price_category FROM featured")
def _(lake):
    return lake.games.select("app_id", ft.price_category().alias("price_category"))


@query("p5_price_band_summary", """
    SELECT price_category, count(*) AS games, round(avg(user_reviews), 6) AS avg_reviews
    FROM featured WHERE positive_ratio BETWEEN 0 AND 100 GROUP BY price_category""")
def price_band_summary(lake):
    valid = pr.valid_games(ft.with_features(lake.games))
    return valid.groupBy("price_category").agg(
        F.count(F.lit(1)).alias("games"), F.round(F.avg("user_reviews"), 6).alias("avg_reviews"))


@query("p6_review_category", """
    SELECT app_id, CASE WHEN user_reviews >= 10000 THEN 3 WHEN user_reviews >= 1000 THEN 2
                        WHEN user_reviews >= 100 THEN 1 ELSE 0 END AS review_category FROM gappy_games""")
def _(lake):
    return lake.gappy_games.select("app_id", ft.review_category().alias("review_category"))


@query("p7_rating_score", """
    SELECT app_id, CASE rating WHEN 'Very Positive' THEN 8 WHEN 'Positive' THEN 6 WHEN 'Mostly Positive' THEN 7
        WHEN 'Mixed' THEN 5 WHEN 'Mostly Negative' THEN 3 WHEN 'Negative' THEN 2 ELSE 4 END AS rating_score
    FROM gappy_games""")
def _(lake):
    return lake.gappy_games.select("app_id", ft.rating_score().alias("rating_score"))


@query("p8_rating_by_frequency", """
    WITH ranked AS (
        SELECT rating, row_number() OVER (ORDER BY count(*) DESC, rating) - 1 AS place, count(*) OVER () AS labels
        FROM gappy_games WHERE rating IS NOT NULL GROUP BY rating)
    SELECT app_id, CAST(coalesce(place, (SELECT max(labels) FROM ranked)) AS DOUBLE) AS rating_encoded
    FROM gappy_games LEFT JOIN ranked ON gappy_games.rating = ranked.rating""")
def _(lake):
    return encode_rating(lake.gappy_games).select("app_id", "rating_encoded")


@query("p9_rating_by_alphabet", """
    SELECT app_id, CAST(dense_rank() OVER (ORDER BY rating) - 1 AS DOUBLE) AS rating_encoded FROM games""")
def _(lake):
    return encode_rating(lake.games, "alphabetAsc").select("app_id", "rating_encoded")


@query("p10_impute_median", """
    WITH m AS (SELECT median(positive_ratio) AS a, median(user_reviews) AS b, median(price_final) AS c,
                      median(price_original) AS d, median(discount) AS e FROM gappy_games)
    SELECT app_id, CAST(coalesce(positive_ratio, a) AS DOUBLE) AS positive_ratio,
           CAST(coalesce(CAST(user_reviews AS DOUBLE), b) AS DOUBLE) AS user_reviews,
           coalesce(price_final, c) AS price_final,
           coalesce(price_original, d) AS price_original, coalesce(discount, e) AS discount
    FROM gappy_games CROSS JOIN m""")
def _(lake):
    columns = ["positive_ratio", "user_reviews", "price_final", "price_original", "discount"]
    return stats.impute_numeric_median(lake.gappy_games, columns).select("app_id", *columns)


@query("p11_impute_mode", """
    WITH m AS (SELECT rating AS top FROM gappy_games WHERE rating IS NOT NULL
               GROUP BY rating ORDER BY count(*) DESC, rating LIMIT 1)
    SELECT app_id, coalesce(rating, (SELECT top FROM m)) AS rating FROM gappy_games""")
def _(lake):
    return stats.impute_mode(lake.gappy_games, ["rating"]).select("app_id", "rating")


@query("p12_fill_defaults", """
    SELECT app_id, coalesce(discount, 0.0e0) AS discount,
           coalesce(CAST(left(date_release, 4) AS INTEGER), 2020) AS release_year FROM gappy_games""")
def _(lake):
    dated = lake.gappy_games.withColumn("release_year", ft.release_year())
    return ft.fill_defaults(dated).select("app_id", "discount", "release_year")


@query("p13_stream_metadata", """
    SELECT app_id, '2024-01-30T23:00:00' AS meta_timestamp, 'games_feed' AS meta_source,
           CAST(app_id // 100 AS BIGINT) AS meta_batch_id, 'game_' || app_id || '_1706655600' AS meta_record_id
    FROM games""")
def _(lake):
    tagged = ft.with_stream_metadata(lake.games, pr.moment(AS_OF), F.floor(F.col("app_id") / 100), "games_feed")
    return tagged.select("app_id", *[F.col(f"streaming_metadata.{f}").alias(f"meta_{f}")
                                     for f in ("timestamp", "source", "batch_id", "record_id")])


@query("p14_feature_struct", """
    SELECT app_id, 1 + CAST(mac AS INTEGER) + CAST(linux AS INTEGER) AS platform_count,
           CASE WHEN price_final IS NULL OR price_final = 0 THEN 0 WHEN price_final <= 5 THEN 1
                WHEN price_final <= 20 THEN 2 WHEN price_final <= 50 THEN 3 ELSE 4 END AS price_category,
           CASE WHEN user_reviews >= 10000 THEN 3 WHEN user_reviews >= 1000 THEN 2
                WHEN user_reviews >= 100 THEN 1 ELSE 0 END AS review_category,
           CASE rating WHEN 'Very Positive' THEN 8 WHEN 'Positive' THEN 6 WHEN 'Mostly Positive' THEN 7
                WHEN 'Mixed' THEN 5 WHEN 'Mostly Negative' THEN 3 WHEN 'Negative' THEN 2 ELSE 4 END AS rating_score
    FROM gappy_games""")
def _(lake):
    return ft.with_feature_struct(lake.gappy_games).select("app_id", "features.*")


@query("p15_select_existing", """
    SELECT app_id, title, rating, positive_ratio, user_reviews, price_final, cluster, platform_count,
           steam_deck_numeric, round(user_reviews_log, 9) AS user_reviews_log, release_year, price_category
    FROM clustered""")
def _(lake):
    listed = ft.select_existing(lake.clustered, include_features=True)
    return listed.withColumn("user_reviews_log", F.round("user_reviews_log", 9))


@query("p16_band_score", """
    SELECT app_id, CASE WHEN positive_ratio >= 70 THEN 'good' WHEN positive_ratio >= 50 THEN 'fair'
                        ELSE 'poor' END AS band FROM games""")
def _(lake):
    return lake.games.select("app_id", ft.band_score(F.col("positive_ratio")).alias("band"))


@query("p17_minutes_since", f"""
    SELECT event_id, CAST(trunc((epoch_us({SQL_AS_OF}) - epoch_us(ts)) / 60000000.0) AS BIGINT) AS minutes
    FROM events""")
def _(lake):
    return lake.table("events").select("event_id", pr.minutes_since(F.col("ts"), AS_OF).alias("minutes"))


# ---- filters ------------------------------------------------------------------------------

@query("f1_valid_games", """
    SELECT app_id, positive_ratio, user_reviews, price_final FROM gappy_games
    WHERE positive_ratio BETWEEN 0 AND 100 AND user_reviews IS NOT NULL AND price_final IS NOT NULL""")
def _(lake):
    return pr.valid_games(lake.gappy_games).select("app_id", "positive_ratio", "user_reviews", "price_final")


@query("f2_required_fields", """
    SELECT app_id, title IS NOT NULL AND user_reviews IS NOT NULL AND price_final IS NOT NULL AS accepted,
           concat_ws(',', CASE WHEN title IS NULL THEN 'title' END,
                          CASE WHEN price_final IS NULL THEN 'price_final' END,
                          CASE WHEN user_reviews IS NULL THEN 'user_reviews' END) AS missing_fields
    FROM gappy_games""")
def _(lake):
    accepted, rejected = pr.split_required(lake.gappy_games)
    return accepted.select("app_id", F.lit(True).alias("accepted"), F.lit("").alias("missing_fields")).unionByName(
        rejected.select("app_id", F.lit(False).alias("accepted"),
                        F.array_join("missing_fields", ",").alias("missing_fields")))


@query("f3_last_hours", f"""
    SELECT event_id, player_id, event_type FROM player_events
    WHERE processed_at BETWEEN {SQL_AS_OF} - INTERVAL 24 HOUR AND {SQL_AS_OF}""")
def _(lake):
    return pr.last_hours(lake.player_events, "processed_at", 24, AS_OF).select("event_id", "player_id", "event_type")


@query("f4_title_contains", "SELECT app_id, title FROM games WHERE contains(lower(title), 'ring')")
def _(lake):
    return lake.games.filter(pr.title_contains("RiNg")).select("app_id", "title")


@query("f5_action_matches", """
    SELECT event_id, regexp_matches(action, '(?i)joined') AS joined,
           regexp_matches(action, '(?i)left|disconnect') AS gone,
           regexp_matches(action, '(?i)joined|left') AS connection
    FROM server_logs""")
def _(lake):
    return lake.server_logs.select("event_id", pr.action_matches(pr.JOINED).alias("joined"),
                                   pr.action_matches(pr.LEFT).alias("gone"),
                                   pr.action_matches(pr.CONNECTION).alias("connection"))


@query("f6_in_cluster", "SELECT app_id, cluster FROM clustered WHERE cluster = 5")
def _(lake):
    return pr.in_cluster(lake.clustered, 5).select("app_id", "cluster")


@query("f7_id_category", """
    SELECT review_id, regexp_matches(review_id, '00[1-3]') AS action, regexp_matches(review_id, '00[4-6]') AS rpg,
           regexp_matches(review_id, '00[7-9]') AS strategy FROM reviews""")
def _(lake):
    return lake.reviews.select("review_id", pr.id_category("Action Games").alias("action"),
                               pr.id_category("RPG Games").alias("rpg"),
                               pr.id_category("Strategy Games").alias("strategy"))


@query("f8_high_confidence", SCORED + """
    SELECT review_id, sentiment FROM scored WHERE sentiment_confidence > 0.5e0""")
def _(lake):
    return pr.high_confidence(score_reviews(lake.reviews, "text"), 0.5).select("review_id", "sentiment")


@query("f9_errors_only", "SELECT event_id, server_id FROM server_logs WHERE level = 'ERROR'")
def _(lake):
    return pr.errors_only(lake.server_logs).select("event_id", "server_id")


# ---- enrichment ---------------------------------------------------------------------------

@query("e1_player_events", """
    SELECT event_id, event_type, CASE WHEN event_type = 'game_start' THEN CAST(hour(timestamp) AS INTEGER) END
           AS session_start_hour, processed_at FROM player_events""")
def _(lake):
    return enrich.enrich_player_events(lake.player_events).select(
        "event_id", "event_type", "session_start_hour", "processed_at")


@query("e2_sentiment_indicator", "SELECT review_id, sentiment_indicator FROM streamed_reviews")
def _(lake):
    return enrich.enrich_reviews(lake.raw_streamed_reviews).select("review_id", "sentiment_indicator")


@query("e3_performance_category", """
    SELECT event_id, CASE WHEN response_time_ms = 0 THEN NULL WHEN response_time_ms > 5000 THEN 'slow'
                          WHEN response_time_ms > 1000 THEN 'medium' ELSE 'fast' END AS performance_category
    FROM server_logs""")
def _(lake):
    return enrich.enrich_server_logs(lake.server_logs).select("event_id", "performance_category")


@query("e4_player_category", "SELECT player_id, player_category FROM player_stats")
def _(lake):
    return enrich.enrich_player_stats(lake.raw_player_stats).select("player_id", "player_category")


@query("e5_health_status", "SELECT event_id, health_status FROM game_metrics")
def _(lake):
    return enrich.enrich_game_metrics(lake.raw_game_metrics).select("event_id", "health_status")


@query("e6_games_stream", """
    SELECT app_id, true AS clustering_ready, 'kafka_stream' AS data_source, true AS features_extracted
    FROM gappy_games WHERE title IS NOT NULL AND user_reviews IS NOT NULL AND price_final IS NOT NULL""")
def _(lake):
    streamed = ft.with_feature_struct(lake.gappy_games)
    return enrich.enrich_games_stream(streamed).select(
        "app_id", "clustering_ready", "data_source", "features_extracted")


def stream_frames(lake: Lake) -> dict[str, DataFrame]:
    return {
        "player_events": enrich.enrich_player_events(lake.player_events),
        "game_reviews": enrich.enrich_reviews(lake.raw_streamed_reviews),
        "server_logs": enrich.enrich_server_logs(lake.server_logs.withColumn("message", F.col("action"))),
        "game_metrics": lake.game_metrics,
    }


ALERTS = """
    SELECT 'player_events' AS source, 'game_crash' AS type, player_id AS entity,
           'Game crash detected for player ' || player_id AS message
    FROM player_events WHERE event_type = 'game_crash'
    UNION ALL SELECT 'game_reviews', 'negative_review', game_id,
           'High-impact negative review detected for game ' || game_id
    FROM streamed_reviews WHERE sentiment_indicator = 'negative' AND helpful_votes > 10
    UNION ALL SELECT 'server_logs', 'server_error', server_id, 'Server error: ' || action || ' on ' || server_id
    FROM server_logs WHERE level = 'ERROR'
    UNION ALL SELECT 'game_metrics', 'crash_rate', game_id,
           'High crash rate (' || CAST(round(crash_rate_percent, 4) AS VARCHAR) || '%) for game ' || game_id
    FROM game_metrics WHERE crash_rate_percent > 3.0"""


@query("e7_alert_rows", ALERTS)
def _(lake):
    return enrich.alert_rows(stream_frames(lake))


@query("e8_notice_rows", """
    SELECT 'games_stream' AS source, 'high_value' AS type, CAST(app_id AS VARCHAR) AS entity,
           'High-value game streamed: ' || title || ' - $' || CAST(price_final AS VARCHAR) AS message
    FROM games WHERE price_final > 50
    UNION ALL SELECT 'games_stream', 'popular', CAST(app_id AS VARCHAR),
           'Popular game streamed: ' || title || ' - ' || user_reviews || ' reviews'
    FROM games WHERE user_reviews > 10000""")
def _(lake):
    return enrich.alerts_for("games_stream", enrich.enrich_games_stream(lake.games))


# ---- unions -------------------------------------------------------------------------------

@query("u1_union_by_name", """
    SELECT review_id, playtime_hours, NULL::INTEGER AS rating FROM reviews
    UNION ALL SELECT review_id, NULL, rating FROM streamed_reviews""")
def _(lake):
    return union_all(lake.reviews.select("review_id", "playtime_hours"),
                     lake.streamed_reviews.select("review_id", "rating"))


@query("u2_difference_of_names", """
    SELECT DISTINCT player_id, game_id FROM player_events WHERE event_type = 'game_start'
    EXCEPT SELECT player_id, game_id FROM player_events WHERE event_type = 'game_crash'""")
def _(lake):
    pairs = lake.player_events.select("player_id", "game_id", "event_type")
    return (pairs.filter("event_type = 'game_start'").drop("event_type")
            .subtract(pairs.filter("event_type = 'game_crash'").drop("event_type")))


@query("u3_distinct_values", "SELECT DISTINCT game_id, event_type FROM player_events")
def _(lake):
    return lake.player_events.select("game_id", "event_type").distinct()
