"""Player, server and game metrics (ids A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludolake.operators import metrics as mt
from ludolake.operators import search, stats
from ludolake.plans.registry import query
from ludolake.plans.sql_views import AS_OF as SQL_AS_OF
from ludolake.plans.views import AS_OF

LAST_HOUR = f"BETWEEN {SQL_AS_OF} - INTERVAL 1 HOUR AND {SQL_AS_OF}"
#: A time with many rows on both sides, for functions that must not count what comes after it.
MIDDLE = "2024-01-15 12:00:00"
UP_TO_MIDDLE = f"WHERE processed_at <= TIMESTAMP '{MIDDLE}'"
HOUR_TO_MIDDLE = f"BETWEEN TIMESTAMP '{MIDDLE}' - INTERVAL 1 HOUR AND TIMESTAMP '{MIDDLE}'"
NEWEST = "ORDER BY processed_at DESC, event_id DESC LIMIT"


@query("a1_overview", f"""
    WITH poor AS (SELECT count(*) FILTER (health_status = 'poor') AS n
                  FROM (SELECT * FROM game_metrics {UP_TO_MIDDLE} {NEWEST} 10))
    SELECT (SELECT count(*) FROM games) AS total_games, (SELECT count(*) FROM reviews) AS total_reviews,
           (SELECT round(avg(playtime_hours), 6) FROM reviews) AS avg_playtime,
           (SELECT count(*) FROM server_logs) AS total_log_entries,
           (SELECT count(DISTINCT player_id) FROM player_events WHERE processed_at {HOUR_TO_MIDDLE}) AS active_players,
           (SELECT CASE WHEN n > 3 THEN 'poor' WHEN n > 1 THEN 'moderate' ELSE 'good' END FROM poor)
               AS server_health_status,
           (SELECT count(*) > 0 FROM player_events WHERE processed_at {HOUR_TO_MIDDLE}) AS player_events_available,
           (SELECT count(*) > 0 FROM game_metrics WHERE processed_at {HOUR_TO_MIDDLE}) AS game_metrics_available,
           (SELECT count(*) > 0 FROM reviews) AS reviews_available,
           (SELECT count(*) > 0 FROM server_logs) AS logs_available""")
def overview(lake):
    wide = mt.overview(lake.games, lake.reviews, lake.server_logs, lake.player_events, lake.game_metrics, MIDDLE)
    return wide.withColumn("avg_playtime", F.round("avg_playtime", 6))


@query("a2_active_players", f"""
    SELECT count(DISTINCT player_id) AS active_players FROM player_events WHERE processed_at {LAST_HOUR}""")
def _(lake):
    return mt.active_players(lake.player_events, AS_OF)


@query("a2_active_players_sketch", f"""
    SELECT count(DISTINCT player_id) AS players, count(*) AS events, true AS within_bound FROM player_events
    WHERE processed_at BETWEEN {SQL_AS_OF} - INTERVAL 1 HOUR AND {SQL_AS_OF} + INTERVAL 5 MINUTE
      AND processed_at < {SQL_AS_OF} + INTERVAL 5 MINUTE""")
def _(lake):
    """Sketches of five-minute panes, those that begin in the last hour, next to the exact count of the same rows."""
    merged = mt.active_players_from_sketches(mt.player_sketches(lake.player_events), AS_OF)
    end = F.lit(AS_OF).cast("timestamp") + F.expr("INTERVAL 5 MINUTES")
    rows = lake.player_events.filter((F.col("processed_at") >= F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
                                     & (F.col("processed_at") < end))
    exact = rows.agg(F.count_distinct("player_id").alias("players")).scalar()
    apart = F.abs(F.col("active_players") - exact) <= F.greatest(F.lit(1.0), 4 * 1.04 / 128 * exact)
    return merged.select(exact.alias("players"), F.col("events").cast("bigint").alias("events"), apart.alias("within_bound"))


@query("a3_rolling_health", f"""
    SELECT n AS poor_count, CASE WHEN n > 3 THEN 'poor' WHEN n > 1 THEN 'moderate' ELSE 'good' END
           AS server_health_status
    FROM (SELECT count(*) FILTER (health_status = 'poor') AS n
          FROM (SELECT * FROM game_metrics {NEWEST} 10))""")
def _(lake):
    return mt.rolling_health(lake.game_metrics)


@query("a4_playtime_distribution", """
    SELECT b.playtime_range, count(review_id) AS reviews FROM (VALUES ('0-10h'), ('10-50h'), ('50-100h'), ('100h+'))
        b(playtime_range) LEFT JOIN reviews ON b.playtime_range = CASE WHEN playtime_hours <= 10 THEN '0-10h'
        WHEN playtime_hours <= 50 THEN '10-50h' WHEN playtime_hours <= 100 THEN '50-100h' ELSE '100h+' END
    GROUP BY b.playtime_range""")
def _(lake):
    return mt.playtime_distribution(lake.reviews)


@query("a5_player_category_counts", """
    SELECT c.player_category, count(player_id) AS players FROM (VALUES ('casual'), ('regular'), ('hardcore'))
        c(player_category) LEFT JOIN player_stats s ON c.player_category = s.player_category
    GROUP BY c.player_category""")
def _(lake):
    return mt.player_category_counts(lake.player_stats)


@query("a6_activity_trends", f"""
    SELECT event_type, count(*) AS events FROM player_events WHERE processed_at {LAST_HOUR}
    GROUP BY event_type ORDER BY events DESC, event_type LIMIT 5""")
def _(lake):
    return mt.activity_trends(lake.player_events, AS_OF)


@query("a7_server_activity", """
    SELECT count(*) FILTER (regexp_matches(action, '(?i)joined')) AS joins,
           count(*) FILTER (regexp_matches(action, '(?i)left|disconnect')) AS leaves FROM server_logs""")
def _(lake):
    return mt.server_activity(lake.server_logs)


@query("a8_log_level_distribution", "SELECT level, count(*) AS entries FROM server_logs GROUP BY level")
def _(lake):
    return mt.log_level_distribution(lake.server_logs)


@query("a9_recent_errors", f"""
    SELECT count(*) AS recent_errors FROM server_logs WHERE level = 'ERROR' AND timestamp {LAST_HOUR}""")
def _(lake):
    return mt.recent_errors(lake.server_logs, AS_OF)


@query("a10_connection_count", """
    SELECT count(*) FILTER (regexp_matches(action, '(?i)joined|left')) AS total_connections FROM server_logs""")
def _(lake):
    return mt.connection_count(lake.server_logs)


@query("a10_top_actions", """
    SELECT action, count(*) AS entries FROM server_logs GROUP BY action ORDER BY entries DESC, action LIMIT 5""")
def _(lake):
    return mt.top_actions(lake.server_logs)


PERFORMANCE = """SELECT CAST(trunc(avg(concurrent_players)) AS BIGINT) AS concurrent_players,
        avg(crash_rate_percent) AS crash_rate, arg_max(health_status, (processed_at, event_id)) AS health_status
    FROM (SELECT * FROM game_metrics {rows} {newest} 20)"""


@query("a11_server_performance",
       f"SELECT concurrent_players, round(crash_rate, 6) AS crash_rate, health_status FROM ({PERFORMANCE.format(rows='', newest=NEWEST)})")
def _(lake):
    return mt.server_performance(lake.game_metrics).withColumn("crash_rate", F.round("crash_rate", 6))


@query("a12_server_capacity", """
    SELECT count(*) AS active_servers, round(avg(game_server_max_players), 0) AS avg_max_players,
           CAST(sum(game_server_max_players) AS BIGINT) AS total_capacity FROM server_configs""")
def _(lake):
    return mt.server_capacity(lake.server_configs)


@query("a13_server_alerts", f"""
    WITH p AS ({PERFORMANCE.format(rows=UP_TO_MIDDLE, newest=NEWEST)}), e AS (SELECT count(*) AS n FROM server_logs WHERE level = 'ERROR'
        AND event_id % 3 = 1)
    SELECT 'error' AS type, 'High error rate: ' || n || ' errors in last hour' AS message, 'high' AS severity
    FROM e WHERE n > 10
    UNION ALL SELECT 'performance', 'High crash rate: ' || CAST(round(crash_rate, 1) AS VARCHAR) || '%', 'high'
    FROM p WHERE crash_rate > 2.0
    UNION ALL SELECT 'health', 'Server health status is poor', 'high' FROM p WHERE health_status = 'poor'""")
def _(lake):
    """The logs spread over three hours, the last of them after the time of the alert."""
    shift = F.make_dt_interval(mins=F.lit(60) * (F.col("event_id") % 3).cast("int") - F.lit(90))
    logs = lake.server_logs.withColumn("timestamp", F.lit(MIDDLE).cast("timestamp") + shift)
    return mt.server_alerts(logs, lake.game_metrics, MIDDLE)


@query("a14_game_performance", f"""
    SELECT CAST(trunc(avg(concurrent_players)) AS BIGINT) AS concurrent_players,
           round(avg(crash_rate_percent), 6) AS avg_crash_rate,
           count(*) FILTER (health_status = 'poor') AS games_with_poor_health,
           count(DISTINCT game_id) AS total_active_games
    FROM game_metrics WHERE processed_at BETWEEN {SQL_AS_OF} - INTERVAL 24 HOUR AND {SQL_AS_OF}""")
def _(lake):
    return mt.game_performance(lake.game_metrics, AS_OF).withColumn("avg_crash_rate", F.round("avg_crash_rate", 6))


@query("a15_top_games_by_activity", """
    SELECT game_id, count(*) AS events FROM player_events GROUP BY game_id
    ORDER BY events DESC, game_id LIMIT 10""")
def top_games(lake):
    return mt.top_games_by_activity(lake.player_events)


@query("a16_reviews_by_category", """
    SELECT c.category, count(review_id) AS reviews
    FROM (VALUES ('Action Games', '00[1-3]'), ('RPG Games', '00[4-6]'), ('Strategy Games', '00[7-9]'))
        c(category, pattern) LEFT JOIN reviews ON regexp_matches(review_id, pattern) GROUP BY c.category""")
def _(lake):
    return mt.reviews_by_category(lake.reviews)


@query("a17_helpful_ratio", """
    SELECT round(CAST(sum(helpful_votes) AS DOUBLE) / sum(total_votes) * 100, 2) AS avg_helpful_ratio FROM reviews""")
def _(lake):
    return mt.helpful_ratio(lake.reviews)


@query("a18_recent_review_count", "SELECT count(*) AS recent_reviews_count FROM reviews")
def _(lake):
    return mt.recent_review_count(lake.reviews)


@query("a20_engagement", """
    SELECT count(*) FILTER (event_type = 'game_start') AS total_sessions,
           count(*) FILTER (event_type = 'achievement_unlock') AS achievement_unlocks,
           count(*) FILTER (event_type = 'purchase') AS purchases, count(*) AS total_events FROM player_events""")
def _(lake):
    return mt.engagement(lake.player_events)


@query("a21_events_per_session", """
    SELECT round(CAST(count(*) AS DOUBLE) / count(DISTINCT session_id), 1) AS events_per_session
    FROM player_events""")
def events_per_session(lake):
    return mt.events_per_session(lake.player_events)


@query("a22_metrics_summary", """
    SELECT round(avg(concurrent_players), 6) AS avg_concurrent_players,
           max(concurrent_players) AS max_concurrent_players, round(avg(crash_rate_percent), 6) AS avg_crash_rate,
           max(crash_rate_percent) AS max_crash_rate, count(*) FILTER (health_status = 'good') AS health_good,
           count(*) FILTER (health_status = 'moderate') AS health_moderate,
           count(*) FILTER (health_status = 'poor') AS health_poor FROM game_metrics""")
def metrics_summary(lake):
    return mt.metrics_summary(lake.game_metrics).withColumns({
        c: F.round(c, 6) for c in ("avg_concurrent_players", "avg_crash_rate")})


@query("a23_review_stats", """
    SELECT 'sentiment' AS statistic, sentiment_indicator AS value, CAST(count(*) AS DOUBLE) AS amount
    FROM streamed_reviews GROUP BY sentiment_indicator
    UNION ALL SELECT 'rating', CAST(rating AS VARCHAR), count(*) FROM streamed_reviews GROUP BY rating
    UNION ALL SELECT 'summary', 'avg_rating', round(avg(rating), 6) FROM streamed_reviews
    UNION ALL SELECT 'summary', 'total_helpful_votes', sum(helpful_votes) FROM streamed_reviews
    UNION ALL SELECT 'summary', 'avg_helpful_votes', round(avg(helpful_votes), 6) FROM streamed_reviews""")
def _(lake):
    return mt.review_stats(lake.streamed_reviews).withColumn("amount", F.round("amount", 6))


@query("a31_missing_values", """
    SELECT * FROM (
        SELECT 'title' AS column_name, count(*) FILTER (title IS NULL) AS missing FROM gappy_games
        UNION ALL SELECT 'date_release', count(*) FILTER (date_release IS NULL) FROM gappy_games
        UNION ALL SELECT 'rating', count(*) FILTER (rating IS NULL) FROM gappy_games
        UNION ALL SELECT 'positive_ratio', count(*) FILTER (positive_ratio IS NULL) FROM gappy_games
        UNION ALL SELECT 'user_reviews', count(*) FILTER (user_reviews IS NULL) FROM gappy_games
        UNION ALL SELECT 'price_final', count(*) FILTER (price_final IS NULL) FROM gappy_games
        UNION ALL SELECT 'price_original', count(*) FILTER (price_original IS NULL) FROM gappy_games
        UNION ALL SELECT 'discount', count(*) FILTER (discount IS NULL) FROM gappy_games)
    WHERE missing > 0""")
def _(lake):
    return stats.missing_values(lake.gappy_games)


NUMERIC = ["positive_ratio", "user_reviews", "price_final", "price_original", "discount"]


@query("a32_describe_numeric", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
           CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25,
           CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75,
           CAST(max({c}) AS DOUBLE) AS max FROM gappy_games""" for c in NUMERIC))
def _(lake):
    return stats.describe_numeric(lake.gappy_games, NUMERIC).withColumns(
        {c: F.round(c, 6) for c in ("mean", "std")})


@query("a33_value_counts", "SELECT rating, count(*) AS count FROM gappy_games WHERE rating IS NOT NULL GROUP BY rating")
def _(lake):
    return stats.value_counts(lake.gappy_games, "rating")


@query("t1_newest_events", """
    SELECT event_id, player_id, event_type, processed_at FROM player_events
    ORDER BY processed_at DESC, event_id LIMIT 100""")
def _(lake):
    return search.newest_first(lake.player_events, 100).select("event_id", "player_id", "event_type", "processed_at")


@query("t1_newest_metrics", """
    SELECT event_id, game_id, health_status, processed_at FROM game_metrics
    ORDER BY processed_at DESC, event_id LIMIT 50""")
def _(lake):
    return search.newest_first(lake.game_metrics, 50).select("event_id", "game_id", "health_status", "processed_at")


@query("t1_newest_reviews", """
    SELECT review_id, sentiment_indicator, processed_at FROM streamed_reviews
    ORDER BY processed_at DESC, review_id LIMIT 50""")
def _(lake):
    return search.newest_first(lake.streamed_reviews, 50, id_column="review_id").select(
        "review_id", "sentiment_indicator", "processed_at")


@query("t5_last_n", """
    SELECT event_id, game_id, concurrent_players FROM game_metrics
    ORDER BY processed_at DESC, event_id DESC LIMIT 1000""")
def _(lake):
    return mt.last_n(lake.game_metrics, 1000, "processed_at", "event_id").select(
        "event_id", "game_id", "concurrent_players")
