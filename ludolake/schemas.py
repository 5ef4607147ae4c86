"""One explicit schema per input, as DDL; nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    """The parsed schema (needs a running session)."""
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


GAMES = (
    "app_id INT, title STRING, date_release STRING, win BOOLEAN, mac BOOLEAN, linux BOOLEAN, "
    "rating STRING, positive_ratio INT, user_reviews INT, price_final DOUBLE, "
    "price_original DOUBLE, discount DOUBLE, steam_deck BOOLEAN"
)

GAMES_STREAM = GAMES + (
    ", streaming_metadata STRUCT<timestamp: STRING, source: STRING, batch_id: BIGINT, record_id: STRING>, "
    "features STRUCT<platform_count: INT, price_category: INT, review_category: INT, rating_score: INT>"
)

PLAYER_EVENTS = (
    "event_id STRING, player_id STRING, game_id STRING, session_id STRING, event_type STRING, "
    "timestamp STRING, server_region STRING, platform STRING, "
    "metadata STRUCT<level: INT, score: INT, playtime_session: INT, ip_hash: STRING>"
)

GAME_REVIEWS = (
    "review_id STRING, player_id STRING, game_id STRING, rating INT, review_text STRING, "
    "timestamp STRING, playtime_hours INT, verified_purchase BOOLEAN, helpful_votes INT, "
    "total_votes INT, sentiment_label STRING"
)

SERVER_LOGS = (
    "level STRING, message STRING, server_id STRING, response_time_ms DOUBLE, timestamp STRING"
)

PLAYER_STATS = ("player_id STRING, total_playtime_hours DOUBLE, timestamp STRING")

GAME_METRICS = (
    "game_id STRING, concurrent_players INT, crash_rate_percent DOUBLE, timestamp STRING"
)

# Stream key, topic name.
TOPICS = {
    "player_events": "gaming.player.events",
    "game_reviews": "gaming.reviews.new",
    "server_logs": "gaming.server.logs",
    "player_stats": "gaming.player.stats",
    "game_metrics": "gaming.metrics.performance",
    "games_stream": "gaming.games.stream",
}

EVENT_SCHEMAS = {
    "player_events": PLAYER_EVENTS,
    "game_reviews": GAME_REVIEWS,
    "server_logs": SERVER_LOGS,
    "player_stats": PLAYER_STATS,
    "game_metrics": GAME_METRICS,
    "games_stream": GAMES_STREAM,
}

GAMES_DOCUMENT = ("""
    game_info STRUCT<
        basic: STRUCT<name: STRING, id: INT, release_date: STRING>,
        details: STRUCT<genres: ARRAY<STRING>, tags: ARRAY<STRING>, platforms: ARRAY<STRING>>,
        pricing: STRUCT<base_price: DOUBLE, current_price: DOUBLE,
                        discount_percentage: INT, currency: STRING>>,
    user_metrics STRUCT<
        ratings: STRUCT<overall_score: DOUBLE, total_reviews: INT, positive_reviews: INT,
                        review_distribution: STRUCT<`5_star`: INT, `4_star`: INT, `3_star`: INT,
                                                    `2_star`: INT, `1_star`: INT>>,
        engagement: STRUCT<avg_playtime_hours: DOUBLE, peak_concurrent_players: INT,
                           estimated_owners: STRING, wishlist_count: INT>>,
    content_analysis STRUCT<
        sentiment_analysis: STRUCT<positive_sentiment: DOUBLE, negative_sentiment: DOUBLE,
                                   neutral_sentiment: DOUBLE>,
        common_keywords: ARRAY<STRING>,
        recommendation_reasons: ARRAY<STRUCT<reason: STRING, frequency: INT>>>,
    metadata STRUCT<last_updated: STRING, data_source: STRING, confidence_score: DOUBLE,
                    flags: ARRAY<STRING>>
""")

CATALOG_ELEMENT = ("""
    _id STRING,
    basic_info STRUCT<name: STRING, developer: STRING, release_date: STRING>,
    reviews_summary STRUCT<total_count: STRING, average_rating: STRING,
                           recommendation_rate: STRING>,
    pricing STRUCT<base_price: STRUCT<_VALUE: STRING, _currency: STRING>,
                   current_price: STRUCT<_VALUE: STRING, _currency: STRING>>
""")

SERVER_CONFIG = ("""
    game_server_name STRING, game_server_host STRING, game_server_port BIGINT,
    game_server_max_players BIGINT, game_server_region STRING,
    game_settings_difficulty STRING, game_settings_game_mode STRING,
    game_settings_map_rotation ARRAY<STRING>, game_settings_round_time_minutes BIGINT,
    game_settings_friendly_fire BOOLEAN,
    anti_cheat_enabled BOOLEAN, anti_cheat_provider STRING, anti_cheat_logging_level STRING,
    anti_cheat_auto_ban_threshold BIGINT,
    performance_tick_rate BIGINT, performance_bandwidth_limit_mbps BIGINT,
    performance_cpu_priority STRING, performance_memory_limit_gb BIGINT,
    logging_chat_logs BOOLEAN, logging_player_actions BOOLEAN, logging_system_events BOOLEAN,
    logging_rotation_days BIGINT, logging_compression STRING
""")

# Catalog tables.
DATASETS = (
    "dataset_id STRING, name STRING, path STRING, format STRING, size_bytes BIGINT, "
    "row_count BIGINT, column_count INT, created_date TIMESTAMP, last_updated TIMESTAMP, "
    "checksum STRING, description STRING, tags ARRAY<STRING>, owner STRING, classification STRING"
)
DATASET_COLUMNS = (
    "dataset_id STRING, column_name STRING, data_type STRING, nullable BOOLEAN, "
    "unique_values BIGINT, null_count BIGINT, min_value STRING, max_value STRING, pii_flag BOOLEAN"
)
LINEAGE = (
    "source_dataset STRING, target_dataset STRING, transformation_type STRING, "
    "transformation_details STRING, created_date TIMESTAMP, created_by STRING"
)
ACCESS_LOGS = (
    "dataset_name STRING, user_id STRING, access_type STRING, timestamp TIMESTAMP, "
    "ip_address STRING, success BOOLEAN"
)
