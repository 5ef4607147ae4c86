"""Enrichment of the six event types. The same functions serve batch frames and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.functions.predicates import required_fields_present
from ludolake.functions.text import sentiment_indicator

ALERT_COLUMNS = ["source", "type", "entity", "message"]


def _stamp(df: DataFrame, processed_at: Column | None) -> DataFrame:
    """Arrival time; a frame that already has one keeps it unless a new one is given."""
    if processed_at is not None:
        return df.withColumn("processed_at", processed_at)
    return df if "processed_at" in df.columns else df.withColumn("processed_at", F.current_timestamp())


def _event_time(df: DataFrame) -> Column:
    if dict(df.dtypes)["timestamp"] == "string":
        return F.try_to_timestamp(F.col("timestamp"))
    return F.col("timestamp")


def enrich_player_events(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    hour = F.when(F.col("event_type") == "game_start", F.hour(_event_time(df)))
    return _stamp(df, processed_at).withColumn("session_start_hour", hour)


def enrich_reviews(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamp(df, processed_at).withColumn(
        "sentiment_indicator", sentiment_indicator(F.col("review_text")))


def enrich_server_logs(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    ms = F.col("response_time_ms")
    speed = F.when(ms != 0, F.when(ms > 5000, F.lit("slow")).when(ms > 1000, F.lit("medium"))
                   .otherwise(F.lit("fast")))
    return _stamp(df, processed_at).withColumn("performance_category", speed)


def enrich_player_stats(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    hours = F.coalesce(F.col("total_playtime_hours"), F.lit(0))
    category = (F.when(hours > 1000, F.lit("hardcore")).when(hours > 100, F.lit("regular"))
                .otherwise(F.lit("casual")))
    return _stamp(df, processed_at).withColumn("player_category", category)


def enrich_game_metrics(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    crash = F.coalesce(F.col("crash_rate_percent"), F.lit(0.0))
    status = (F.when(crash > 2.0, F.lit("poor")).when(crash > 1.0, F.lit("moderate"))
              .otherwise(F.lit("good")))
    return _stamp(df, processed_at).withColumn("health_status", status)


def enrich_games_stream(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Games with all required fields, marked ready for clustering."""
    ready = _stamp(df.filter(required_fields_present()), processed_at)
    extracted = F.when(F.col("features").isNotNull(), F.lit(True)) if "features" in df.columns \
        else F.lit(None).cast("boolean")
    return ready.withColumns({
        "clustering_ready": F.lit(True),
        "data_source": F.lit("kafka_stream"),
        "features_extracted": extracted,
    })


ENRICHERS = {
    "player_events": enrich_player_events,
    "game_reviews": enrich_reviews,
    "server_logs": enrich_server_logs,
    "player_stats": enrich_player_stats,
    "game_metrics": enrich_game_metrics,
    "games_stream": enrich_games_stream,
}


def _notice(df: DataFrame, condition: Column, source: str, kind: str, entity: Column,
            message: Column) -> DataFrame:
    return df.filter(condition).select(
        F.lit(source).alias("source"), F.lit(kind).alias("type"),
        entity.cast("string").alias("entity"), message.alias("message"))


def alerts_for(event_type: str, df: DataFrame) -> DataFrame | None:
    """Alert or notice rows of one enriched event type; None where the type raises none."""
    col = F.col
    if event_type == "player_events":
        return _notice(df, col("event_type") == "game_crash", event_type, "game_crash",
                       col("player_id"), F.concat(F.lit("Game crash detected for player "), col("player_id")))
    if event_type == "game_reviews":
        hit = (col("sentiment_indicator") == "negative") & (col("helpful_votes") > 10)
        return _notice(df, hit, event_type, "negative_review", col("game_id"),
                       F.concat(F.lit("High-impact negative review detected for game "), col("game_id")))
    if event_type == "server_logs":
        return _notice(df, col("level") == "ERROR", event_type, "server_error", col("server_id"),
                       F.concat(F.lit("Server error: "), col("message"), F.lit(" on "), col("server_id")))
    if event_type == "game_metrics":
        rate = F.round(col("crash_rate_percent"), 4).cast("string")
        return _notice(df, col("crash_rate_percent") > 3.0, event_type, "crash_rate", col("game_id"),
                       F.concat(F.lit("High crash rate ("), rate, F.lit("%) for game "), col("game_id")))
    if event_type == "games_stream":
        # one pass: explode the notices a row earns instead of scanning once per notice type
        price = F.when(col("price_final") > 50, F.struct(
            F.lit("high_value").alias("type"),
            F.concat(F.lit("High-value game streamed: "), col("title"), F.lit(" - $"),
                     col("price_final").cast("string")).alias("message")))
        popular = F.when(col("user_reviews") > 10000, F.struct(
            F.lit("popular").alias("type"),
            F.concat(F.lit("Popular game streamed: "), col("title"), F.lit(" - "),
                     col("user_reviews").cast("string"), F.lit(" reviews")).alias("message")))
        earned = F.filter(F.array(price, popular), lambda n: n.isNotNull())
        return (df.select(F.col("app_id").cast("string").alias("entity"), F.explode(earned).alias("n"))
                .select(F.lit(event_type).alias("source"), F.col("n.type").alias("type"),
                        "entity", F.col("n.message").alias("message")))
    return None


def alert_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """Alerts and notices of several enriched frames, one row each."""
    found = [alerts_for(kind, df) for kind, df in frames.items()]
    return reduce(DataFrame.unionByName, [f for f in found if f is not None])
