"""The driver tables in the shapes of the game-store inputs, as lazy frames."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.functions.features import with_features
from ludolake.functions.text import sentiment_indicator
from ludolake.operators.enrich import enrich_game_metrics, enrich_player_stats

AS_OF = "2024-01-30 23:00:00"
BROADCAST_ROWS = 100_000  # parts that may travel whole; counted from the file's footer


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _renamed(column: str, pairs: dict[str, str], default: str) -> Column:
    chain = None
    for source, target in pairs.items():
        hit = F.col(column) == source
        chain = F.when(hit, F.lit(target)) if chain is None else chain.when(hit, F.lit(target))
    return chain.otherwise(F.lit(default))


class Lake:
    """Tables of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def games(self) -> DataFrame:
        sales = self.table("lineitem").groupBy("l_partkey").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_returnflag") != "R").alias("pos"), F.min("l_shipdate").alias("d"))
        key, size = F.col("p_partkey"), F.col("p_size")
        price = F.when(key % 7 == 0, F.lit(0.0)).otherwise((size * 5 - 1) / F.lit(4.0))
        discount = (size % 4).cast("double") * F.lit(5.0)
        parts = self.table("part")
        if parts.count() > BROADCAST_ROWS:  # its compressed file may still look small enough to be broadcast
            parts = parts.hint("merge")
        return parts.join(sales, F.col("p_partkey") == F.col("l_partkey")).select(
            key.alias("app_id"), _text(F.col("p_name"), " ", key).alias("title"),
            F.date_format("d", "yyyy-MM-dd").alias("date_release"),
            F.lit(True).alias("win"), (key % 3 == 0).alias("mac"), (key % 5 == 0).alias("linux"),
            _renamed("p_type", {"STANDARD": "Very Positive", "SMALL": "Positive", "LARGE": "Mostly Positive",
                                "PROMO": "Mixed", "MEDIUM": "Mostly Negative"}, "Negative").alias("rating"),
            F.floor(F.col("pos") * 100 / F.col("n")).cast("int").alias("positive_ratio"),
            (F.col("n") * F.col("n") * (key % 97)).cast("int").alias("user_reviews"),
            price.alias("price_final"), (price + discount).alias("price_original"),
            discount.alias("discount"), (key % 2 == 0).alias("steam_deck"))

    @cached_property
    def gappy_games(self) -> DataFrame:
        """Games with missing and out-of-range values."""
        def unless(divisor: int, name: str, value=None) -> Column:
            return F.when(F.col("app_id") % divisor == 0, F.lit(value)).otherwise(F.col(name)).alias(name)

        return self.games.select(
            "app_id", unless(17, "title"), unless(13, "date_release"), "win", "mac", "linux",
            unless(29, "rating"), unless(31, "positive_ratio", 120), unless(23, "user_reviews"),
            unless(19, "price_final"), "price_original", unless(11, "discount"), "steam_deck")

    @cached_property
    def featured(self) -> DataFrame:
        return with_features(self.games)

    @cached_property
    def clustered(self) -> DataFrame:
        """Games with a fixed cluster label."""
        return self.featured.withColumn("cluster", (F.col("app_id") % 13).cast("int"))

    @cached_property
    def player_events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", _text("player_", F.col("user_id")).alias("player_id"),
            _text("game_", F.col("event_id") % 50).alias("game_id"),
            _text(F.col("user_id"), "-", F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
            _renamed("event_type", {"click": "login", "view": "game_start", "signup": "achievement_unlock",
                                    "purchase": "purchase"}, "game_crash").alias("event_type"),
            F.col("ts").alias("timestamp"), F.col("ts").alias("processed_at"))

    @cached_property
    def server_logs(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            _renamed("event_type", {"error": "ERROR", "click": "DEBUG", "signup": "WARNING"}, "INFO").alias("level"),
            _renamed("event_type", {"view": "Player joined server", "purchase": "Player left server",
                                    "error": "Connection timeout"}, "Game started").alias("action"),
            _text("srv_", F.col("event_id") % 10).alias("server_id"),
            _text("player_", F.col("user_id")).alias("player_id"),
            (F.col("value") * 20).alias("response_time_ms"),
            F.col("ts").alias("timestamp"), F.col("ts").alias("processed_at"))

    @cached_property
    def raw_game_metrics(self) -> DataFrame:
        return self.table("events").select(
            "event_id", _text("game_", F.col("event_id") % 50).alias("game_id"),
            (F.col("event_id") % 1000).cast("int").alias("concurrent_players"),
            (F.col("value") / 50).alias("crash_rate_percent"), F.col("ts").alias("processed_at"))

    @cached_property
    def game_metrics(self) -> DataFrame:
        return enrich_game_metrics(self.raw_game_metrics)

    @cached_property
    def raw_player_stats(self) -> DataFrame:
        return self.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select(
            _text("player_", F.col("user_id")).alias("player_id"),
            (F.col("n") * (F.col("user_id") % 20)).cast("double").alias("total_playtime_hours"))

    @cached_property
    def player_stats(self) -> DataFrame:
        return enrich_player_stats(self.raw_player_stats).drop("processed_at")

    @cached_property
    def reviews(self) -> DataFrame:
        minute = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
        return self.table("documents").select(
            "doc_id", F.concat(F.lit("rev_"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("review_id"),
            "text", F.date_format(minute, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            (F.col("n_chars") % 200).cast("int").alias("playtime_hours"),
            (F.col("doc_id") % 101).cast("int").alias("helpful_votes"),
            ((F.col("doc_id") * 7) % 151).cast("int").alias("total_votes"))

    @cached_property
    def raw_streamed_reviews(self) -> DataFrame:
        seconds = F.lit(1704067200) + (F.col("conv_id") * 10 + F.col("turn")) * 60
        return self.table("conversations").select(
            _text("msg_", F.col("conv_id"), "_", F.col("turn")).alias("review_id"),
            _text("player_", F.col("conv_id") % 500).alias("player_id"),
            _text("game_", F.col("conv_id") % 50).alias("game_id"),
            (F.lit(1) + (F.col("conv_id") + F.col("turn")) % 10).cast("int").alias("rating"),
            F.col("text").alias("review_text"), (F.col("conv_id") % 101).cast("int").alias("helpful_votes"),
            ((F.col("conv_id") * 7) % 151).cast("int").alias("total_votes"),
            F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("processed_at"))

    @cached_property
    def streamed_reviews(self) -> DataFrame:
        return self.raw_streamed_reviews.withColumn("sentiment_indicator", sentiment_indicator(F.col("review_text")))

    @cached_property
    def server_configs(self) -> DataFrame:
        key = F.col("s_suppkey")
        regions = F.array(*[F.lit(r) for r in ("us-east", "us-west", "eu-central", "asia-pacific")])
        return self.table("supplier").select(
            _text("game_server_", key).alias("game_server_name"),
            (F.lit(7000) + key % 2000).cast("bigint").alias("game_server_port"),
            (F.lit(16) * (F.lit(1) + key % 8)).cast("bigint").alias("game_server_max_players"),
            F.element_at(regions, F.col("s_nationkey") % 4 + 1).alias("game_server_region"),
            (key % 2 == 0).alias("game_settings_friendly_fire"),
            (F.lit(64) * (F.lit(1) + key % 3)).cast("bigint").alias("performance_tick_rate"))
