"""Player, server, game and review metrics over (combined batch + stream) frames.

Every function makes one pass over each frame it is given. Metrics of different frames meet as
one-row results only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.functions.predicates import (CONNECTION, JOINED, LEFT, REVIEW_CATEGORIES,
                                           action_matches, hours_before, id_category, last_hours,
                                           moment)
from ludolake.operators.frames import beside, counted, last_n, top_counts, unpivot_row


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


SKETCH_BITS = 14  # 16 KB a sketch, 0.8 % standard error


# ---- overview ---------------------------------------------------------------------------

def active_players(events: DataFrame, as_of, hours: float = 1, ts_column: str = "processed_at") -> DataFrame:
    return (last_hours(events, ts_column, hours, as_of)
            .agg(F.count_distinct("player_id").alias("active_players")))


def _until(df: DataFrame, ts_column: str, as_of) -> DataFrame:
    """The rows up to ``as_of``; all rows without it."""
    return df if as_of is None else df.filter(F.col(ts_column) <= F.lit(as_of).cast("timestamp"))


def player_sketches(events: DataFrame, pane: str = "5 minutes", ts_column: str = "processed_at",
                    lg_k: int = SKETCH_BITS) -> DataFrame:
    """(pane_start, sketch, events): a mergeable distinct-player sketch for each pane of time.

    Rows are aggregated before the shuffle, and a pane has at most ``2 ** lg_k`` bytes however many players it saw.
    Rows without time or player count as events only if they have a time.
    """
    return (events.filter(F.col(ts_column).isNotNull()).groupBy(F.window(ts_column, pane).alias("w"))
            .agg(F.hll_sketch_agg(F.col("player_id"), F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("pane_start"), "sketch", "events"))


def active_players_from_sketches(sketches: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Estimated distinct players of the panes that begin in the last hours: the panes' sketches are merged, no
    player is read again. The relative standard error is about ``1.04 / sqrt(2 ** lg_k)``.
    """
    recent = last_hours(sketches, "pane_start", hours, as_of)
    return recent.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("active_players"),
                      F.coalesce(F.sum("events"), F.lit(0)).alias("events"))


def rolling_health(metrics: DataFrame, n: int = 10, ts_column: str = "processed_at",
                   id_column: str = "event_id", as_of=None) -> DataFrame:
    """Status from the poor share of the newest ``n`` metrics, of those up to ``as_of`` if that is given."""
    metrics = _until(metrics, ts_column, as_of)
    poor = last_n(metrics.select(ts_column, id_column, "health_status"), n, ts_column, id_column).agg(
        counted(F.col("health_status") == "poor", "poor_count"))
    return poor.withColumn("server_health_status",
                           F.when(F.col("poor_count") > 3, F.lit("poor"))
                           .when(F.col("poor_count") > 1, F.lit("moderate")).otherwise(F.lit("good")))


def overview(games: DataFrame, reviews: DataFrame, logs: DataFrame, events: DataFrame,
             metrics: DataFrame, as_of) -> DataFrame:
    """Counts, mean playtime, live players, health and availability flags in one row."""
    available = [
        frame.agg((F.count(F.lit(1)) > 0).alias(f"{name}_available"))
        for name, frame in (("player_events", last_hours(events, "processed_at", 1, as_of)),
                            ("game_metrics", last_hours(metrics, "processed_at", 1, as_of)))
    ]
    wide = beside(
        games.agg(_rows("total_games")),
        reviews.agg(_rows("total_reviews"), F.avg("playtime_hours").alias("avg_playtime")),
        logs.agg(_rows("total_log_entries")),
        active_players(events, as_of),
        rolling_health(metrics, as_of=as_of).select("server_health_status"),
        *available,
    )
    return wide.withColumns({
        "avg_playtime": F.coalesce("avg_playtime", F.lit(0.0)),
        "reviews_available": F.col("total_reviews") > 0,
        "logs_available": F.col("total_log_entries") > 0,
    })


# ---- players ----------------------------------------------------------------------------

def playtime_distribution(reviews: DataFrame, column: str = "playtime_hours") -> DataFrame:
    """Rows per playtime band; empty bands stay with 0."""
    h = F.col(column)
    bands = {"0-10h": h <= 10, "10-50h": (h > 10) & (h <= 50),
             "50-100h": (h > 50) & (h <= 100), "100h+": h > 100}
    return unpivot_row(reviews.agg(*[counted(c, b) for b, c in bands.items()]),
                       "playtime_range", "reviews", list(bands), "bigint")


def player_category_counts(stats: DataFrame) -> DataFrame:
    labels = ["casual", "regular", "hardcore"]
    return unpivot_row(stats.agg(*[counted(F.col("player_category") == v, v) for v in labels]),
                       "player_category", "players", labels, "bigint")


def activity_trends(events: DataFrame, as_of, hours: float = 1, k: int = 5) -> DataFrame:
    return top_counts(last_hours(events, "processed_at", hours, as_of), "event_type", k)


def server_activity(logs: DataFrame) -> DataFrame:
    return logs.agg(counted(action_matches(JOINED), "joins"), counted(action_matches(LEFT), "leaves"))


# ---- servers ----------------------------------------------------------------------------

def log_level_distribution(logs: DataFrame) -> DataFrame:
    return top_counts(logs, "level", name="entries")


def recent_errors(logs: DataFrame, as_of, hours: float = 1, ts_column: str = "timestamp") -> DataFrame:
    return (last_hours(logs, ts_column, hours, as_of)
            .agg(counted(F.col("level") == "ERROR", "recent_errors")))


def connection_count(logs: DataFrame) -> DataFrame:
    return logs.agg(counted(action_matches(CONNECTION), "total_connections"))


def top_actions(logs: DataFrame, k: int = 5) -> DataFrame:
    return top_counts(logs, "action", k, "entries")


def server_performance(metrics: DataFrame, n: int = 20, ts_column: str = "processed_at",
                       id_column: str = "event_id", as_of=None) -> DataFrame:
    """Means of the newest ``n`` metrics, of those up to ``as_of`` if that is given."""
    metrics = _until(metrics, ts_column, as_of)
    newest = last_n(metrics.select(ts_column, id_column, "concurrent_players", "crash_rate_percent",
                                   "health_status"), n, ts_column, id_column)
    return newest.agg(
        F.coalesce(F.avg("concurrent_players").cast("bigint"), F.lit(0)).alias("concurrent_players"),
        F.coalesce(F.avg("crash_rate_percent"), F.lit(0.0)).alias("crash_rate"),
        F.coalesce(F.max_by("health_status", F.struct(ts_column, id_column)),
                   F.lit("unknown")).alias("health_status"))


def server_capacity(configs: DataFrame, column: str = "game_server_max_players") -> DataFrame:
    return configs.agg(
        _rows("active_servers"),
        F.coalesce(F.round(F.avg(column), 0), F.lit(0.0)).alias("avg_max_players"),
        F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias("total_capacity"))


def server_alerts(logs: DataFrame, metrics: DataFrame, as_of) -> DataFrame:
    """Alert rows (type, message, severity) out of recent errors and server performance."""
    state = beside(recent_errors(logs, as_of), server_performance(metrics, as_of=as_of))

    def alert(kind, message):
        return F.struct(F.lit(kind).alias("type"), message.alias("message"), F.lit("high").alias("severity"))

    raised = F.array(
        F.when(F.col("recent_errors") > 10, alert("error", F.concat(
            F.lit("High error rate: "), F.col("recent_errors").cast("string"), F.lit(" errors in last hour")))),
        F.when(F.col("crash_rate") > 2.0, alert("performance", F.concat(
            F.lit("High crash rate: "), F.round("crash_rate", 1).cast("string"), F.lit("%")))),
        F.when(F.col("health_status") == "poor", alert("health", F.lit("Server health status is poor"))),
    )
    return state.select(F.inline(F.filter(raised, lambda a: a.isNotNull())))


# ---- games ------------------------------------------------------------------------------

def game_performance(metrics: DataFrame, as_of, hours: float = 24, ts_column: str = "processed_at") -> DataFrame:
    """Means and active games over all metrics of the last hours."""
    return last_hours(metrics, ts_column, hours, as_of).agg(
        F.coalesce(F.avg("concurrent_players").cast("bigint"), F.lit(0)).alias("concurrent_players"),
        F.coalesce(F.avg("crash_rate_percent"), F.lit(0.0)).alias("avg_crash_rate"),
        counted(F.col("health_status") == "poor", "games_with_poor_health"),
        F.count_distinct("game_id").alias("total_active_games"))


def top_games_by_activity(events: DataFrame, k: int = 10) -> DataFrame:
    return top_counts(events, "game_id", k)


def reviews_by_category(reviews: DataFrame) -> DataFrame:
    names = list(REVIEW_CATEGORIES)
    return unpivot_row(reviews.agg(*[counted(id_category(n), n) for n in names]),
                       "category", "reviews", names, "bigint")


def helpful_ratio(reviews: DataFrame) -> DataFrame:
    helpful, total = F.sum("helpful_votes"), F.sum("total_votes")
    ratio = F.when(total > 0, helpful / total).otherwise(F.lit(0.0))
    return reviews.agg(F.round(ratio * F.lit(100.0), 2).alias("avg_helpful_ratio"))


def recent_review_count(reviews: DataFrame, sample_size: int | None = None) -> DataFrame:
    """Number of reviews that are scored: all, or a sample where one is asked for."""
    n = F.count(F.lit(1))
    scored = n if sample_size is None else F.least(n, F.lit(sample_size))
    return reviews.agg(scored.cast("bigint").alias("recent_reviews_count"))


def engagement(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.agg(
        counted(kind == "game_start", "total_sessions"),
        counted(kind == "achievement_unlock", "achievement_unlocks"),
        counted(kind == "purchase", "purchases"),
        _rows("total_events"))


def events_per_session(events: DataFrame) -> DataFrame:
    """Mean number of events per session, 0 without sessions."""
    ratio = F.try_divide(F.count(F.lit(1)), F.count_distinct("session_id"))
    return events.agg(F.coalesce(F.round(ratio, 1), F.lit(0.0)).alias("events_per_session"))


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Averages, maxima and the number of metrics per health status, in one pass."""
    status = F.col("health_status")
    return metrics.agg(
        F.avg("concurrent_players").alias("avg_concurrent_players"),
        F.max("concurrent_players").alias("max_concurrent_players"),
        F.avg("crash_rate_percent").alias("avg_crash_rate"),
        F.max("crash_rate_percent").alias("max_crash_rate"),
        *[counted(status == s, f"health_{s}") for s in ("good", "moderate", "poor")])


def review_stats(reviews: DataFrame) -> DataFrame:
    """Distribution of indicator and rating as (statistic, value, reviews) rows plus totals."""
    totals = reviews.agg(
        F.avg("rating").alias("avg_rating"), F.sum("helpful_votes").cast("bigint").alias("total_helpful_votes"),
        F.avg("helpful_votes").alias("avg_helpful_votes"))
    cells = reviews.groupBy("sentiment_indicator", "rating").agg(F.count(F.lit(1)).alias("n"))
    spread = cells.select(F.explode(F.array(
        F.struct(F.lit("sentiment").alias("statistic"), F.col("sentiment_indicator").alias("value"),
                 F.col("n").alias("n")),
        F.struct(F.lit("rating").alias("statistic"), F.col("rating").cast("string").alias("value"),
                 F.col("n").alias("n")))).alias("c"))
    counts = (spread.filter(F.col("c.value").isNotNull())
              .groupBy(F.col("c.statistic").alias("statistic"), F.col("c.value").alias("value"))
              .agg(F.sum("c.n").cast("double").alias("amount")))
    summary = unpivot_row(totals, "value", "amount",
                          ["avg_rating", "total_helpful_votes", "avg_helpful_votes"], "double")
    return counts.unionByName(summary.withColumn("statistic", F.lit("summary")))


# ---- files and freshness ----------------------------------------------------------------

EXPECTED_STREAMS = ["player_events", "game_reviews", "server_logs", "player_stats", "game_metrics"]


def stream_availability(files: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Per expected stream: file count, availability, last change; plus the overall last change."""
    names = expected or EXPECTED_STREAMS
    kind = F.regexp_extract("path", "streaming/([^/]+)/", 1)
    per_type = [counted(kind == n, f"{n}|files") for n in names]
    latest = [F.max(F.when(kind == n, F.col("modificationTime"))).alias(f"{n}|at") for n in names]
    row = files.agg(*per_type, *latest)
    last = F.greatest(*[F.col(f"`{n}|at`") for n in names])
    return row.select(F.inline(F.array(*[F.struct(
        F.lit(n).alias("data_type"), F.col(f"`{n}|files`").alias("file_count"),
        (F.col(f"`{n}|files`") > 0).alias("available"), F.col(f"`{n}|at`").alias("last_modified"),
        last.alias("last_activity")) for n in names])))


def retrain_gate(games: DataFrame, files: DataFrame, as_of, min_games: int = 80) -> DataFrame:
    """Whether enough games have arrived to refit; counted rows, not an estimate per file."""
    seen = files.agg(_rows("total_files"),
                     counted((F.col("modificationTime") > hours_before(as_of, 1))
                             & (F.col("modificationTime") <= moment(as_of)), "recent_files_1h"))
    return beside(games.agg(_rows("games")), seen).withColumn(
        "sufficient_data", F.col("games") >= F.lit(min_games))


def cluster_freshness(files: DataFrame, as_of) -> DataFrame:
    """Age of the newest cluster table and an overall status."""
    path = F.col("path")
    clusters = path.rlike("games_clusters_latest")
    analysis = path.rlike("cluster_analysis_latest")
    row = files.agg(
        F.max(F.when(clusters, F.col("modificationTime"))).alias("clusters_at"),
        F.max(F.when(analysis, F.col("modificationTime"))).alias("analysis_at"))
    age = (F.unix_micros(moment(as_of)) - F.unix_micros("clusters_at")) / F.lit(1_000_000.0)
    both = F.col("clusters_at").isNotNull() & F.col("analysis_at").isNotNull()
    return row.withColumns({
        "hours_old": age / F.lit(3600.0),
        "minutes_old": age / F.lit(60.0),
        "is_fresh": age < 12 * 3600,
        "is_very_fresh": age < 10 * 60,
    }).withColumn("clustering_status",
                  F.when(both, F.when(F.col("is_fresh"), F.lit("healthy")).otherwise(F.lit("stale")))
                  .otherwise(F.lit("no_data")))
