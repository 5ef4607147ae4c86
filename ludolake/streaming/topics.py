"""One query per topic, alerts in flight, windowed counts, and scoring of streamed games."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ludolake.operators.enrich import ENRICHERS, alerts_for
from ludolake.operators.kmeans import assign_clusters
from ludolake.operators.metrics import SKETCH_BITS, retrain_gate
from ludolake.schemas import TOPICS
from ludolake.sinks.files import FILES_AN_HOUR, write_stream_batches


def stream_topic(source: DataFrame, topic_key: str, root: str, checkpoint_root: str,
                 processed_at: Column | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Decoded events of one topic, enriched and written as micro-batches."""
    enriched = ENRICHERS[topic_key](source, processed_at)
    # games come in few feeds and are read as a whole by fits, which want even parts
    files = FILES_AN_HOUR if topic_key == "games_stream" else None
    return write_stream_batches(enriched, topic_key, root, f"{checkpoint_root}/{topic_key}",
                                F.col("processed_at"), trigger, files)


def start_all(open_source: Callable[[str], DataFrame], root: str, checkpoint_root: str,
              topics: list[str] | None = None, processed_at: Callable[[str], Column | None] | None = None,
              trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """All topics at once, each its own query with its own checkpoint."""
    return {key: stream_topic(open_source(key), key, root, checkpoint_root,
                              processed_at(key) if processed_at else None, trigger)
            for key in (topics or list(TOPICS))}


def stream_alerts(topic_key: str, source: DataFrame, processed_at: Column | None = None) -> DataFrame | None:
    """Alert and notice rows of a stream, stateless."""
    return alerts_for(topic_key, ENRICHERS[topic_key](source, processed_at))


def active_players_stream(events: DataFrame, ts_column: str = "event_time", late: str = "10 minutes",
                          length: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Exact distinct players per sliding window.

    First one row per player and pane of ``slide`` length, so events are counted before they are copied
    into the windows that hold them; then one row per window and player, then a count per window: three
    stateful aggregations in append mode. State is spread by window and player and dropped
    behind the watermark, so no window is held in one place. ``slide`` must divide ``length``.
    """
    panes = (events.withWatermark(ts_column, late).groupBy(F.window(ts_column, slide).alias("pane"), "player_id")
             .agg(F.count(F.lit(1)).alias("n")))
    per_player = (panes.select(F.window_time("pane").alias("pane_time"), "player_id", "n")
                  .groupBy(F.window("pane_time", length, slide), "player_id")
                  .agg(F.sum("n").alias("events")))
    return (per_player.groupBy("window")
            .agg(F.count(F.lit(1)).alias("active_players"), F.sum("events").alias("events")))


def active_players_sketch_stream(events: DataFrame, ts_column: str = "event_time", late: str = "10 minutes",
                                 length: str = "1 hour", slide: str = "5 minutes",
                                 lg_k: int = SKETCH_BITS) -> DataFrame:
    """Estimated distinct players per sliding window, with state that doesn't grow with the players.

    Each pane of ``slide`` length holds one sketch; the sketches of a window's panes are merged when the panes are complete. So
    state is one row for each open pane and window, of ``2 ** lg_k`` bytes at most, where the exact form keeps a row for
    each player of a window. The relative standard error is about ``1.04 / sqrt(2 ** lg_k)``. ``slide`` must divide ``length``.
    """
    panes = (events.withWatermark(ts_column, late).groupBy(F.window(ts_column, slide).alias("pane"))
             .agg(F.hll_sketch_agg(F.col("player_id"), F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("n")))
    return (panes.select(F.window_time("pane").alias("pane_time"), "sketch", "n")
            .groupBy(F.window("pane_time", length, slide))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_players"), F.sum("n").alias("events")))


def event_counts_stream(events: DataFrame, ts_column: str = "event_time", late: str = "10 minutes",
                        length: str = "1 hour") -> DataFrame:
    """Events per type and tumbling hour."""
    return (events.withWatermark(ts_column, late)
            .groupBy(F.window(ts_column, length), "event_type")
            .agg(F.count(F.lit(1)).alias("events")))


def cluster_stream(spark: SparkSession, model_path: str, games: DataFrame) -> DataFrame:
    """Streamed (prepared) games with the cluster of a saved model."""
    return assign_clusters(PipelineModel.load(model_path), games)


def retrain_when_ready(games: DataFrame, files: DataFrame, as_of, retrain: Callable[[DataFrame], object],
                       min_games: int = 80) -> bool:
    """Runs ``retrain`` when the gate is open; says whether it did."""
    ready = bool(retrain_gate(games, files, as_of, min_games).first()["sufficient_data"])
    if ready:
        retrain(games)
    return ready
