"""Sources, sinks and streams (ids S, K, R): derived files are written, read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.functions import features as ft
from ludolake.operators import clusters, kmeans, metrics, search
from ludolake.plans.feature_queries import ALERTS
from ludolake.plans.game_queries import PROFILE_FEATURES, PROFILE_SQL, fitted
from ludolake.plans.registry import query, written_once
from ludolake.plans.sql_views import AS_OF as SQL_AS_OF
from ludolake.plans.views import AS_OF, Lake
from ludolake.schemas import GAMES, TOPICS, names
from ludolake.session import scratch_path
from ludolake.sinks import files as sink
from ludolake.sources import batches, files, topics
from ludolake.streaming import buffers, intake, models
from ludolake.streaming import topics as streams

ONCE = {"availableNow": True}


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# ---- file sources -------------------------------------------------------------------------

@query("s1_read_games_csv", """
    SELECT CAST(app_id AS INTEGER) AS app_id, title, date_release, mac, linux, rating, positive_ratio, user_reviews,
           price_final, price_original, discount, steam_deck FROM gappy_games""")
def _(lake):
    columns = names(GAMES)
    path = written_once(lake, "games-csv", lambda p: lake.gappy_games.select(*columns).write.option(
        "header", True).csv(p))
    return files.read_games_csv(lake.spark, path).drop("win")


LINE_BREAKS = r"[\n\r\x{85}\x{2028}\x{2029}]+"


@query("s3_read_review_records", f"""
    SELECT review_id, timestamp, playtime_hours, helpful_votes, total_votes,
           trim(regexp_replace(text, '{LINE_BREAKS}', ' ', 'g'), ' ' || chr(9) || chr(13)) AS text FROM reviews""")
def _(lake):
    one_line = F.regexp_replace("text", LINE_BREAKS, " ")
    block = F.concat(
        F.lit("Review ID: "), F.col("review_id"), F.lit("\nDate: "), F.col("timestamp"),
        F.lit("\nPlaytime: "), F.col("playtime_hours").cast("string"), F.lit(" hours\nHelpful: "),
        F.col("helpful_votes").cast("string"), F.lit("/"), F.col("total_votes").cast("string"),
        F.lit("\nReview: "), one_line, F.lit(f"\n{files.REVIEW_SEPARATOR}\n"))
    path = written_once(lake, "review-blocks", lambda p: lake.reviews.select(block.alias("value")).write.text(p))
    return files.read_review_records(lake.spark, path)


def _game_document() -> Column:
    overall = F.col("positive_ratio") / F.lit(20.0)
    platforms = F.filter(F.array(F.when(F.col("win"), F.lit("Windows")), F.when(F.col("mac"), F.lit("Mac")),
                                 F.when(F.col("linux"), F.lit("Linux"))), lambda p: p.isNotNull())
    return [
        F.struct(
            F.struct(F.col("title").alias("name"), F.col("app_id").cast("int").alias("id"),
                     F.col("date_release").alias("release_date")).alias("basic"),
            F.struct(platforms.alias("platforms")).alias("details"),
            F.struct(F.col("price_original").alias("base_price"), F.col("price_final").alias("current_price"))
            .alias("pricing")).alias("game_info"),
        F.struct(F.struct(overall.alias("overall_score"), F.col("user_reviews").alias("total_reviews"))
                 .alias("ratings")).alias("user_metrics"),
        F.struct(F.array(F.struct(F.col("rating").alias("reason"), F.col("user_reviews").alias("frequency")))
                 .alias("recommendation_reasons")).alias("content_analysis"),
    ]


@query("s4_read_games_json", """
    SELECT CAST(app_id AS INTEGER) AS id, title AS name,
           concat_ws(',', 'Windows', CASE WHEN mac THEN 'Mac' END, CASE WHEN linux THEN 'Linux' END) AS platforms,
           price_original AS base_price, round(positive_ratio / 20.0e0, 6) AS overall_score, rating AS reason,
           user_reviews AS frequency FROM games""")
def _(lake):
    path = written_once(lake, "games-json", lambda p: lake.games.select(*_game_document()).write.json(p))
    games = files.read_games_json(lake.spark, path, multi_line=False)
    reason = F.col("content_analysis.recommendation_reasons")[0]
    return games.select(
        F.col("game_info.basic.id").alias("id"), F.col("game_info.basic.name").alias("name"),
        F.array_join("game_info.details.platforms", ",").alias("platforms"),
        F.col("game_info.pricing.base_price").alias("base_price"),
        F.round("user_metrics.ratings.overall_score", 6).alias("overall_score"),
        reason["reason"].alias("reason"), reason["frequency"].alias("frequency"))


def _yaml_document() -> Column:
    return F.format_string(
        "game_server:\n  name: %s\n  port: %d\n  max_players: %d\n  region: %s\n"
        "game_settings:\n  friendly_fire: %s\n  map_rotation:\n  - map1\n  - map2\n"
        "performance:\n  tick_rate: %d\n---",
        "game_server_name", "game_server_port", "game_server_max_players", "game_server_region",
        F.col("game_settings_friendly_fire").cast("string"), "performance_tick_rate")


@query("s5_read_config_yaml", "SELECT *, 'map1,map2' AS map_rotation FROM server_configs")
def _(lake):
    path = written_once(lake, "configs-yaml",
                        lambda p: lake.server_configs.select(_yaml_document().alias("value")).write.text(p))
    configs = files.read_config_yaml(lake.spark, path)
    return configs.select(*lake.server_configs.columns,
                          F.array_join("game_settings_map_rotation", ",").alias("map_rotation"))


@query("s6_read_catalog_xml", """
    SELECT CAST(app_id AS VARCHAR) AS id, title AS name, date_release AS release_date,
           CAST(user_reviews AS VARCHAR) AS total_reviews, CAST(price_original AS VARCHAR) AS base_price,
           CASE WHEN app_id % 5 <> 0 THEN CAST(price_final AS VARCHAR) END AS current_price FROM games""")
def _(lake):
    def priced(column, present=F.lit(True)):
        return F.when(present, F.struct(F.col(column).cast("string").alias("_VALUE"), F.lit("USD").alias("_currency")))

    element = lake.games.select(
        F.col("app_id").cast("string").alias("_id"),
        F.struct(F.col("title").alias("name"), F.col("date_release").alias("release_date")).alias("basic_info"),
        F.struct(F.col("user_reviews").cast("string").alias("total_count")).alias("reviews_summary"),
        F.struct(priced("price_original").alias("base_price"),
                 priced("price_final", F.col("app_id") % 5 != 0).alias("current_price")).alias("pricing"))
    path = written_once(lake, "catalog-xml", lambda p: element.write.format("xml").option(
        "rowTag", "game").option("rootTag", "game_catalog").save(p))
    return files.read_catalog_xml(lake.spark, path).select(
        "id", "name", "release_date", "total_reviews", "base_price", "current_price")


@query("s7_read_server_logs", """
    SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, level, action,
           CASE WHEN event_id % 3 <> 0 THEN player_id END AS player_id FROM server_logs WHERE event_id % 7 <> 0""")
def _(lake):
    rest = F.when(F.col("event_id") % 3 == 0, F.lit("no one")).otherwise(
        F.concat(F.lit("Player: "), F.col("player_id"), F.lit(", Server: "), F.col("server_id")))
    line = F.concat(F.lit("["), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("] "), F.col("level"),
                    F.lit(": "), F.col("action"), F.lit(" - "), rest)
    # every seventh line is not a log line and has to be dropped by the reader
    value = F.when(F.col("event_id") % 7 == 0, F.lit("-- rotated --")).otherwise(line).alias("value")
    path = written_once(lake, "server-logs", lambda p: lake.server_logs.select(value).write.text(p))
    return files.read_server_logs(lake.spark, path)


def warehouse(lake: Lake) -> str:
    """A warehouse folder with three of the five expected tables."""
    def write(root: str):
        sink.write_warehouse_table(lake.reviews, root, "reviews")
        sink.write_warehouse_table(lake.games, root, "games")
        sink.write_warehouse_table(lake.server_logs, root, "logs")

    return written_once(lake, "warehouse", write)


@query("s8_read_table", "SELECT event_id, level, action, player_id FROM server_logs")
def _(lake):
    return files.read_table(lake.spark, warehouse(lake), "logs").select("event_id", "level", "action", "player_id")


@query("s9_combined_view", """
    SELECT review_id, playtime_hours, helpful_votes, total_votes, NULL AS sentiment_indicator FROM reviews
    UNION ALL SELECT review_id, NULL, helpful_votes, total_votes, sentiment_indicator FROM streamed_reviews""")
def _(lake):
    both = batches.combined_view("reviews", files.read_table(lake.spark, warehouse(lake), "reviews"),
                                 lake.streamed_reviews)
    return both.select("review_id", "playtime_hours", "helpful_votes", "total_votes", "sentiment_indicator")


# ---- streams ------------------------------------------------------------------------------

def record_frames(lake: Lake) -> dict[str, DataFrame]:
    """Each topic's events in the shape producers send them."""
    logs, stats, games = lake.server_logs, lake.raw_player_stats, lake.games
    stamped = ft.with_stream_metadata(games, F.lit(AS_OF).cast("timestamp"), F.floor(F.col("app_id") / 100), "games_feed")
    return {
        "player_events": lake.player_events.select(
            F.col("event_id").cast("string").alias("event_id"), "player_id", "game_id", "session_id", "event_type",
            _iso(F.col("timestamp")).alias("timestamp"),
            F.struct((F.col("event_id") % 100).cast("int").alias("level")).alias("metadata")),
        "game_reviews": lake.raw_streamed_reviews.select(
            "review_id", "player_id", "game_id", "rating", "review_text", "helpful_votes", "total_votes",
            _iso(F.col("processed_at")).alias("timestamp")),
        "server_logs": logs.select("level", F.col("action").alias("message"), "server_id", "response_time_ms",
                                   _iso(F.col("timestamp")).alias("timestamp")),
        "player_stats": stats.withColumn("timestamp", F.lit("2024-01-30T12:00:00")),
        "game_metrics": lake.raw_game_metrics.select("game_id", "concurrent_players", "crash_rate_percent",
                                                     _iso(F.col("processed_at")).alias("timestamp")),
        "games_stream": ft.with_feature_struct(stamped),
    }


KEYS = {"player_events": "player_id", "game_reviews": "review_id", "server_logs": "server_id",
        "player_stats": "player_id", "game_metrics": "game_id", "games_stream": "app_id"}


def records(lake: Lake) -> str:
    """(key, value) record files of all topics, one folder per topic."""
    def write(root: str):
        for topic, frame in record_frames(lake).items():
            sink.to_kafka_records(frame, KEYS[topic]).write.parquet(f"{root}/{topic}")

    return written_once(lake, "records", write)


def _event_time(topic: str) -> Column:
    return F.try_to_timestamp(F.col("streaming_metadata.timestamp" if topic == "games_stream" else "timestamp"))


def streamed(lake: Lake) -> str:
    """All topics run to their end through enrichment into micro-batch files."""
    source = records(lake)

    def write(root: str):
        started = streams.start_all(
            lambda topic: topics.read_record_files(lake.spark, f"{source}/{topic}", topic), f"{root}/streaming",
            f"{root}/checkpoints", processed_at=_event_time, trigger=ONCE)
        for q in started.values():
            q.awaitTermination()

    return written_once(lake, "streamed", write) + "/streaming"


def sunk(lake: Lake, topic: str) -> DataFrame:
    return lake.spark.read.parquet(f"{streamed(lake)}/{topic}")


@query("s2_read_recent_batches", f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, player_id, event_type FROM player_events
    WHERE processed_at BETWEEN {SQL_AS_OF} - INTERVAL 24 HOUR AND {SQL_AS_OF}""")
def _(lake):
    recent = batches.read_recent_batches(lake.spark, streamed(lake), "player_events", 24, AS_OF, _sunk_events())
    return recent.select("event_id", "player_id", "event_type")


@query("s2_read_flat_batches", """
    SELECT event_id, event_type FROM player_events WHERE event_id % 3 = 0""")
def _(lake):
    """Three files of the older layout: one of the last day, an earlier and a later one."""
    def write(root: str):
        for i, stamp in enumerate(("20240130_220000", "20240129_100000", "20240131_010000")):
            (lake.player_events.select("event_id", "event_type").filter(F.col("event_id") % 3 == i)
             .write.parquet(f"{root}/batch_{stamp}.parquet"))

    return batches.read_flat_batches(lake.spark, written_once(lake, "flat", write), 24, AS_OF)


def _sunk_events():
    return ("event_id STRING, player_id STRING, event_type STRING, ingest_time TIMESTAMP, "
            "ingest_date DATE, ingest_hour INT")


@query("s10_read_event_stream", """
    SELECT 'player_' || user_id AS record_key, CAST(event_id AS VARCHAR) AS event_id,
           CAST(event_id % 100 AS INTEGER) AS level FROM events""")
def _(lake):
    path = scratch_path(lake.spark, "decoded")
    stream = topics.read_record_files(lake.spark, f"{records(lake)}/player_events", "player_events", max_files=2)
    decoded = stream.select("record_key", "event_id", F.col("metadata.level").alias("level"))
    run = (decoded.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", f"{path}-checkpoint").trigger(**ONCE).start())
    run.awaitTermination()
    return lake.spark.read.schema("record_key STRING, event_id STRING, level INT").parquet(path)


@query("s11_batch_files", """
    SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour FROM events""")
def _(lake):
    listed = files.batch_files(lake.spark, f"{streamed(lake)}/player_events")
    return listed.filter(F.col("length") > 0).select(
        F.regexp_extract("path", "ingest_date=([0-9-]+)", 1).alias("ingest_date"),
        F.regexp_extract("path", "ingest_hour=([0-9]+)", 1).cast("int").alias("ingest_hour")).distinct()


@query("k1_stream_batches", """
    SELECT event_id, CASE WHEN event_type = 'game_start' THEN CAST(hour(timestamp) AS INTEGER) END
           AS session_start_hour, strftime(timestamp, '%Y-%m-%d') AS ingest_date,
           CAST(hour(timestamp) AS INTEGER) AS ingest_hour FROM player_events""")
def _(lake):
    return sunk(lake, "player_events").select(
        F.col("event_id").cast("bigint").alias("event_id"), "session_start_hour",
        F.col("ingest_date").cast("string").alias("ingest_date"), "ingest_hour")


@query("k2_write_clusters", """
    SELECT app_id, title, rating, user_reviews, cluster, price_final, release_year FROM clustered""")
def _(lake):
    base = scratch_path(lake.spark, "clusters")
    _, latest = sink.write_clusters(lake.clustered, base, "20240130_230000")
    return lake.spark.read.parquet(latest).select(
        "app_id", "title", "rating", "user_reviews", "cluster", "price_final", "release_year")


@query("k3_write_cluster_analysis", f"""
    SELECT '20240130_230000' AS stamp, c.cluster AS cluster_id, p.game_count, p.avg_price_final, first_sample,
           (SELECT count(*) FROM clustered) AS total_records
    FROM ({PROFILE_SQL}) p JOIN (SELECT cluster, min(app_id) AS first_sample FROM clustered GROUP BY cluster) c
         ON p.cluster = c.cluster""")
def _(lake):
    base = scratch_path(lake.spark, "analysis")
    games = lake.clustered
    totals = games.agg(F.count(F.lit(1)).alias("total_records"))
    document = clusters.cluster_analysis(games, totals, "20240130_230000", search.sample_per_cluster(games, 5),
                                         PROFILE_FEATURES)
    _, latest = sink.write_cluster_analysis(document, base, "20240130_230000")
    read = lake.spark.read.schema(document.schema).json(latest)
    return (read.select(F.col("timestamp").alias("stamp"), F.col("clustering_metrics.total_records").alias("total_records"),
                        F.explode("cluster_analysis").alias("a"))
            .select("stamp", "total_records", "a.cluster_id", "a.game_count",
                    F.round("a.avg_price_final", 6).alias("avg_price_final"),
                    F.col("a.sample_games")[0]["app_id"].alias("first_sample")))


@query("k4_write_warehouse", """
    SELECT 'reviews' AS table_name, count(*) AS n FROM reviews UNION ALL SELECT 'games', count(*) FROM games
    UNION ALL SELECT 'logs', count(*) FROM server_logs""")
def _(lake):
    root = warehouse(lake)
    counts = [files.read_table(lake.spark, root, n).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(n).alias("table_name"), "n") for n in ("reviews", "games", "logs")]
    return reduce(DataFrame.unionByName, counts)


@query("k5_kafka_records", """
    SELECT CAST(app_id AS VARCHAR) AS key, CAST(to_json({app_id: app_id, title: title, mac: mac,
           user_reviews: user_reviews, price_final: price_final}) AS VARCHAR) AS value FROM gappy_games""")
def _(lake):
    # a missing price is sent as NaN here, which the records must carry as null
    price = F.coalesce(F.col("price_final"), F.lit(float("nan"))).alias("price_final")
    return sink.to_kafka_records(lake.gappy_games.select("app_id", "title", "mac", "user_reviews", price), "app_id")


@query("k6_write_report", "SELECT level, count(*) AS entries FROM server_logs GROUP BY level")
def _(lake):
    path = sink.write_report(metrics.log_level_distribution(lake.server_logs), scratch_path(lake.spark, "report"))
    return lake.spark.read.schema("level STRING, entries BIGINT").json(path)


@query("r1_stream_topic", "SELECT review_id, rating, sentiment_indicator FROM streamed_reviews")
def _(lake):
    path = scratch_path(lake.spark, "one-topic")
    source = topics.read_record_files(lake.spark, f"{records(lake)}/game_reviews", "game_reviews")
    streams.stream_topic(source, "game_reviews", path, f"{path}-checkpoint", _event_time("game_reviews"),
                         ONCE).awaitTermination()
    return lake.spark.read.parquet(f"{path}/game_reviews").select("review_id", "rating", "sentiment_indicator")


@query("r2_start_all", """
    SELECT 'player_events' AS topic, count(*) AS n FROM player_events UNION ALL
    SELECT 'game_reviews', count(*) FROM streamed_reviews UNION ALL SELECT 'server_logs', count(*) FROM server_logs
    UNION ALL SELECT 'player_stats', count(*) FROM player_stats UNION ALL
    SELECT 'game_metrics', count(*) FROM game_metrics UNION ALL SELECT 'games_stream', count(*) FROM games""")
def _(lake):
    counts = [sunk(lake, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("topic"), "n") for t in TOPICS]
    return reduce(DataFrame.unionByName, counts)


@query("k1_flush_buffers", """
    WITH n AS (SELECT event_type AS topic, count(*) AS n FROM events GROUP BY event_type)
    SELECT topic, n AS records, n // 100 AS by_count, n % 100 AS waiting FROM n""")
def _(lake):
    """Events of one topic for each type, flushed by a hundred; what waits for its timer is the rest of each topic."""
    path = scratch_path(lake.spark, "flushed")
    stream = (lake.spark.readStream.schema(lake.table("events").schema).parquet(f"{lake.sf_dir}/events.parquet*")
              .select(F.col("event_type").alias("topic"), F.col("event_id").cast("string").alias("value"),
                      F.col("ts").cast("timestamp").alias("at")))
    century = 100 * 365 * 24 * 3600 * 1000
    with buffers.timers(lake.spark):
        (buffers.buffered(stream, max_wait_ms=century, time_column="at").writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", f"{path}-checkpoint").trigger(**ONCE).start().awaitTermination())
    flushed = lake.spark.read.schema(buffers.FLUSHED).parquet(path)
    done = (flushed.filter("reason = 'count'").groupBy("topic")
            .agg(F.count_distinct("flush").alias("by_count"), F.count_distinct("value").alias("out")))
    all_ = lake.table("events").groupBy(F.col("event_type").alias("topic")).agg(F.count(F.lit(1)).alias("records"))
    return all_.join(done, "topic", "left").select(
        "topic", "records", F.coalesce("by_count", F.lit(0)).cast("bigint").alias("by_count"),
        (F.col("records") - F.coalesce("out", F.lit(0))).alias("waiting"))


@query("r1_stream_with_rejects", """
    WITH g AS (SELECT app_id, app_id % 5 AS m FROM games)
    SELECT outcome, count(*) AS records, CAST(sum(app_id) AS BIGINT) AS ids FROM (
        SELECT app_id, CASE WHEN m = 0 THEN 'undecodable' WHEN m = 1 THEN 'missing_fields' ELSE 'accepted' END AS outcome FROM g)
    GROUP BY outcome""")
def _(lake):
    """Streamed games, a fifth of them cut off in the middle and a fifth without a title."""
    root = scratch_path(lake.spark, "intake")
    m = F.col("app_id") % 5
    body = F.to_json(F.struct("app_id", F.when(m != 1, F.col("title")).alias("title"), "price_final", "positive_ratio", "user_reviews"))
    (lake.games.select(F.col("app_id").cast("string").alias("key"), F.when(m == 0, F.substring(body, 1, 12)).otherwise(body).alias("value"))
     .write.parquet(f"{root}/records"))
    source = lake.spark.readStream.schema("key STRING, value STRING").parquet(f"{root}/records")
    intake.stream_with_rejects(source, "games_stream", root, f"{root}-checkpoint", trigger=ONCE).awaitTermination()
    kept = intake.committed(lake.spark, root, "accepted", "games_stream", "app_id INT")
    left = intake.committed(lake.spark, root, "rejected", "games_stream", intake.REJECTED)
    both = kept.select(F.lit("accepted").alias("outcome"), F.col("app_id").cast("bigint").alias("id")).unionByName(
        left.select(F.col("reason").alias("outcome"), F.col("record_key").cast("bigint").alias("id")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"), F.sum("id").alias("ids"))


@query("r3_stream_alerts", ALERTS + """
    UNION ALL SELECT 'games_stream', 'high_value', CAST(app_id AS VARCHAR),
           'High-value game streamed: ' || title || ' - $' || CAST(price_final AS VARCHAR)
    FROM games WHERE price_final > 50
    UNION ALL SELECT 'games_stream', 'popular', CAST(app_id AS VARCHAR),
           'Popular game streamed: ' || title || ' - ' || user_reviews || ' reviews'
    FROM games WHERE user_reviews > 10000""")
def _(lake):
    path, running = scratch_path(lake.spark, "alerts"), []
    for topic in TOPICS:
        source = topics.read_record_files(lake.spark, f"{records(lake)}/{topic}", topic)
        alerts = streams.stream_alerts(topic, source, _event_time(topic))
        if alerts is not None:
            running.append(alerts.writeStream.format("parquet").option("path", f"{path}/{topic}")
                           .option("checkpointLocation", f"{path}-checkpoint/{topic}").trigger(**ONCE).start())
    for q in running:
        q.awaitTermination()
    return lake.spark.read.schema("source STRING, type STRING, entity STRING, message STRING").parquet(
        *[f"{path}/{q}" for q in TOPICS if q != "player_stats"])


def _event_stream(lake: Lake) -> DataFrame:
    """The events table as a stream with an event time."""
    schema = lake.table("events").schema
    # the star makes it a pattern, which may name one file or a folder of files
    raw = lake.spark.readStream.schema(schema).parquet(f"{lake.sf_dir}/events.parquet*")
    return raw.select(F.col("ts").cast("timestamp").alias("event_time"),
                      F.concat(F.lit("player_"), F.col("user_id").cast("string")).alias("player_id"), "event_type")


def _closed_windows(lake: Lake, frame: DataFrame, label: str, columns: list[str]) -> DataFrame:
    path = scratch_path(lake.spark, label)
    flat = frame.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *columns)
    run = (flat.writeStream.outputMode("append").format("parquet").option("path", path)
           .option("checkpointLocation", f"{path}-checkpoint").trigger(**ONCE).start())
    run.awaitTermination()
    return lake.spark.read.schema(flat.schema).parquet(path)


# A window comes out once the watermark (newest event less ten minutes) has passed its end.
WATERMARK = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query("r4_active_players_stream", f"""
    WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS window_start, user_id
               FROM events, (SELECT unnest(range(12)) AS i))
    SELECT window_start, count(DISTINCT user_id) AS active_players, count(*) AS events FROM w
    GROUP BY window_start HAVING window_start + INTERVAL 1 HOUR <= {WATERMARK}""")
def _(lake):
    return _closed_windows(lake, streams.active_players_stream(_event_stream(lake)), "active",
                           ["active_players", F.col("events").cast("bigint").alias("events")])


@query("r4_active_players_sketch", f"""
    WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS window_start, user_id
               FROM events, (SELECT unnest(range(12)) AS i)),
    x AS (SELECT window_start, count(DISTINCT user_id) AS players, count(*) AS events FROM w
          GROUP BY window_start HAVING window_start + INTERVAL 1 HOUR <= {WATERMARK})
    SELECT window_start, players, events, true AS within_bound FROM x""")
def _(lake):
    """The sketch form of r4 next to the exact one: off by four standard errors at most."""
    estimated = _closed_windows(lake, streams.active_players_sketch_stream(_event_stream(lake)), "sketched",
                                ["active_players", F.col("events").cast("bigint").alias("events")])
    exact = _closed_windows(lake, streams.active_players_stream(_event_stream(lake)), "exact",
                            [F.col("active_players").alias("players")])
    apart = F.abs(F.col("active_players") - F.col("players")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 128 * F.col("players"))
    return estimated.join(exact, "window_start").select("window_start", "players", "events", apart.alias("within_bound"))


@query("r5_event_counts_stream", f"""
    WITH w AS (SELECT date_trunc('hour', ts) AS window_start, event_type FROM events)
    SELECT window_start, event_type, count(*) AS events FROM w GROUP BY window_start, event_type
    HAVING window_start + INTERVAL 1 HOUR <= {WATERMARK}""")
def _(lake):
    return _closed_windows(lake, streams.event_counts_stream(_event_stream(lake)), "hourly", ["event_type", "events"])


@query("r6_cluster_stream")
def _(lake):
    """Games arriving as a stream, prepared and assigned with the saved model."""
    path = scratch_path(lake.spark, "assigned")
    source = written_once(lake, "prepared", lambda p: kmeans.preprocess_features(lake.games).write.parquet(p))
    stream = lake.spark.readStream.schema(lake.spark.read.parquet(source).schema).parquet(source)
    labelled = streams.cluster_stream(lake.spark, fitted(lake), stream).select("app_id", "cluster")
    labelled.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", f"{path}-checkpoint").trigger(**ONCE).start().awaitTermination()
    return lake.spark.read.schema(labelled.schema).parquet(path)


@query("r7_retrain_when_ready")
def _(lake):
    """The gate is open for the streamed games, so clusters are refitted and written."""
    base = scratch_path(lake.spark, "retrained")

    def retrain(games: DataFrame) -> None:
        ready = kmeans.preprocess_features(games)
        sink.write_clusters(kmeans.fit_clusters(ready).transform(ready), base, "20240130_230000")

    listed = files.batch_files(lake.spark, streamed(lake))
    games = sunk(lake, "games_stream").select(*[c for c in lake.games.columns])
    if not streams.retrain_when_ready(games, listed, AS_OF, retrain):
        raise ValueError("too few games to refit")
    return clusters.cluster_distribution(lake.spark.read.parquet(f"{base}/latest/games_clusters_latest.parquet"))


@query("r7_versioned_scoring", """
    SELECT CAST(1 + app_id % 2 AS BIGINT) AS model_version, count(*) AS games, CAST(sum(app_id) AS BIGINT) AS ids,
           (SELECT count(*) FROM games WHERE positive_ratio BETWEEN 0 AND 100 AND user_reviews IS NOT NULL
            AND price_final IS NOT NULL) AS fitted_on
    FROM games WHERE positive_ratio BETWEEN 0 AND 100 AND user_reviews IS NOT NULL AND price_final IS NOT NULL
    GROUP BY model_version""")
def _(lake):
    """Even games are scored before a refit, odd ones after it; each by the version that was current."""
    spark, base = lake.spark, scratch_path(lake.spark, "versioned")
    games = spark.read.parquet(written_once(lake, "games", lambda p: lake.games.write.parquet(p)))
    for k, odd in ((8, 0), (13, 1)):
        models.publish(games, f"{base}/models", k=k)
        games.filter(F.col("app_id") % 2 == odd).write.parquet(f"{base}/in/{odd}")
        stream = spark.readStream.schema(games.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        models.score_stream(stream, f"{base}/models", f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    rows = models.scored(spark, f"{base}/out").groupBy("model_version").agg(
        F.count(F.lit(1)).alias("games"), F.sum(F.col("app_id").cast("bigint")).alias("ids"))
    published = models.versions(spark, f"{base}/models").select(F.col("version").alias("model_version"), F.col("games").alias("fitted_on"))
    return rows.join(published, "model_version").select("model_version", "games", "ids", "fitted_on")


# ---- availability and freshness of files --------------------------------------------------

@query("a34_stream_availability", """
    SELECT t.data_type, n > 0 AS available FROM (
        SELECT 'player_events' AS data_type, count(*) AS n FROM events
        UNION ALL SELECT 'game_reviews', count(*) FROM conversations UNION ALL SELECT 'server_logs', count(*) FROM events
        UNION ALL SELECT 'player_stats', count(*) FROM events UNION ALL SELECT 'game_metrics', count(*) FROM events) t""")
def _(lake):
    listed = files.batch_files(lake.spark, streamed(lake))
    return metrics.stream_availability(listed).select("data_type", "available")


@query("a35_retrain_gate", "SELECT count(*) AS games, count(*) >= 80 AS sufficient_data FROM games")
def _(lake):
    listed = files.batch_files(lake.spark, streamed(lake))
    gate = metrics.retrain_gate(sunk(lake, "games_stream"), listed, AS_OF)
    return gate.select("games", "sufficient_data")


CLUSTER_FILES = f"""f AS (SELECT epoch_us({SQL_AS_OF}) - epoch_us(max(ts) FILTER (event_type = 'view')) AS c,
        epoch_us({SQL_AS_OF}) - epoch_us(max(ts) FILTER (event_type = 'click')) AS a FROM events)"""


@query("a36_cluster_freshness", f"""WITH {CLUSTER_FILES}
    SELECT round(c / 3600000000.0e0, 6) AS hours_old, c < 12 * 3600000000 AS is_fresh, c < 600000000 AS is_very_fresh,
           CASE WHEN c IS NULL OR a IS NULL THEN 'no_data' WHEN c < 12 * 3600000000 THEN 'healthy' ELSE 'stale' END
               AS clustering_status FROM f""")
def _(lake):
    """Over a listing drawn from the events: views write the cluster table, clicks its analysis."""
    name = (F.when(F.col("event_type") == "view", F.lit("games_clusters_latest.parquet"))
            .when(F.col("event_type") == "click", F.lit("cluster_analysis_latest.json")).otherwise(F.lit("other.parquet")))
    listed = lake.table("events").select(F.concat(F.lit("/lake/latest/"), name).alias("path"),
                                         F.col("ts").cast("timestamp").alias("modificationTime"))
    return metrics.cluster_freshness(listed, AS_OF).select(
        F.round("hours_old", 6).alias("hours_old"), "is_fresh", "is_very_fresh", "clustering_status")
