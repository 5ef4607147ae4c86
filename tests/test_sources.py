"""Readers and writers on small hand-made files."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ludolake import schemas
from ludolake.sinks import files as sink
from ludolake.sources import batches, files, topics


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_games_csv(spark, tmp_path):
    path = write(tmp_path, "games.csv", ",".join(schemas.names(schemas.GAMES)) + "\n"
                 '7,"Red, the game",2020-02-30,true,false,,Mixed,61,1200,4.99,9.99,50.0,true\n'
                 "8,Plain,2019-05-01,true,true,true,,,,,,,\n")
    rows = files.read_games_csv(spark, path).orderBy("app_id").collect()
    assert rows[0].title == "Red, the game" and rows[0].linux is None and rows[0].price_final == 4.99
    assert rows[1].rating is None and rows[1].positive_ratio is None and rows[1].mac is True


def test_review_blocks(spark, tmp_path):
    end = "-" * 80 + "\n\n"
    path = write(tmp_path, "reviews.txt",
                 "Review ID: rev_1\nDate: 2024-01-01T10:00:00\nPlaytime: 12 hours\nHelpful: 3/9\n"
                 "Review: Fun: but 10/10 buggy\n" + end
                 + "Review ID: rev_2\nPlaytime: none\nHelpful: many\nReview:   spaced  \n" + end
                 + "Review ID: rev_3\nDate: a\nDate: b\nHelpful: 1/2/3\n" + end + "\n\n")
    rows = files.read_review_records(spark, path).orderBy("review_id").collect()
    assert [r.review_id for r in rows] == ["rev_1", "rev_2", "rev_3"]
    assert (rows[0].playtime_hours, rows[0].helpful_votes, rows[0].total_votes) == (12, 3, 9)
    assert rows[0].text == "Fun: but 10/10 buggy"
    assert rows[1].playtime_hours is None and rows[1].helpful_votes is None and rows[1].text == "spaced"
    assert rows[2].timestamp == "b" and rows[2].total_votes is None and rows[2].text is None


def test_games_json_array(spark, tmp_path):
    game = {"game_info": {"basic": {"name": "A", "id": 5}, "details": {"genres": ["RPG", "Action"]}},
            "user_metrics": {"ratings": {"review_distribution": {"5_star": 3}}},
            "content_analysis": {"recommendation_reasons": [{"reason": "Fun gameplay", "frequency": 20}]}}
    path = write(tmp_path, "games.json", json.dumps([game, {"game_info": None}], indent=2))
    rows = files.read_games_json(spark, path).collect()
    assert len(rows) == 2 and rows[0].game_info.details.genres == ["RPG", "Action"]
    assert rows[0].user_metrics.ratings.review_distribution["5_star"] == 3
    assert rows[0].content_analysis.recommendation_reasons[0].frequency == 20


def test_config_yaml_files_and_documents(spark, tmp_path):
    one = "game_server:\n  name: s1\n  max_players: 32\ngame_settings:\n  map_rotation:\n  - map1\n  - map5\n"
    two = "game_server:\n  name: s2\n  port: 7777\nlogging:\n  chat_logs: true\n"
    write(tmp_path, "game_config_001.yaml", one)
    write(tmp_path, "game_config_002.yaml", two + "---\ngame_server:\n  name: s3\n")
    rows = files.read_config_yaml(spark, str(tmp_path / "game_config_*.yaml")).orderBy("game_server_name").collect()
    assert [r.game_server_name for r in rows] == ["s1", "s2", "s3"]
    assert rows[0].game_server_max_players == 32 and rows[0].game_settings_map_rotation == ["map1", "map5"]
    assert rows[1].logging_chat_logs is True and rows[1].game_server_max_players is None


def test_catalog_xml(spark, tmp_path):
    path = write(tmp_path, "game_catalog.xml", """<?xml version="1.0"?>
<game_catalog version="1.0"><game id="11"><basic_info><name>A</name><developer>D</developer>
<release_date>2020-01-02</release_date></basic_info><reviews_summary><total_count>5</total_count></reviews_summary>
<pricing><base_price currency="USD">9.99</base_price></pricing></game>
<game id="12"><basic_info><name>B</name></basic_info></game></game_catalog>""")
    a, b = files.read_catalog_xml(spark, path).orderBy("id").collect()
    assert (a.id, a.name, a.total_reviews, a.avg_rating, a.base_price, a.current_price) == (
        "11", "A", "5", None, "9.99", None)
    assert b.name == "B" and b.total_reviews is None and b.base_price is None


def test_server_logs(spark, tmp_path):
    path = write(tmp_path, "game_server_1.log",
                 "[2024-01-01 10:00:00] INFO: Player joined server - player_12\n"
                 "[2024-01-01 10:00:01] ERROR: Connection timeout - Player: player_7, Server: srv_01\n"
                 "[2024-01-01 10:00:02] WARNING: Map changed - nobody\nbroken line\n")
    rows = files.read_server_logs(spark, path).orderBy("timestamp").collect()
    assert [(r.level, r.action, r.player_id) for r in rows] == [
        ("INFO", "Player joined server", "player_12"), ("ERROR", "Connection timeout", "player_7"),
        ("WARNING", "Map changed", None)]


def test_flat_batches_by_name(spark, tmp_path):
    for stamp, value in (("20240130_220000", 1), ("20240130_230000", 2), ("bad", 3)):
        spark.createDataFrame([(value,)], "v INT").coalesce(1).write.parquet(
            str(tmp_path / f"batch_{stamp}.parquet"))
    spark.createDataFrame([(4,)], "v INT").write.parquet(str(tmp_path / "other.parquet"))
    recent = batches.read_flat_batches(spark, str(tmp_path), 1, "2024-01-30 23:30:00", "v INT")
    assert [r.v for r in recent.collect()] == [2]


def test_recent_batches_prune_partitions(spark, tmp_path):
    times = [dt.datetime(2024, 1, 30, 21, 59), dt.datetime(2024, 1, 30, 22, 0), dt.datetime(2024, 1, 31, 1, 0)]
    df = spark.createDataFrame(list(enumerate(times)), "v INT, at TIMESTAMP")
    sink.write_batches(df, "game_metrics", str(tmp_path), F.col("at"))
    recent = batches.read_recent_batches(spark, str(tmp_path), "game_metrics", 24, "2024-01-31 22:00:00")
    assert sorted(r.v for r in recent.collect()) == [1, 2]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_combined_view(spark):
    batch = spark.createDataFrame([(1, "a")], "id INT, b STRING")
    stream = spark.createDataFrame([(2, 0.5)], "id INT, s DOUBLE")
    both = batches.combined_view("reviews", batch, stream)
    assert both.columns == ["id", "b", "s"] and both.count() == 2
    assert batches.combined_view("player_stats", None, None) is None
    assert batches.combined_view("player_stats", batch, stream).columns == ["id", "s"]
    with pytest.raises(ValueError):
        batches.combined_view("weather", batch, stream)


def test_records_round_trip(spark):
    df = spark.createDataFrame([("p1", float("nan"), None), ("p2", 5.0, "2024-01-30T10:00:00")],
                               "player_id STRING, total_playtime_hours DOUBLE, timestamp STRING")
    records = sink.to_kafka_records(df, "player_id")
    assert json.loads(records.orderBy("key").first().value)["total_playtime_hours"] is None
    back = topics.decode_records(records, "player_stats").orderBy("record_key").collect()
    assert back[0].total_playtime_hours is None and back[1].total_playtime_hours == 5.0
    binary = records.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    assert topics.decode_records(binary, "player_stats").count() == 2


def test_cluster_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", "Mixed", 5, 0, 9.5)],
                               "app_id INT, title STRING, rating STRING, user_reviews INT, cluster INT, price_final DOUBLE")
    stamped, latest = sink.write_clusters(df, str(tmp_path), "20240101_000000")
    assert spark.read.parquet(latest).collect() == spark.read.parquet(stamped).collect()
    sink.write_clusters(df.withColumn("cluster", F.lit(3)), str(tmp_path), "20240102_000000")
    assert spark.read.parquet(latest).first().cluster == 3 and spark.read.parquet(stamped).first().cluster == 0
