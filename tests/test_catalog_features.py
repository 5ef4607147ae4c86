"""Recommendations for all games, distinct-player sketches, and functions that count nothing after ``as_of``."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ludolake.operators import metrics, recommend
from ludolake.operators.recommend_all import recommend_all
from ludolake.streaming import topics as streams

START = dt.datetime(2024, 1, 1)


def games_of(spark, rows):
    """(app_id, cluster, price, ratio, reviews) rows as clustered games."""
    return spark.createDataFrame(
        [(a, f"t{a}", "r", ratio, reviews, price, cluster) for a, cluster, price, ratio, reviews in rows],
        "app_id INT, title STRING, rating STRING, positive_ratio INT, user_reviews INT, price_final DOUBLE, cluster INT")


def rows_of(df):
    return sorted((r.ref_app_id, r.place, r.app_id, r.title, round(r.similarity_score, 9)) for r in df.collect())


@pytest.mark.parametrize("together", [4096, 7])
def test_all_games_get_what_a_full_comparison_gives(spark, together):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), rng.choice([0.0, 4.99, 9.5, 60.0]), rng.choice([10, 50, 51, 100]),
             rng.choice([0, 0, 3, 3, 900, rng.randint(0, 10 ** 6)])) for i in range(500)]
    games = games_of(spark, rows)
    got = rows_of(recommend_all(games, 6, together, together))
    assert got == rows_of(recommend.recommend_many(games, games, 6)) and len(got) == 3000


def test_wide_clusters_and_odd_games(spark):
    rng = random.Random(5)
    rows = [(i, 0, rng.random() * 70, rng.randint(0, 100), int(10 ** (6 * rng.random()))) for i in range(800)]
    games = games_of(spark, rows + [(900, 7, 1.0, 1, 1), (901, 8, 1.0, 1, 1), (902, 8, 2.0, 1, 1)])
    odd = games_of(spark, [(903, None, 1.0, 1, 1), (904, 0, None, 1, 1), (905, 0, 1.0, None, 1), (906, 0, 1.0, 1, None),
                           (None, 0, 1.0, 1, 1), (907, 0, 1.0, 1, -5)])
    got = rows_of(recommend_all(games.unionByName(odd), 3))
    assert got == rows_of(recommend.recommend_many(games, games, 3))
    assert [r[:3] for r in got if r[0] > 899] == [(901, 1, 902), (902, 1, 901)]
    assert recommend_all(games.limit(0)).count() == 0


def test_bins_leave_most_of_a_wide_cluster_out(spark, monkeypatch):
    from ludolake.operators import recommend_all as module

    rng = random.Random(6)
    games = games_of(spark, [(i, 0, rng.random() * 70, rng.randint(0, 100), int(10 ** (6 * rng.random()))) for i in range(3000)])
    kept, keep = {}, module._kept
    monkeypatch.setattr(module, "_kept", lambda df, label: kept.setdefault(label, keep(df, label)))
    assert recommend_all(games, 5).count() == 15_000
    compared = kept["visits"].join(kept["candidates"].groupBy("cluster", "bin").count(), ["cluster", "bin"])
    assert compared.agg(F.sum("count")).first()[0] < 0.35 * 3000 * 3000


def player_rows(spark, minutes, players):
    return spark.createDataFrame([(START + dt.timedelta(minutes=m), f"p{(m * 7919 + k * 31) % players}")
                                  for m in minutes for k in range(40)], "event_time TIMESTAMP, player_id STRING")


def run_stream(spark, frame, path, columns):
    query = (frame.select("window.start", *columns).writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", path + "-c").trigger(availableNow=True).start())
    query.awaitTermination()
    state = sum(o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"])
    return {r["start"]: r["active_players"] for r in spark.read.parquet(path).collect()}, state


def test_sketches_are_close_and_their_state_does_not_grow_with_players(spark, tmp_path):
    states = []
    for players in (50, 20_000):
        rows = player_rows(spark, range(0, 300), players)
        source = str(tmp_path / f"in-{players}")
        rows.write.parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        close, state = run_stream(spark, streams.active_players_sketch_stream(stream, lg_k=12), f"{source}-s", ["active_players"])
        exact, held = run_stream(spark, streams.active_players_stream(stream), f"{source}-e", ["active_players"])
        assert close.keys() == exact.keys() and len(exact) > 20
        assert all(abs(close[w] - exact[w]) <= max(1, 4 * 1.04 / 64 * exact[w]) for w in exact)
        states.append((state, held))
    assert states[0][0] == states[1][0] < states[1][1] / 20


def test_stored_sketches_merge_to_any_number_of_hours(spark):
    rows = player_rows(spark, range(0, 240), 5000).withColumnRenamed("event_time", "processed_at")
    rows = rows.unionByName(spark.createDataFrame([(None, "x"), (START, None)], rows.schema))
    sketches = metrics.player_sketches(rows)
    assert sketches.count() == 48
    for hours in (1, 3):
        at = START + dt.timedelta(hours=3, minutes=59)
        got = metrics.active_players_from_sketches(sketches, at, hours).first()
        since = at - dt.timedelta(hours=hours)
        exact = rows.filter((F.col("processed_at") >= since + dt.timedelta(minutes=1))).agg(F.count_distinct("player_id")).first()[0]
        assert abs(got.active_players - exact) <= 4 * 1.04 / 128 * exact + 1
    assert tuple(metrics.active_players_from_sketches(sketches, START - dt.timedelta(days=9)).first()) == (0, 0)


def test_nothing_after_as_of_raises_an_alert(spark):
    at = START + dt.timedelta(days=1)
    rows = [(i, at - dt.timedelta(minutes=i), 10, 0.1, "good") for i in range(1, 30)]
    late = [(100 + i, at + dt.timedelta(days=30 + i), 10, 9.0, "poor") for i in range(40)]
    m = spark.createDataFrame(rows + late, "event_id INT, processed_at TIMESTAMP, concurrent_players INT, "
                                           "crash_rate_percent DOUBLE, health_status STRING")
    logs = spark.createDataFrame([], "timestamp TIMESTAMP, level STRING")
    assert metrics.server_alerts(logs, m, at).count() == 0
    assert metrics.server_alerts(logs, m, at + dt.timedelta(days=90)).count() == 2
    assert metrics.rolling_health(m, as_of=at).first().server_health_status == "good"
    assert metrics.rolling_health(m).first().server_health_status == "poor"
    assert metrics.server_performance(m, as_of=at).first().crash_rate == pytest.approx(0.1)


def test_copies_of_an_id_leave_room_for_others(spark):
    """Copies of a game fill the nearest bin, and none of them can be recommended for it."""
    rows = [(1, "a", "Mixed", 90, 50, 1.0, 0)] * 6 + [(i, f"g{i}", "Mixed", 10 + i, 50, 40.0 + i, 0) for i in range(2, 8)]
    games = spark.createDataFrame(rows, "app_id INT, title STRING, rating STRING, positive_ratio INT, user_reviews INT, "
                                        "price_final DOUBLE, cluster INT")
    found = recommend_all(games, 3).filter("ref_app_id = 1").select("app_id")
    assert found.count() > 0 and found.filter("app_id = 1").count() == 0
