"""Boundaries, empty frames, and operators against brute force."""

from __future__ import annotations

import datetime as dt
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ludolake.functions import features as ft
from ludolake.functions import predicates as pr
from ludolake.functions import text as tx
from ludolake.operators import clusters, enrich, governance, kmeans, metrics, quality, recommend, search, stats
from ludolake.operators import reviews as rv

AT = dt.datetime(2024, 1, 30, 23, 0)


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_price_bands(spark):
    values = [0.0, 0.01, 5.0, 5.01, 20.0, 20.01, 50.0, 50.01, None]
    assert column(spark, values, "DOUBLE", ft.price_category("x")) == [0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_review_bands_and_ratings(spark):
    assert column(spark, ["99", "100", "999", "1000", "10000", "n/a", None], "STRING",
                  ft.review_category("x")) == [0, 1, 1, 2, 3, 0, 0]
    assert column(spark, ["Overwhelmingly Negative", "Mostly Positive", "Positive", "?", None], "STRING",
                  ft.rating_score("x")) == [0, 7, 6, 4, 4]


def test_release_year_and_log(spark):
    assert column(spark, ["2020-01-31", "2020-02-31", "no", None], "STRING", ft.release_year("x")) == [
        2020, None, None, None]
    assert column(spark, [0, 9, None, -1], "INT", ft.user_reviews_log("x")) == [0.0, 1.0, 0.0, 0.0]


def test_bands_and_minutes(spark):
    assert column(spark, [70.0, 69.9, 50.0, 49.9], "DOUBLE", ft.band_score(F.col("x"))) == [
        "good", "fair", "fair", "poor"]
    ages = column(spark, [AT - dt.timedelta(seconds=s) for s in (59, 60, 3601)], "TIMESTAMP",
                  pr.minutes_since(F.col("x"), "2024-01-30 23:00:00"))
    assert ages == [0, 1, 60]


def test_last_hours_on_every_time_type(spark):
    df = spark.createDataFrame([("2024-01-30T21:59:59",), ("2024-01-30T22:00:00",), (None,)], "s STRING")
    for kind in ("string", "timestamp", "timestamp_ntz"):
        typed = df.select(F.col("s").cast(kind).alias("t"))
        assert pr.last_hours(typed, "t", 1, AT).count() == 1, kind


def test_enrichment_boundaries(spark):
    logs = spark.createDataFrame([(v, "2024-01-01T00:00:00") for v in (None, 0.0, 1000.0, 1000.1, 5000.0, 5000.1)],
                                 "response_time_ms DOUBLE, timestamp STRING")
    assert [r.performance_category for r in enrich.enrich_server_logs(logs).collect()] == [
        None, None, "fast", "medium", "medium", "slow"]
    owners = spark.createDataFrame([(v,) for v in (None, 100.0, 100.5, 1000.0, 1000.5)], "total_playtime_hours DOUBLE")
    assert [r.player_category for r in enrich.enrich_player_stats(owners).collect()] == [
        "casual", "casual", "regular", "regular", "hardcore"]
    crash = spark.createDataFrame([("g", v) for v in (None, 1.0, 1.1, 2.0, 2.1, 3.0, 3.1)],
                                  "game_id STRING, crash_rate_percent DOUBLE")
    health = enrich.enrich_game_metrics(crash)
    assert [r.health_status for r in health.collect()] == ["good", "good", "moderate", "moderate", "poor", "poor", "poor"]
    assert enrich.alerts_for("game_metrics", health).count() == 1


def test_sentiment_indicator_and_alert(spark):
    df = spark.createDataFrame([("g", "GREAT but awful", 50), ("g", "awful", 10), ("g", "awful", 11), ("g", None, 99)],
                               "game_id STRING, review_text STRING, helpful_votes INT")
    done = enrich.enrich_reviews(df)
    assert [r.sentiment_indicator for r in done.collect()] == ["positive", "negative", "negative", "neutral"]
    assert enrich.alerts_for("game_reviews", done).count() == 1


def test_required_fields(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 50, 10), (2, None, 1.0, 50, None)],
                               "app_id INT, title STRING, price_final DOUBLE, positive_ratio INT, user_reviews INT")
    accepted, rejected = pr.split_required(df)
    assert accepted.count() == 1 and rejected.first().missing_fields == ["title", "user_reviews"]


# ---- review scoring: values worked out by hand from the weights ----------------------------

# Without other scorers pos, neg, neu start at 0.1, 0.1, 0.3; context 2 moves pos by 0.3 and neg by 0.15.
UNKNOWN = ("neutral", 0.5, 0.33, 0.33, 0.34)
POSITIVE = ("positive", 4 / 7, 4 / 7, 0.0, 3 / 7)
NEGATIVE = ("negative", 4 / 7, 0.0, 4 / 7, 3 / 7)

# Text and (label, confidence, positive, negative, neutral).
SCORED = [
    ("Amazing game!!! Love it, 10/10. See http://x.y/z", POSITIVE),            # context 4, cut to 2
    ("buggy mess, refund", NEGATIVE),                                          # -6.5, cut to -2
    ("", UNKNOWN), (None, UNKNOWN), ("   ", UNKNOWN), ("9/10", UNKNOWN),
    ("A button  press....... ok??", ("negative", 11 / 28, 1 / 14, 11 / 28, 15 / 28)),           # -0.8
    ("Good but boring, however polished", ("neutral", 120 / 203, 37 / 203, 46 / 203, 120 / 203)),  # -0.1
    ("ÉPIC www.site.org fun\x1fgame", POSITIVE),                               # 2
    ("waste waste regret", NEGATIVE),                                          # -7.5, cut to -2
    ("it is a game", ("neutral", 0.6, 0.2, 0.2, 0.6)),                         # 0
    ("perfect\n\n\tunfortunately broken", ("negative", 0.52, 0.0, 0.52, 0.48)),  # -1.5
]
SAMPLES = [text for text, _ in SCORED]

# Text, given (pos, neu, neg, compound, polarity), and the result.
GIVEN = {
    "it is a game": ((0.5, 0.3, 0.1, 0.2, 0.5), ("positive", 0.675 / 1.01, 0.675 / 1.01, 0.06 / 1.01, 0.275 / 1.01)),
    "so it is": ((0.0, 0.9, 0.0, -0.6, 0.0), ("negative", 0.8, 2 / 19, 0.6, 15 / 19)),
    "as it was": ((0.0, 0.1, 0.5, 0.7, -0.5), ("positive", 0.7, 0.6, 0.5, 0.5)),
}


def scored_rows(df):
    names = ("sentiment", "sentiment_confidence", "positive_score", "negative_score", "neutral_score")
    return [tuple(r[n] for n in names) for r in df.orderBy("i").collect()]


def close(row, want):
    return row[0] == want[0] and all(abs(a - b) < 1e-9 for a, b in zip(row[1:], want[1:]))


def test_score_reviews_by_rule(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i INT, text STRING")
    for (text, want), row in zip(SCORED, scored_rows(rv.score_reviews(df, "text"))):
        assert close(row, want), text


def test_score_reviews_with_scorer(spark):
    @F.pandas_udf("vader_pos DOUBLE, vader_neu DOUBLE, vader_neg DOUBLE, vader_compound DOUBLE, tb_polarity DOUBLE")
    def scorer(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([GIVEN[t][0] for t in texts],
                            columns=["vader_pos", "vader_neu", "vader_neg", "vader_compound", "tb_polarity"])

    df = spark.createDataFrame(list(enumerate(GIVEN)), "i INT, text STRING")
    for (text, (_, want)), row in zip(GIVEN.items(), scored_rows(rv.score_reviews(df, "text", scorer))):
        assert close(row, want), text


def test_filter_on_score_stays_small(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i INT, text STRING")
    kept = pr.high_confidence(rv.score_reviews(df, "text"), 0.5, "positive")
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert {r.i for r in kept.collect()} == {i for i, (_, e) in enumerate(SCORED) if e[0] == "positive" and e[1] > 0.5}


def test_empty_summaries(spark):
    votes = spark.createDataFrame([], "helpful_votes INT, total_votes INT")
    row = rv.basic_sentiment(votes).first()
    assert (row.sentiment_score, row.confidence, row.neutral_percentage, row.total_analyzed) == (50.0, 0.0, 33.34, 0)
    scored = spark.createDataFrame([], "sentiment STRING, sentiment_confidence DOUBLE")
    assert rv.sentiment_summary(scored).first().sentiment_score == 50.0


def test_category_sample(spark):
    rows = [(f"rev_00{1 + i % 9}{i:03d}", "amazing" if i % 2 else "awful waste") for i in range(90)]
    df = spark.createDataFrame(rows, "review_id STRING, text STRING")
    for limit in (None, 5, 1000):
        got = {r.category: (r.reviews, r.sentiment_score) for r in rv.category_sentiment(df, limit).collect()}
        for name, pattern in pr.REVIEW_CATEGORIES.items():
            hits = sorted(r for r in rows if re.search(pattern, r[0]))[:limit]
            good = sum(t == "amazing" for _, t in hits)
            score = 50 + (good - (len(hits) - good)) / len(hits) * 100 / 2
            assert got[name] == (len(hits), pytest.approx(round(score, 2), abs=0.01)), (limit, name)


def test_synthetic_text(spark):
    df = spark.createDataFrame([("r1", 10, 6, 10), ("r2", 10, 5, 10)],
                               "review_id STRING, playtime_hours INT, helpful_votes INT, total_votes INT")
    base, name = rv.with_review_text(df)
    texts = [r[name] for r in base.orderBy("review_id").collect()]
    assert texts[0].endswith("Highly recommended!") and texts[1].endswith("Could be better.")
    assert rv.advanced_sentiment(df).first().total_reviews == 2


# ---- metrics on empty and tiny frames -----------------------------------------------------

def test_metrics_on_empty_frames(spark):
    m = spark.createDataFrame([], "event_id BIGINT, game_id STRING, concurrent_players INT, "
                                  "crash_rate_percent DOUBLE, health_status STRING, processed_at TIMESTAMP")
    logs = spark.createDataFrame([], "level STRING, action STRING, timestamp TIMESTAMP")
    perf = metrics.server_performance(m).first()
    assert (perf.concurrent_players, perf.crash_rate, perf.health_status) == (0, 0.0, "unknown")
    assert metrics.rolling_health(m).first().server_health_status == "good"
    assert metrics.server_alerts(logs, m, AT).count() == 0
    reviews = spark.createDataFrame([], "review_id STRING, playtime_hours INT, helpful_votes INT, total_votes INT")
    assert metrics.helpful_ratio(reviews).first().avg_helpful_ratio == 0.0
    assert [r.reviews for r in metrics.playtime_distribution(reviews).collect()] == [0, 0, 0, 0]
    events = spark.createDataFrame([], "session_id STRING, event_type STRING")
    assert metrics.events_per_session(events).first().events_per_session == 0.0


def test_alerts_fire(spark):
    logs = spark.createDataFrame([("ERROR", AT)] * 11, "level STRING, timestamp TIMESTAMP")
    m = spark.createDataFrame([(1, 10, 2.5, "good", AT - dt.timedelta(hours=1)), (2, 20, 3.5, "poor", AT)],
                              "event_id BIGINT, concurrent_players INT, crash_rate_percent DOUBLE, "
                              "health_status STRING, processed_at TIMESTAMP")
    rows = {r.type: r.message for r in metrics.server_alerts(logs, m, AT).collect()}
    assert rows == {"error": "High error rate: 11 errors in last hour", "performance": "High crash rate: 3.0%",
                    "health": "Server health status is poor"}


def test_freshness_states(spark):
    def status(*files):
        df = spark.createDataFrame([(p, 10, t) for p, t in files], "path STRING, length BIGINT, modificationTime TIMESTAMP")
        return metrics.cluster_freshness(df, AT).first()

    clusters_file, analysis = "l/games_clusters_latest.parquet/x", "l/cluster_analysis_latest.json/x"
    assert status((clusters_file, AT)).clustering_status == "no_data"
    fresh = status((clusters_file, AT - dt.timedelta(minutes=9)), (analysis, AT))
    assert fresh.clustering_status == "healthy" and fresh.is_very_fresh
    old = status((clusters_file, AT - dt.timedelta(hours=12)), (analysis, AT))
    assert old.clustering_status == "stale" and old.hours_old == 12.0


# ---- statistics, search, recommendation ---------------------------------------------------

@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e9, 1e9), st.integers(0, 3).map(float)), min_size=1, max_size=60))
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    known = [v for v in values if v is not None]
    got = stats.exact_quantiles(df, ["x"], [0.25, 0.5, 0.9])["x"]
    if not known:
        assert got == [None] * 3
    else:
        assert got == pytest.approx(list(np.quantile(known, [0.25, 0.5, 0.9])), rel=1e-9, abs=1e-6)


def test_quantiles_of_a_long_tail(spark):
    random.seed(3)
    values = [random.lognormvariate(0, 6) for _ in range(20000)] + [0.0] * 10000
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "x DOUBLE, y INT")
    got = stats.exact_quantiles(df, ["x", "y"], [0.1, 0.5, 0.99])
    assert got["x"] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.99])), rel=1e-12)
    assert got["y"] == list(np.quantile([i % 7 for i in range(len(values))], [0.1, 0.5, 0.99]))


def games(spark, n=300, seed=1):
    random.seed(seed)
    rows = [(i, f"Game {i % 40} {i}", i % 3 if i % 2 else 0, random.choice([0.0, 4.99, 9.99, 59.99]),
             random.randint(50, 60), random.choice([0, 1, 5, 1000, random.randint(0, 10 ** 6)]), "Mixed")
            for i in range(1, n + 1)]
    return rows, spark.createDataFrame(rows, "app_id INT, title STRING, cluster INT, price_final DOUBLE, "
                                             "positive_ratio INT, user_reviews INT, rating STRING")


def brute(rows, ref, k, same=True):
    cand = [r for r in rows if r[0] != ref[0] and (not same or r[2] == ref[2])]
    top = max([r[3] for r in cand] + [ref[3], 1])
    scored = [(0.3 * (1 - abs(r[3] - ref[3]) / top) + 0.4 * (1 - abs(r[4] - ref[4]) / 100)
               + 0.3 * min((r[5] + 1) / (ref[5] + 1), 2), r) for r in cand]
    scored.sort(key=lambda s: (-round(s[0], 12), -s[1][5], s[1][0]))
    return [(r[0], round(s, 9)) for s, r in scored[:k]]


def test_recommend_by_id(spark):
    rows, df = games(spark)
    for app_id, same in ((17, True), (18, False)):
        got = recommend.recommend_by_id(df, app_id, 10, same).collect()
        want = brute(rows, rows[app_id - 1], 10, same)
        assert [round(r.similarity_score, 9) for r in got] == [s for _, s in want]
    assert recommend.recommend_by_id(df, 9999).count() == 0


def test_recommend_many(spark):
    rows, df = games(spark)
    references = df.filter("app_id % 10 = 0")
    got = {}
    for r in recommend.recommend_many(df, references, 7).orderBy("ref_app_id", "place").collect():
        got.setdefault(r.ref_app_id, []).append(round(r.similarity_score, 9))
    assert got == {r[0]: [s for _, s in brute(rows, r, 7)] for r in rows if r[0] % 10 == 0}


def test_search_and_suggest(spark):
    df = spark.createDataFrame([(1, "Red Fox", 5), (2, "red fox", 1), (3, "Red Fox II", 9), (4, "A red foxes", 99), (5, None, 1)],
                               "app_id INT, title STRING, user_reviews INT")
    assert [(r.app_id, r.relevance_score) for r in search.search_games(df, " RED fox ").collect()] == [
        (1, 100), (2, 100), (3, 50), (4, 10)]
    assert search.search_games(df, " ").count() == 0
    assert search.suggest_titles(df, "r").count() == 0 and search.suggest_titles(df, "re", 2).count() == 2


def test_equal_scores_are_ordered_alike(spark):
    """Price and ratio are equal and popularity is capped, so all scores tie: reviews decide, then the id."""
    rows = [(i, f"g{i}", "Mixed", 0, 10.0, 80, 1000 + 10 * (i % 4)) for i in range(2, 30)] + [(1, "g1", "Mixed", 0, 10.0, 80, 5)]
    df = spark.createDataFrame(rows, "app_id INT, title STRING, rating STRING, cluster INT, price_final DOUBLE, "
                                     "positive_ratio INT, user_reviews INT")
    want = sorted((r for r in rows if r[0] != 1), key=lambda r: (-r[6], r[0]))[:6]
    one = [r.app_id for r in recommend.recommend_by_id(df, 1, 6).collect()]
    many = [r.app_id for r in recommend.recommend_many(df, df.filter("app_id = 1"), 6).orderBy("place").collect()]
    titled = [r.app_id for r in recommend.recommend_by_title(df, "g1", 6).collect()]
    assert one == many == [r[0] for r in want] and len(titled) == 6


def test_two_references_are_an_error(spark):
    df = spark.createDataFrame([(i, "t", 0, 1.0, 5, 5) for i in (1, 2, 3)],
                               "app_id INT, title STRING, cluster INT, price_final DOUBLE, positive_ratio INT, user_reviews INT")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        recommend.attach_reference(df, df.filter("app_id < 3")).collect()


def test_pages_by_key(spark):
    """Pages after a key, for numbers beyond doubles, texts and null keys, make up the whole order."""
    big = 2 ** 60
    kinds = {"LONG": [big + i // 3 for i in range(40)], "STRING": [f"k{i // 3:02d}" for i in range(40)]}
    for kind, keys in kinds.items():
        rows = [(None, i) for i in range(7)] + [(k, 100 + i) for i, k in enumerate(keys)]
        df = spark.createDataFrame(rows, f"app_id {kind}, n INT")
        seen, after = [], None
        while page := search.paginate(df, 6, after=after, tie="n").collect():
            seen += [(r.app_id, r.n) for r in page]
            after = seen[-1]
            assert page[0].total == len(rows) and page[0].has_more == (len(seen) < len(rows))
        assert seen == rows
        for offset in (0, 5, 30, 47):
            assert [(r.app_id, r.n) for r in search.paginate(df, 6, offset, tie="n").collect()] == rows[offset:offset + 6]


def test_sample_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "app_id")
    a = {r.app_id for r in search.sample_rows(df, 50, "app_id").collect()}
    b = {r.app_id for r in search.sample_rows(df.repartition(7), 50, "app_id").collect()}
    assert a == b and len(a) == 50


# ---- clustering ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def blobs(spark):
    random.seed(5)
    rows = [(i, i % 3, (i % 3) * 10 + random.gauss(0, 1), (i % 3) * -5 + random.gauss(0, 1)) for i in range(300)]
    return rows, spark.createDataFrame(rows, "app_id INT, cluster INT, a DOUBLE, b DOUBLE")


def test_quality_by_hand(blobs):
    rows, df = blobs
    x = np.array([r[2:] for r in rows])
    label = np.array([r[1] for r in rows])
    means = np.array([x[label == j].mean(0) for j in range(3)])
    within = ((x - means[label]) ** 2).sum()
    between = sum((label == j).sum() * ((means[j] - x.mean(0)) ** 2).sum() for j in range(3))
    spread = [np.sqrt(((x[label == j] - means[j]) ** 2).sum(1)).mean() for j in range(3)]
    bouldin = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(means[i] - means[j]) for j in range(3) if j != i)
                       for i in range(3)])
    row = clusters.cluster_quality(df, ["a", "b"]).first()
    assert (row.k, row.n) == (3, 300)
    assert row.inertia == pytest.approx(within) and row.davies_bouldin == pytest.approx(bouldin)
    assert row.calinski_harabasz == pytest.approx((between / 2) / (within / 297))


def test_sweep_finds_the_blobs(blobs):
    _, df = blobs
    scores = kmeans.sweep_k(df, ["a", "b"], ks=range(2, 6), restarts=3)
    assert clusters.recommend_k(scores).first().recommended_k == 3
    drops = {r.k: r.drop_pct for r in clusters.elbow_table(scores).collect()}
    assert drops[2] is None and drops[3] > drops[4]
    sampled = kmeans.sweep_k(df, ["a", "b"], ks=[3], restarts=1, sample_size=60).first()
    assert sampled.inertia < scores.filter("k = 3").first().inertia


def test_final_fit_and_projection(blobs):
    _, df = blobs
    labelled, scores = kmeans.final_fit(df, ["a", "b"], 3, restarts=2)
    sizes = [r.n for r in clusters.cluster_distribution(labelled).collect()]
    assert sizes == [100, 100, 100] and scores["silhouette"] > 0.8
    points, explained, centers = kmeans.project_2d(labelled, [[0.0, 0.0], [1.0, 1.0]])
    assert sum(explained) == pytest.approx(1.0) and centers.count() == 2 and points.count() == 300


def test_fit_is_repeatable_and_assigns_new_games(spark):
    rows, df = games(spark)
    full = df.withColumns({"date_release": F.lit("2020-05-05"), "win": F.lit(True), "mac": F.col("app_id") % 2 == 0,
                           "linux": F.lit(False), "discount": F.lit(None).cast("double"), "steam_deck": F.lit(True)}).drop("cluster")
    ready = kmeans.preprocess_features(full)
    assert ready.filter("discount is null or release_year is null").count() == 0
    one = kmeans.fit_clusters(ready, k=4)
    two = kmeans.fit_clusters(ready, k=4)
    label = lambda m: [r.cluster for r in kmeans.assign_clusters(m, ready).orderBy("app_id").collect()]
    assert label(one) == label(two) and set(label(one)) <= set(range(4))


def test_rating_index_keeps_unseen_last(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "rating STRING")
    got = {r.rating: r.rating_encoded for r in kmeans.encode_rating(df).collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}


# ---- governance and quality ---------------------------------------------------------------

def test_masking(spark):
    df = spark.createDataFrame([("abcd", "jane.doe@mail.org"), ("abc", "a@b.c"), (None, None), ("secret name", "no at")],
                               "name STRING, email STRING")
    rows = governance.mask_pii(df, ["name", "email", "phone"]).collect()
    assert [tuple(r) for r in rows] == [("ab***cd", "ja***@mail.org"), ("abc", "a@b.c"), (None, None),
                                        ("se***me", "no at")]


def test_access_rules(spark):
    df = spark.createDataFrame([("admin_1", "sensitive_x", "delete"), ("analyst", "Sensitive", "write"),
                                ("analyst", "sensitive", "read"), ("analyst", "open", "delete"), ("viewer", "open", "read")],
                               "user_id STRING, dataset_name STRING, operation STRING")
    assert [r.allowed for r in governance.check_access(df).collect()] == [True, False, True, False, False]
    assert governance.check_access(df, "allow").collect()[-1].allowed is True


def test_onboarding_twice_keeps_one_current_row(spark, tmp_path):
    table, root = str(tmp_path / "games.parquet"), str(tmp_path / "catalog")
    spark.range(5).withColumn("player_name", F.lit("x")).coalesce(1).write.parquet(table)
    for day in ("2024-01-01", "2024-01-02"):
        governance.onboard_dataset(spark, root, "games", table, "parquet", day, sources=["raw"], description="d")
    datasets = governance.current_datasets(governance.read_catalog(spark, root, "datasets"))
    row = datasets.first()
    assert datasets.count() == 1 and (row.row_count, row.column_count) == (5, 2)
    assert row.created_date == dt.datetime(2024, 1, 1) and row.last_updated == dt.datetime(2024, 1, 2)
    part = next((tmp_path / "games.parquet").glob("part-*"))
    again = governance.file_fingerprint(spark, table, "parquet").first()
    assert row.checksum == again.checksum and row.size_bytes == part.stat().st_size
    flagged = governance.read_catalog(spark, root, "columns").filter("pii_flag").select("column_name").distinct()
    assert {r.column_name for r in flagged.collect()} == {"id", "player_name"}
    near = governance.lineage_of(governance.read_catalog(spark, root, "lineage"), "games").collect()
    assert {(r.direction, r.dataset) for r in near} == {("upstream", "raw")}


def test_file_checks(spark):
    df = spark.createDataFrame(
        [("w/reviews.parquet", 5000, AT), ("w/games.parquet/part-0", 100, AT - dt.timedelta(hours=25)),
         ("w/logs.parquet/part-1", 9000, AT - dt.timedelta(days=31))],
        "path STRING, length BIGINT, modificationTime TIMESTAMP")
    row = quality.quality_score(df, AT).first()
    assert (row.completeness, round(row.freshness, 2), round(row.size_consistency, 2)) == (60.0, 33.33, 66.67)
    assert row.grade == "critical" and row.issues[0] == "Missing files: catalog, configs" and len(row.issues) == 3
    assert quality.expired_files(df, 30, AT).count() == 1
    none = quality.quality_score(df.limit(0), AT).first()
    assert (none.completeness, none.freshness, none.size_consistency) == (0.0, 0.0, 100.0)


def test_security_config_file(spark, tmp_path):
    path = tmp_path / "security.json"
    path.write_text('{\n "encryption": {"enabled": false},\n "compliance": {"data_retention_days": 3000}\n}')
    row = governance.compliance_report(governance.read_security_config(spark, str(path))).first()
    assert row.status == "NON_COMPLIANT" and len(row.findings) == 2


def test_three_scorers(spark):
    df = spark.createDataFrame([(0.5, 0.2, 0.3, 0.6, 0.1, 0.3)],
                               "vader_pos DOUBLE, vader_neg DOUBLE, vader_neu DOUBLE, third_pos DOUBLE, "
                               "third_neg DOUBLE, third_neu DOUBLE")
    row = rv.ensemble(df).first()
    assert (row.pos, row.neg, row.neu) == (pytest.approx((0.6 + 0.2 + 0.6) / 3), pytest.approx((0.24 + 0.2 + 0.1) / 3),
                                           pytest.approx((0.3 + 0.6 + 0.3) / 3))


def test_first_reviews_only(spark):
    df = spark.createDataFrame([(f"r{i:03d}", "amazing" if i < 20 else "awful") for i in range(50)],
                               "review_id STRING, text STRING")
    row = rv.advanced_sentiment(df, sample_size=20).first()
    assert row.total_reviews == 20 and row.positive_percentage == 100.0
    assert rv.advanced_sentiment(df).first().total_reviews == 50


def test_checksums(spark, tmp_path):
    """A copy has the same checksum; other contents, names or places of files have others."""
    def folder(name, files):
        for path, text in files.items():
            (tmp_path / name / path).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / name / path).write_text(text)
        return governance.file_fingerprint(spark, str(tmp_path / name)).first()

    same = {"x=1/p.txt": "one\ntwo\n" * 50, "x=2/p.txt": "three\n"}
    first = folder("a/data", same)
    assert first.size_bytes == 406 and first.checksum == folder("b/data", same).checksum
    others = [{"x=1/p.txt": "three\n", "x=2/p.txt": "one\ntwo\n" * 50}, {"x=1/p.txt": "one\ntwo\n" * 50, "x=2/p.txt": "four\n"},
              {"x=1/p.txt": "one\ntwo\n" * 49, "x=2/p.txt": "three\n"}, {"x=1/p.txt": "same\n", "x=2/p.txt": "same\n"},
              {"x=1/p.txt": "like\n", "x=2/p.txt": "like\n"}, {"p.txt": "three\n"}]
    sums = {folder(f"c{i}/data", files).checksum for i, files in enumerate(others)}
    assert len(sums | {first.checksum}) == len(others) + 1
    rows = spark.range(100).selectExpr("id", "id % 7 AS v")
    for name, frame in (("one", rows), ("two", rows.filter("id < 99"))):
        frame.coalesce(1).write.parquet(str(tmp_path / name / "t.parquet"))
    one, two = (governance.file_fingerprint(spark, str(tmp_path / n / "t.parquet"), "parquet").first().checksum for n in ("one", "two"))
    assert one != two


def test_quantiles_with_nan_and_infinities(spark):
    nan, inf, big = float("nan"), float("inf"), 1.7e308
    df = spark.createDataFrame([(nan, inf, -big, 1.0), (1.0, -inf, big, 1.0), (3.0, 2.0, 0.0, 1.0), (None, 4.0, 1.0, 1.0), (2.0, 5.0, 5e-324, nan)],
                               "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    got = stats.exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.5, 1.0])
    assert got == {"a": [1.0, 2.0, 3.0], "b": [-inf, 4.0, inf], "c": [-big, 5e-324, big], "d": [1.0, 1.0, 1.0]}


def test_rows_after_the_moment_do_not_count(spark):
    rows = [("2024-01-01 22:30:00", "ERROR"), ("2024-01-01 23:30:00", "ERROR"), ("2024-01-02 00:30:00", "ERROR"), ("2024-02-01 00:00:00", "ERROR")]
    logs = spark.createDataFrame(rows, "timestamp STRING, level STRING")
    for df in (logs, logs.withColumn("timestamp", F.col("timestamp").cast("timestamp"))):
        assert metrics.recent_errors(df, "2024-01-02 00:00:00").first().recent_errors == 1


def test_audit_of_several_configurations(spark):
    config = spark.createDataFrame([((True, "a"), (2000,)), ((False, "b"), (9000,)), ((False, "c"), (9000,))],
                                   "encryption STRUCT<enabled: BOOLEAN, algorithm: STRING>, compliance STRUCT<data_retention_days: INT>")
    sets = spark.createDataFrame([("d", 1, "x", 10)], "name STRING, row_count INT, description STRING, size_bytes LONG")
    columns = spark.createDataFrame([("d", "c", False)], "dataset_id STRING, column_name STRING, pii_flag BOOLEAN")
    row = governance.governance_audit(sets, columns, config).first()
    assert row.compliance_status == "NON_COMPLIANT" and [tuple(f) for f in row.compliance_findings] == [
        ("Data retention period exceeds recommended 7 years", 2), ("Encryption not enabled", 2)]
    assert governance.governance_audit(sets, columns, config.filter("encryption.enabled")).first().compliance_status == "COMPLIANT"
