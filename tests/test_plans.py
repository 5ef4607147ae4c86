"""Plans that must hold at any size: what is pushed down, cut early, and never joined crosswise."""

from __future__ import annotations

import pytest

from ludolake.functions.predicates import last_hours
from ludolake.operators import metrics, recommend, search
from ludolake.operators.stats import profile_columns
from ludolake.plans import views
from ludolake.plans.catalog import QUERIES
from ludolake.plans.views import Lake

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, FOLDER)


def test_time_filter_reaches_the_scan(lake):
    plan = physical(last_hours(lake.table("events"), "ts", 24, "2024-01-30 23:00:00").select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-29T23:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_only_needed_columns_are_read(lake):
    plan = physical(metrics.playtime_distribution(lake.reviews))
    assert "text" not in plan.split("ReadSchema", 1)[1]


@pytest.mark.parametrize("build", [
    lambda lake: search.sample_per_cluster(lake.clustered, 5),
    lambda lake: recommend.recommend_many(lake.clustered, lake.clustered.limit(5), 5),
])
def test_ranks_are_cut_before_the_shuffle(lake, build):
    plan = physical(build(lake))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["a1_overview", "a13_server_alerts", "c13_recommend_by_id", "c14_recommend_by_title",
                                  "j1_attach_reference", "j2_recommend_many", "t2_paginate", "g9_catalog_report",
                                  "c8_calinski_harabasz", "u1_union_by_name", "a19_category_sentiment"])
def test_no_cross_products(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_games_are_not_broadcast(spark, monkeypatch):
    """Beyond a counted number, however small the file of parts is."""
    monkeypatch.setattr(views, "BROADCAST_ROWS", 10)
    plan = physical(Lake(spark, FOLDER).games)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_top_k_needs_no_full_sort(lake):
    plan = physical(metrics.top_games_by_activity(lake.player_events))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_counts_aggregate_before_the_shuffle(lake):
    plan = physical(metrics.log_level_distribution(lake.server_logs))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")


def test_reviews_travel_without_their_labels(spark, lake):
    """With broadcasts off, no text is shuffled for scores, and a count joins nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("n7_score_reviews", "a18_recent_review_count"):
            plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "hashpartitioning" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profiles_sort_no_rows(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (None, None, "y")], "n INT, s STRING, t STRING")
    profile = profile_columns(rows)
    assert "SortAggregate" not in physical(profile)
    found = [tuple(r) for r in profile.select("column_name", "unique_values", "null_count", "min_value", "max_value").collect()]
    assert found == [("n", 2, 1, "1", "2"), ("s", 1, 1, None, None), ("t", 2, 1, None, None)]
    assert dict(profile.dtypes)["min_value"] == "string"
