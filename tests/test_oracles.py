"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, duck

from ludolake.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

# No rows at this size: too few events in the last hour, or ids without such a pattern.
MAY_BE_EMPTY = {"f8_high_confidence", "t4_suggest_titles", "c14_recommend_by_title", "t3_search_games",
                "c15_list_clustered", "t2_paginate", "j5_lineage_neighbours", "a6_activity_trends"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    problem = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    if problem == "both empty" and name in MAY_BE_EMPTY:
        return
    assert problem is None, problem


ROWS_ONLY = ["c2_cluster_fit", "c4_assign_clusters", "c12_project_2d", "r6_cluster_stream"]


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).collect()


def test_stream_assigns_like_batch(spark):
    streamed, batch = (sorted(map(tuple, QUERIES[n](spark, FOLDER).select("app_id", "cluster").collect()))
                       for n in ("r6_cluster_stream", "c2_cluster_fit"))
    assert streamed == batch and {c for _, c in batch} <= set(range(13))


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).collect()
    assert set(contract.oracle_sql()) <= set(contract.queries())
