"""Accepted and rejected records of a stream, before and after a kill."""

from __future__ import annotations

import json

import pytest

from ludolake.streaming import intake

GOOD = {"app_id": 1, "title": "a", "price_final": 1.5, "positive_ratio": 50, "user_reviews": 9}


def records(spark, path, rows):
    spark.createDataFrame(rows, "key STRING, value STRING").coalesce(1).write.mode("append").parquet(path)


def run(spark, source, root, **options):
    stream = spark.readStream.schema("key STRING, value STRING").option("maxFilesPerTrigger", 1).parquet(source)
    query = intake.stream_with_rejects(stream, "games_stream", root, f"{root}-check", trigger={"availableNow": True}, **options)
    query.awaitTermination()


def outcome(spark, root):
    taken = intake.committed(spark, root, "accepted", "games_stream", "app_id INT, title STRING").collect()
    left = intake.committed(spark, root, "rejected", "games_stream", intake.REJECTED).collect()
    return sorted(r.app_id for r in taken), sorted((r.record_key, r.reason, tuple(r.missing_fields or ())) for r in left)


def test_every_record_is_accepted_or_rejected_with_its_reason(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    no_title = {k: v for k, v in GOOD.items() if k != "title"} | {"positive_ratio": None}
    records(spark, source, [("1", json.dumps(GOOD)), ("2", "no json"), ("3", None), ("4", json.dumps(no_title)), ("5", "{}"),
                            ("6", json.dumps(GOOD | {"price_final": "dear"})), (None, json.dumps(GOOD | {"app_id": 7}))])
    run(spark, source, root)
    taken, left = outcome(spark, root)
    assert taken == [1, 7]
    assert [(k, r) for k, r, _ in left] == [("2", "undecodable"), ("3", "undecodable"), ("4", "missing_fields"),
                                            ("5", "missing_fields"), ("6", "undecodable")]
    assert set(left[2][2]) == {"title", "positive_ratio"} and len(left[3][2]) == 5
    counts = {(r.topic, r.outcome): r.records for r in intake.reject_counts(spark, root, ["games_stream"]).collect()}
    assert counts == {("games_stream", "accepted"): 2, ("games_stream", "undecodable"): 3, ("games_stream", "missing_fields"): 2}


def test_a_kill_between_the_two_writes_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in range(3):
        records(spark, source, [(f"{batch}-{i}", json.dumps(GOOD | {"app_id": 10 * batch + i})) for i in range(4)]
                + [(f"{batch}-x", "broken")])
    folder, calls = intake._folder, []

    def killed(at, kind, topic, number):
        calls.append((kind, number))
        if (kind, number) == ("rejected", 1) and calls.count(("rejected", 1)) == 1:
            raise RuntimeError("killed")
        return folder(at, kind, topic, number)

    monkeypatch.setattr(intake, "_folder", killed)
    with pytest.raises(Exception, match="killed"):
        run(spark, source, root)
    taken, left = outcome(spark, root)
    assert len(taken) == 4 and len(left) == 1  # the accepted rows of the second batch are there, but not committed
    run(spark, source, root)
    taken, left = outcome(spark, root)
    assert taken == [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23]
    assert [k for k, _, _ in left] == ["0-x", "1-x", "2-x"]
    assert intake.commits(spark, root, "games_stream").count() == 3
