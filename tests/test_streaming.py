"""Streams give what the batch functions give on the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ludolake.operators import enrich
from ludolake.sinks import files as sink
from ludolake.sources import topics
from ludolake.streaming import topics as streams

START = dt.datetime(2024, 1, 1)


def metric_records(spark, path, n=50, first=0):
    rows = [(f"game_{i % 5}", i, i / 10, (START + dt.timedelta(minutes=i)).isoformat()) for i in range(first, first + n)]
    df = spark.createDataFrame(rows, "game_id STRING, concurrent_players INT, crash_rate_percent DOUBLE, timestamp STRING")
    sink.to_kafka_records(df, "game_id").write.mode("append").parquet(path)
    return df


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "streaming", "check"))
    at = F.try_to_timestamp("timestamp")
    for first in (0, 50):
        batch = metric_records(spark, source, first=first)
        stream = topics.read_record_files(spark, source, "game_metrics", max_files=1)
        streams.stream_topic(stream, "game_metrics", out, check, at, {"availableNow": True}).awaitTermination()
    done = spark.read.parquet(f"{out}/game_metrics")
    assert done.count() == 100 and done.select("concurrent_players").distinct().count() == 100
    want = enrich.enrich_game_metrics(batch).filter("health_status = 'poor'").count()
    assert done.filter("concurrent_players >= 50 and health_status = 'poor'").count() == want


def test_gate_runs_only_with_enough_games(spark):
    files = spark.createDataFrame([("f", 1, START)], "path STRING, length BIGINT, modificationTime TIMESTAMP")
    calls = []
    assert not streams.retrain_when_ready(spark.range(79), files, START, calls.append) and not calls
    assert streams.retrain_when_ready(spark.range(80), files, START, calls.append) and len(calls) == 1


def test_late_events_are_dropped_and_windows_exact(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(*events):
        spark.createDataFrame([(START + dt.timedelta(minutes=m), p) for m, p in events],
                              "event_time TIMESTAMP, player_id STRING").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("event_time TIMESTAMP, player_id STRING").parquet(source)
        counted = streams.active_players_stream(stream, slide="1 hour").select("window.start", "active_players")
        (counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c")
         .trigger(availableNow=True).start().awaitTermination())

    arrive((1, "a"), (2, "a"), (3, "b"), (200, "z"))
    arrive((4, "late"), (400, "z"))
    rows = {r.start: r.active_players for r in spark.read.parquet(out).collect()}
    assert rows == {START: 2, START + dt.timedelta(hours=3): 1}


def test_compaction_keeps_rows_in_few_files(spark, tmp_path):
    root, target = str(tmp_path / "streaming"), str(tmp_path / "compacted")
    for i in range(6):
        rows = spark.createDataFrame([(i * 10 + k, START + dt.timedelta(hours=k % 2)) for k in range(10)], "n INT, at TIMESTAMP")
        sink.write_batches(rows.repartition(5), "e", root, F.col("at"))
    for _ in range(2):
        sink.compact_batches(spark, root, "e", target, "2024-01-01", files=2)
    done = spark.read.parquet(f"{target}/e")
    assert sorted(r.n for r in done.collect()) == list(range(60))
    assert len(done.inputFiles()) <= 4 < len(spark.read.parquet(f"{root}/e").inputFiles())


def test_files_follow_hours_and_bytes(spark, tmp_path):
    rows = spark.range(0, 60000, 1, 6).select(F.col("id").alias("n"), F.xxhash64("id").alias("x"), (F.lit(START).cast("timestamp") + F.make_dt_interval(
        hours=F.when(F.col("id") < 600, F.col("id") % 12).otherwise(F.lit(20)).cast("int"))).alias("at"))
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sink.write_batches(rows, "e", str(tmp_path), F.col("at"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    done = spark.read.parquet(f"{tmp_path}/e")
    found = (done.withColumn("file", F.col("_metadata.file_name")).groupBy("ingest_hour")
             .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n")))
    files, n = zip(*[(r.files, r.n) for r in found.orderBy("ingest_hour").collect()])
    assert n == (*[50] * 12, 59400) and done.agg(F.count_distinct("n").alias("n")).first().n == 60000
    assert files[:12] == (1,) * 12 and files[12] > 4
