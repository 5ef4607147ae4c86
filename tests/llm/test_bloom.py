"""The anti-join that leaves kept rows where they are."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ludolake.llm import bloom


def test_only_dropped_keys_go_and_null_keys_stay(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 11 != 0, F.col("id")).alias("id"), F.lit("t").alias("text"))
    df = df.unionByName(df.limit(20))
    gone = spark.range(0, 5000, 3).toDF("key")
    left = [r["id"] for r in bloom.without(df, F.col("id"), gone).collect()]
    rows = [r["id"] for r in df.collect()]
    key = lambda x: (x is None, x)
    assert sorted(left, key=key) == sorted((r for r in rows if r is None or r % 3), key=key)
    assert bloom.without(df, F.col("id"), gone.limit(0)).count() == len(rows)
    assert bloom.without(df.limit(0), F.col("id"), gone).count() == 0


def test_the_filter_holds_all_keys_and_few_others(spark):
    bits = bloom.bit_map_of(spark.range(20_000).select(F.xxhash64("id")))
    own = np.array([r[0] for r in spark.range(40_000).select(F.xxhash64("id")).collect()]).view(np.uint64)
    passed = set(bloom.may_hold(own, bits).tolist())
    assert set(range(20_000)) <= passed and len(passed) < 20_200
