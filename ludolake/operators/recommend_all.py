"""Recommendations for every game of a table: an exact top-k search with bounds.

Comparing all games of a cluster with each other is quadratic. Here the games of a cluster lie in bins of price, ratio and
review band, of which only ranges and counts are known to all tasks. For a reference the ranges give the best and the
worst score that any game of a bin can have. The bins whose worst scores are best hold the first ``limit`` others between them,
so their bound is a score that the last recommended game reaches, and only bins whose best score reaches
it are visited. What lies in them is scored exactly, bin by bin, in groups of bounded size, for many references at once;
only scores that reach the reference's bound go on to its ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolake.operators.recommend import POPULARITY_CAP, RESULT_COLUMNS, WEIGHTS
from ludolake.session import scratch_path

STEPS = 12    # of price and of ratio; with review bands of powers of two, a cluster has 13 * 13 * 64 bins at most
MEMBERS = 4096   # games of a bin that are compared together
REFERENCES = 4096  # references of a bin that are compared together
SCORES = 1 << 17   # scores that are computed in one step


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _candidates(df: DataFrame, limit: int) -> DataFrame:
    """Games that can be recommended at all, with their bins.

    Games of one cluster with equal price and ratio differ for every reference only by reviews, so beyond the
    ``limit + 1`` most reviewed of them none can be. The rank is a window group limit, applied on the map side.
    """
    alike = Window.partitionBy("cluster", "price_final", "positive_ratio").orderBy(F.col("user_reviews").desc(), F.col("app_id"))
    step = F.least(F.greatest(F.floor(F.col("price_final") / F.greatest("max_price", F.lit(1.0)) * STEPS), F.lit(0)), F.lit(STEPS))
    ratio = F.least(F.greatest(F.floor(F.col("positive_ratio") / F.lit(100) * STEPS), F.lit(0)), F.lit(STEPS))
    band = F.floor(F.log2(F.col("user_reviews") + F.lit(1)))
    return (df.withColumn("place", F.row_number().over(alike)).filter(F.col("place") <= limit + 1).drop("place")
            .withColumn("bin", ((step * (STEPS + 1) + ratio) * 64 + band).cast("int")))


def _summaries(members: DataFrame) -> dict:
    """By cluster: arrays of bins, counts and the ranges of price, ratio and reviews."""
    rows = members.groupBy("cluster", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("price_final", "positive_ratio", "user_reviews")
                                        for f in (F.min, F.max)]).collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r["cluster"], []).append(tuple(float(v) for v in r[1:]))
    return {c: np.array(sorted(v)).T for c, v in out.items()}


def recommend_all(df: DataFrame, limit: int = 10, members_together: int = MEMBERS,
                  references_together: int = REFERENCES) -> DataFrame:
    """For every game its ``limit`` most similar others of its cluster, as ``recommend_many`` would give them.

    Columns: ref_app_id, place and ``RESULT_COLUMNS``. Equal scores go to the more reviewed game, then the smaller id.
    Games with a null or negative number of reviews, or without id, cluster, price or ratio, take no part. Ids are to be
    unique; an empty table gives no rows.
    """
    fields = ["app_id", "cluster", "price_final", "positive_ratio", "user_reviews"]
    games = df.select(*RESULT_COLUMNS[:-1]).dropna(subset=fields).filter("user_reviews >= 0")
    tops = games.groupBy("cluster").agg(F.max("price_final").cast("double").alias("max_price"))
    plain = games.select(F.col("app_id").cast("long").alias("app_id"), "cluster", F.col("price_final").cast("double").alias("price_final"),
                         F.col("positive_ratio").cast("double").alias("positive_ratio"),
                         F.col("user_reviews").cast("long").alias("user_reviews")).join(tops, "cluster")
    members = _kept(_candidates(plain, limit), "candidates")
    bins = _summaries(members)
    # rows that a reference can exclude as itself: one, or more where ids repeat
    copies = members.groupBy("app_id").count().agg(F.max("count")).first()[0] or 1
    wp, wr, wv = WEIGHTS
    cap = float(POPULARITY_CAP)
    chunks = {(c, int(b)): -(-int(n) // members_together) for c, s in bins.items() for b, n in zip(s[0], s[1])}

    def visits(batches):
        for batch in batches:
            cluster, taken, visited, parts, bounds = batch.column(1).to_pylist(), [], [], [], []
            price, ratio, reviews, top = (batch.column(i).to_numpy().astype(float) for i in (2, 3, 4, 5))
            groups: dict = {}
            for i, c in enumerate(cluster):
                groups.setdefault(c, []).append(i)
            for c, rows in groups.items():
                own, n, p0, p1, r0, r1, v0, v1 = bins[c]
                for first in range(0, len(rows), 256):
                    at = np.array(rows[first:first + 256])
                    p, r, v = price[at, None], ratio[at, None], reviews[at, None] + 1
                    scale = np.maximum(np.maximum(top[at, None], p), 1.0)
                    best = ((1 - np.maximum(np.maximum(p0 - p, p - p1), 0) / scale) * wp
                            + (1 - np.maximum(np.maximum(r0 - r, r - r1), 0) / 100) * wr + np.minimum((v1 + 1) / v, cap) * wv)
                    worst = ((1 - np.maximum(np.abs(p - p0), np.abs(p - p1)) / scale) * wp
                             + (1 - np.maximum(np.abs(r - r0), np.abs(r - r1)) / 100) * wr + np.minimum((v0 + 1) / v, cap) * wv)
                    order = np.argsort(-worst, axis=1)
                    held = np.cumsum(n[order], axis=1) >= limit + copies  # some of them may be the reference itself
                    bound = np.where(held.any(axis=1), np.take_along_axis(worst, order, 1)[np.arange(len(at)), held.argmax(axis=1)],
                                     -np.inf)
                    bound -= 1e-9
                    who, which = np.nonzero(best >= bound[:, None])
                    for i, b, least in zip(at[who].tolist(), own[which].astype(int).tolist(), bound[who].tolist()):
                        for part in range(chunks[c, b]):
                            taken.append(i)
                            visited.append(b)
                            parts.append(part)
                            bounds.append(least)
            rows = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(visited, pa.int32()), pa.array(parts, pa.int32()), pa.array(bounds, pa.float64())],
                names=[*batch.schema.names, "bin", "part", "bound"])

    def compare(references: pa.Table, own: pa.Table) -> pa.Table:
        out: list = [[], [], [], []]
        if len(references) and len(own):
            name, price, ratio, reviews = (own[c].to_numpy() for c in ("app_id", "price_final", "positive_ratio", "user_reviews"))
            better = np.lexsort((name, -reviews))  # of equal scores the first in this order wins
            name, price, ratio, reviews = name[better], price[better], ratio[better], reviews[better]
            ref, *known = (references[c].to_numpy() for c in (
                "app_id", "price_final", "positive_ratio", "user_reviews", "max_price", "bound"))
            step = max(1, SCORES // len(name))
            for first in range(0, len(ref), step):
                who = ref[first:first + step]
                p, r, v, top, bound = (values[first:first + step, None] for values in known)
                score = ((1 - np.abs(price - p) / np.maximum(np.maximum(top, p), 1.0)) * wp + (1 - np.abs(ratio - r) / 100) * wr
                         + np.minimum((reviews + 1) / (v + 1), cap) * wv)
                score[name == who[:, None]] = -np.inf
                reached = (score >= bound) & (score > -np.inf)
                if len(name) > limit and np.count_nonzero(reached) > 4 * limit * len(who):
                    reached &= score >= np.partition(score, len(name) - limit, axis=1)[:, -limit, None]
                row, at = np.nonzero(reached)
                found = score[row, at]
                order = np.lexsort((at, -found, row))
                row, at, found = row[order], at[order], found[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < limit
                row, at, found = row[kept], at[kept], found[kept]
                for column, values in zip(out, (who[row], name[at], reviews[at], found)):
                    column.append(values)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(np.concatenate(v) if v else [], k) for c, v, k in zip(
            ("ref_app_id", "app_id", "reviews", "similarity_score"), out, kinds)})

    kind = plain.schema["cluster"].dataType.simpleString()
    asked = _kept(plain.select("app_id", "cluster", "price_final", "positive_ratio", "user_reviews", "max_price").mapInArrow(
        visits, f"app_id long, cluster {kind}, price_final double, positive_ratio double, user_reviews long, max_price double, "
                "bin int, part int, bound double"), "visits")
    blocks = asked.groupBy("cluster", "bin", "part").agg(
        (F.floor(F.count(F.lit(1)) / references_together) + 1).cast("int").alias("blocks"))
    here = (asked.join(blocks, ["cluster", "bin", "part"])
            .withColumn("block", F.pmod(F.xxhash64("app_id"), F.col("blocks")).cast("int")))
    sizes = members.groupBy("cluster", "bin").agg(F.ceil(F.count(F.lit(1)) / members_together).cast("int").alias("chunks"))
    dealt = (members.join(sizes, ["cluster", "bin"])
             .withColumn("part", F.pmod(F.xxhash64("app_id", F.lit(3)), F.col("chunks")).cast("int"))
             .join(blocks, ["cluster", "bin", "part"])
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*[F.col(c).alias(f"m_{c}") for c in ("cluster", "bin", "part", "block")],
                     "app_id", "price_final", "positive_ratio", "user_reviews"))
    found = (here.select("cluster", "bin", "part", "block", "app_id", "price_final", "positive_ratio", "user_reviews", "max_price",
                         "bound")
             .groupBy("cluster", "bin", "part", "block")
             .cogroup(dealt.groupBy("m_cluster", "m_bin", "m_part", "m_block"))
             .applyInArrow(compare, "ref_app_id long, app_id long, reviews long, similarity_score double"))
    best = Window.partitionBy("ref_app_id").orderBy(F.col("similarity_score").desc(), F.col("reviews").desc(), F.col("app_id"))
    top = (found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= limit)
           .select("ref_app_id", "place", F.col("app_id").alias("found_id"), "similarity_score"))
    return (top.join(games, F.col("found_id") == F.col("app_id"))
            .select("ref_app_id", "place", *RESULT_COLUMNS[:-1], "similarity_score"))
