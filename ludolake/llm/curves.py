"""Operator 12: approximate nearest neighbours by shifted Hilbert orderings.

1. ``_vectors``: each distinct vector once, with a name; of its rows only the first ``k + 1`` ids can ever be in a
   result, so groups of copies neither fill windows nor travel.
2. ``_places``: each of ``orderings`` random rotations projects a vector to ``dims`` axes, shifts it and cuts it
   into ``2 ** bits`` steps an axis; the place on a Hilbert curve through those cells is its key. Spark
   range-partitions and sorts (ordering, key, hash); partitions number their rows, so each vector gets its rank
   in each ordering. ``chunk`` consecutive ranks are a chunk; equal keys spread over chunks, so none is larger.
3. ``_reach``: a bounded sample of queries is searched exactly, and the window, a number of chunks to either side,
   is the smallest with which the orderings together hold ``recall`` of those neighbours. Clustered data
   get by with neighbouring chunks; for vectors without structure windows cover more of the table, as they must.
4. Queries travel to the chunks of their windows, where exact scores give the best of each chunk; the lists of
   all windows and orderings merge by query.

Fitted on bounded samples: centre and spread of the projections (``fit_rows`` vectors) and the window
(``sample`` queries, each against all rows). Every vector is indexed and every query searched.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with a
null key. Copies of a vector get the same score and come by key; rows that repeat a key count once as candidates, with their
best score, and a query never meets its own key. A key that repeats with another vector is searched for each of them. Fewer candidates than ``k`` are all returned. An empty table or one without
queries gives no rows. Only key, vector and the query condition are read, so other columns may have any name.
Vectors of different lengths are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolake.llm.common import stored
from ludolake.llm.vectors import matrix, numeric, usable

ORDERINGS = 12
DIMS, BITS = 8, 7      # 56 bits of key
CHUNK = 1024           # ranks that are searched together
SPAN = 16              # chunks whose queries meet in one task's group
FIT_ROWS = 4096
SAMPLE = 256           # queries that choose the window
RECALL = 0.95          # of their neighbours that the windows must hold


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (row of whole numbers below ``2 ** bits``) on the Hilbert curve, as unsigned 64-bit keys.

    Works from the highest bit down: a set bit on an axis reflects the curve's first axis below it, a clear one swaps both; then
    the bits are read as a Gray code.
    """
    x = [np.ascontiguousarray(c) for c in cells.astype(np.uint64).T]
    zero = np.uint64(0)
    for level in range(bits - 1, 0, -1):
        at, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for axis in range(len(x)):
            is_set = (x[axis] & at) != zero
            swap = np.where(is_set, zero, (x[0] ^ x[axis]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            x[axis] = x[axis] ^ swap
    for axis in range(1, len(x)):
        x[axis] = x[axis] ^ x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] & np.uint64(1 << level)) != zero, turn ^ np.uint64((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << np.uint64(1)) | (((axis ^ turn) >> np.uint64(level)) & np.uint64(1))
    return key


def rotations(dimension: int, orderings: int, dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each ordering a random orthonormal projection and a shift of up to one spread to either side."""
    out, dims = [], min(dims, dimension)
    for ordering in range(orderings):
        random = np.random.default_rng([seed, ordering])
        axes, _ = np.linalg.qr(random.normal(size=(dimension, dims)))
        out.append((axes, random.uniform(-1, 1, size=dims)))
    return out


def best_of(queries: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the numbers and inner products of the ``k`` best rows and of all that tie with the last.

    The products of those are added up row by row, so equal vectors have equal scores in every task.
    """
    rough, k = queries @ rows.T, min(k, len(rows))
    least = np.partition(rough, len(rows) - k, axis=1)[:, len(rows) - k]
    least = least - 1e-9 * (np.abs(least) + np.abs(rough).max(axis=1))  # products of another order differ in the last bits
    out = []
    for q, own, bound in zip(queries, rough, least):
        at = np.flatnonzero(own >= bound)
        exact = (rows[at] * q).sum(axis=1)
        near = exact >= np.partition(exact, len(at) - k)[len(at) - k]
        out.append((at[near], exact[near]))
    return out


def _vectors(df: DataFrame, asked: Column, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(id, asked, h1, h2) of all usable rows, and (name, h1, h2, asked, v) of distinct vectors."""
    v = numeric(df, vector)
    rows = (df.select(F.col(f"`{key}`").alias("id"), v.alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
            .filter(F.col("id").isNotNull() & usable(F.col("v")) & F.exists("v", lambda c: c != 0))
            .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(17), "v")))
    distinct = (rows.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.max("asked").alias("asked"))
                .select(F.monotonically_increasing_id().alias("name"), "h1", "h2", "asked", "v"))
    return rows.select("id", "asked", "h1", "h2"), stored(distinct, "vectors")


def _places(vectors: DataFrame, turns, centre: list, spread: list, bits: int, chunk: int) -> tuple[DataFrame, dict]:
    """(ordering, name, chunk) of every vector, and the number of chunks of each ordering."""
    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(2))
            for ordering, (axes, shift) in enumerate(turns):
                # One step of the middle range is a few hundredths of the spread; the outermost hold the tails.
                cells = ((x @ axes - centre[ordering]) / spread[ordering] + shift) / 8 + 0.5
                cells = np.clip(np.floor(cells * (1 << bits)), 0, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), ordering, np.int32)), pa.array(hilbert(cells, bits).view(np.int64)),
                     batch.column(1), batch.column(0)], names=["ordering", "key", "tie", "name"])

    def number(batches):
        part, at = TaskContext.get().partitionId(), {}
        for batch in batches:
            ordering = batch.column(0).to_numpy()
            place = np.empty(len(ordering), np.int64)
            for o in np.unique(ordering).tolist():
                own = np.flatnonzero(ordering == o)
                place[own] = at.get(o, 0) + np.arange(len(own))
                at[o] = at.get(o, 0) + len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(np.full(len(place), part, np.int32)),
                                              pa.array(place)], names=["ordering", "name", "part", "place"])

    sorted_ = (vectors.select("name", "h2", "v").mapInArrow(keys, "ordering int, key long, tie long, name long")
               .repartitionByRange("ordering", "key", "tie").sortWithinPartitions("ordering", "key", "tie", "name"))
    placed = stored(sorted_.mapInArrow(number, "ordering int, name long, part int, place long"), "places")
    # A row for each partition and a few more, where an ordering ends.
    offsets, totals = [], {}
    for r in placed.groupBy("ordering", "part").agg(F.count(F.lit(1)).alias("many")).orderBy("ordering", "part").collect():
        offsets.append((r["ordering"], r["part"], totals.get(r["ordering"], 0)))
        totals[r["ordering"]] = offsets[-1][2] + r["many"]
    known = vectors.sparkSession.createDataFrame(offsets, "ordering int, part int, base long")
    ranked = placed.join(F.broadcast(known), ["ordering", "part"])
    return (ranked.select("ordering", "name", F.floor((F.col("base") + F.col("place")) / chunk).cast("int").alias("chunk")),
            {o: -(-n // chunk) for o, n in totals.items()})


def _reach(vectors: DataFrame, places: DataFrame, asked: list, k: int, recall: float) -> int:
    """Chunks to either side of a query's own that hold the share ``recall`` of the sample's true neighbours."""
    sample = np.array([r["v"] for r in asked], dtype=np.float64)

    def search(batches):
        found = [[] for _ in sample]
        for batch in batches:
            if batch.num_rows:
                names = batch.column(0).to_numpy()
                for q, (at, scores) in enumerate(best_of(sample, matrix(batch.column(1)), k + 1)):
                    found[q] = sorted([*found[q], *zip(scores.tolist(), names[at].tolist())], reverse=True)[:k + 1]
        rows = [(q, s, n) for q, own in enumerate(found) for s, n in own]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (
            pa.int32(), pa.float64(), pa.int64()))], names=["q", "score", "name"])

    nth = Window.partitionBy("q").orderBy(F.col("score").desc(), "name")
    best = (vectors.select("name", "v").mapInArrow(search, "q int, score double, name long")
            .withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k + 1).select("q", "name").collect())
    spark = vectors.sparkSession
    names = spark.createDataFrame(sorted({(r["name"],) for r in best} | {(r["name"],) for r in asked}), "name long")
    at: dict[int, dict[int, int]] = {}
    for r in places.join(F.broadcast(names), "name").collect():  # sample x (k + 1) x orderings at most
        at.setdefault(r["name"], {})[r["ordering"]] = r["chunk"]
    apart = []
    for r in best:
        own, other = at[asked[r["q"]]["name"]], at[r["name"]]
        if asked[r["q"]]["name"] != r["name"]:
            apart.append(min(abs(own[o] - other[o]) for o in own))
    apart.sort()
    return max(1, apart[int(np.ceil(recall * len(apart))) - 1]) if apart else 1


def search_nearest(df: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
                   orderings: int = ORDERINGS, dims: int = DIMS, bits: int = BITS, chunk: int = CHUNK, sample: int = SAMPLE,
                   fit_rows: int = FIT_ROWS, recall: float = RECALL, seed: int = 12) -> DataFrame:
    """For each row for which ``asked`` holds: query_id, rank, vec_id and score of its nearest by inner product."""
    spark, kind = df.sparkSession, df.schema[key].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()),
                           T.StructField("vec_id", kind), T.StructField("score", T.DoubleType())])
    rows, vectors = _vectors(df, asked, key, vector)
    fitted = vectors.orderBy("h1", "h2").limit(fit_rows).select("v").collect()
    tried = vectors.filter("asked").orderBy("h2", "h1").limit(sample).select("name", "v").collect()
    if not tried:
        return spark.createDataFrame([], schema)
    x = np.array([r["v"] for r in fitted], dtype=np.float64)
    turns = rotations(x.shape[1], orderings, dims, seed)
    seen = [x @ axes for axes, _ in turns]
    places, chunks = _places(vectors, turns, [s.mean(axis=0) for s in seen],
                             [np.maximum(s.std(axis=0), 1e-9 * (np.abs(x).max() or 1)) for s in seen], bits, chunk)
    reach = min(_reach(vectors, places, tried, k, recall), max(chunks.values()))
    last = F.create_map(*[F.lit(y) for o, n in chunks.items() for y in (o, n - 1)])[F.col("ordering")]
    groups = -(-(2 * reach + 1) // SPAN)

    here = places.join(vectors.select("name", "asked", "v"), "name")
    met = (here.filter("asked").withColumn("own", F.col("chunk"))
           .withColumn("chunk", F.explode(F.sequence(F.greatest(F.lit(0), F.col("own") - reach),
                                                     F.least(last, F.col("own") + reach))))
           .select("ordering", "chunk", F.floor((F.col("chunk") - F.col("own") + reach) / SPAN).cast("int").alias("part"),
                   "name", "v", F.lit(True).alias("query")))
    held = here.select("ordering", "chunk", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "name", "v",
                       F.lit(False).alias("query"))

    def compare(t: pa.Table) -> pa.Table:
        query = t["query"].to_numpy(zero_copy_only=False)
        name, x = t["name"].to_numpy(), matrix(t["v"])
        asked_here, rows_here = np.flatnonzero(query), np.flatnonzero(~query)
        out = []
        for first in range(0, len(asked_here) if len(rows_here) else 0, CHUNK):
            part = asked_here[first:first + CHUNK]
            for q, (at, scores) in zip(name[part].tolist(), best_of(x[part], x[rows_here], k + 1)):
                out.append((q, name[rows_here[at]], scores))
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        return pa.table({c: pa.array([o[i] for o in out], kinds[i]) for i, c in enumerate(("query", "names", "scores"))})

    found = stored(met.unionByName(held).groupBy("ordering", "chunk", "part")
                   .applyInArrow(compare, "query long, names array<long>, scores array<double>"), "found")
    pairs = (found.select("query", F.inline(F.arrays_zip("names", "scores")))
             .groupBy("query", F.col("names").alias("name")).agg(F.max("scores").alias("score")))
    # All that tie with the last stay until their ids decide.
    pairs = (pairs.withColumn("nth", F.rank().over(Window.partitionBy("query").orderBy(F.col("score").desc())))
             .filter(F.col("nth") <= k + 1).select("query", "name", "score"))
    first_ids = (rows.select("h1", "h2", "id").distinct()
                 .withColumn("nth", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id")))
                 .filter(F.col("nth") <= k + 1).join(vectors.select("h1", "h2", "name"), ["h1", "h2"]).select("name", "id"))
    by_id = (pairs.join(first_ids, "name").groupBy("query", "id").agg(F.max("score").alias("score"))
             .withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id")))
             .filter(F.col("nth") <= k + 1))
    lists = by_id.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    lists = lists.join(vectors.select(F.col("name").alias("query"), "h1", "h2"), "query").select("h1", "h2", "near")
    asked_rows = rows.filter("asked").select("id", "h1", "h2").distinct()
    joined = asked_rows.join(lists, ["h1", "h2"]).select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("near", lambda c: c["id"] != F.col("id")), 1, k).alias("near"))
    return joined.select("query_id", F.posexplode("near").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
