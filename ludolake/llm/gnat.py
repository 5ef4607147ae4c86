"""Operator 13: hard negatives by a multiway hyperplane tree with distance ranges (a GNAT).

The tree: each split point owns the rows that are nearer to it than to its siblings, and stores for each sibling
the range of its own distances to that sibling's rows, taken over all rows of the table. Split points are
chosen from a bounded sample (``sample`` rows by hash, far from each other); every row is dealt to a leaf. The
tree has at most ``fan ** 2`` leaves and is known to all tasks; rows stay in the leaves, in chunks of about
``chunk`` rows, so a leaf that holds a third of all rows is many chunks.

The search: scores are inner products, so a window of scores and the range of a subtree's norms give an annulus of
distances around the anchor. A subtree is left out if for any split point the ring of distances that
rows of the annulus can have doesn't meet the stored range. What is left is compared exactly, chunk by chunk:

1. the anchor's own leaf gives a first bound on the score of its last positive;
2. the leaves that can hold a score from that bound on give the positives;
3. those that can hold a score in one of the positives' windows give the negatives.

Scores are whole numbers and exact; results are those of a full scan. Vectors without structure leave few subtrees
out, so step 2 and 3 then compare the anchors with most rows, block by block.

Defined results: rows with a null key or label, or a vector that is null, empty or holds null, NaN or infinite
entries take no part; a zero vector does. Equal scores come by key. Rows that repeat a key count once by their best score, and
are never their own anchor's partner; a key that repeats with another label or vector is an anchor for each of them, with the same name, so
their lists meet in one. Anchors with fewer positives or negatives get all there are; without any, no row. An empty table, or
one without anchors, gives no rows. Only key, label, vector and the anchor condition are read, so other columns
may have any name. Vectors of different lengths and squared norms of 2^53 or more (after scaling) are errors.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolake.llm.common import stored
from ludolake.llm.vectors import floors, matrix, numeric, usable

FAN = 16             # split points of a node
SAMPLE = 4096        # rows from which split points are chosen
CHUNK = 8192         # rows of a leaf that are compared together
ANCHORS = 4096       # anchors that meet a chunk together
_SLACK = 1e-6        # of distances, so that rounding never drops a row


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


def _far_points(x: np.ndarray, many: int) -> np.ndarray:
    """Up to ``many`` different rows, each as far as possible from those before it."""
    chosen = [0]
    nearest = _distances(x, x[:1])[:, 0]
    while len(chosen) < many and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(x, x[chosen[-1]:chosen[-1] + 1])[:, 0])
    return x[chosen]


class Tree(NamedTuple):
    """Two levels: node 0 is the root, node 1 + i lies below its i-th split point."""

    points: list[np.ndarray]                          # split points of each node
    near: list[np.ndarray] = ()                       # by node: [split point, subtree], the least distance
    far: list[np.ndarray] = ()
    norms: list[np.ndarray] = ()                      # by node: [subtree, (least, most)] squared norm

    def leaf(self, node: int, branch: int) -> int:
        return (node - 1) * FAN + branch

    def deal(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Branches of rows at the root and below it: the nearest split point, the first of equal ones."""
        top = _distances(x, self.points[0]).argmin(axis=1)
        below = np.zeros(len(x), dtype=np.int64)
        for t in np.unique(top).tolist():
            own = top == t
            below[own] = _distances(x[own], self.points[1 + t]).argmin(axis=1)
        return top, below

    def _alive(self, node: int, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Subtrees of a node that can hold a score in one of the windows [low, high]."""
        square = float(anchor @ anchor)
        least = np.sqrt(np.maximum(square + self.norms[node][:, :1] - 2 * high[None], 0)) * (1 - _SLACK)
        most = np.sqrt(np.maximum(square + self.norms[node][:, 1:] - 2 * low[None], 0)) * (1 + _SLACK) + _SLACK
        to = _distances(anchor[None], self.points[node])[0][:, None, None]          # split point, subtree, window
        inner = np.maximum(to - most[None], least[None] - to) - _SLACK * (1 + to)
        meets = (inner <= self.far[node][:, :, None]) & (to + most[None] + _SLACK * (1 + to) >= self.near[node][:, :, None])
        # A window that begins above the product of the norms has no annulus.
        possible = low[None] <= np.sqrt(square * self.norms[node][:, 1:]) * (1 + _SLACK) + _SLACK
        return (meets.all(axis=0) & possible & (low <= high)[None]).any(axis=1)

    def leaves(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[int]:
        """Leaves that siblings' ranges can't exclude for the windows of scores."""
        return [self.leaf(1 + t, b) for t in np.flatnonzero(self._alive(0, anchor, low, high)).tolist()
                for b in np.flatnonzero(self._alive(1 + t, anchor, low, high)).tolist()]


def split_points(sample: np.ndarray, fan: int = FAN) -> Tree:
    top = _far_points(sample, fan)
    branch = _distances(sample, top).argmin(axis=1)
    return Tree([top, *[_far_points(sample[branch == t], fan) for t in range(len(top))]])


def _ranges(rows: DataFrame, tree: Tree) -> Tree:
    """The tree with the ranges of all rows; for each task (split point, subtree) pairs of its nodes travel."""
    shapes = [len(p) for p in tree.points]

    def read(batches):
        bounds = [(np.full((m, m), np.inf), np.full((m, m), -np.inf)) for m in shapes]
        norms = [np.tile([np.inf, -np.inf], (m, 1)) for m in shapes]

        def take(node, x, branch):
            d, square = _distances(x, tree.points[node]), (x * x).sum(axis=1)
            for b in np.unique(branch).tolist():
                own = branch == b
                near, far = bounds[node]
                near[:, b] = np.minimum(near[:, b], d[own].min(axis=0))
                far[:, b] = np.maximum(far[:, b], d[own].max(axis=0))
                norms[node][b] = [min(norms[node][b, 0], square[own].min()), max(norms[node][b, 1], square[own].max())]

        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                top, below = tree.deal(x)
                take(0, x, top)
                for t in np.unique(top).tolist():
                    take(1 + t, x[top == t], below[top == t])
        out = [(node, i, j, bounds[node][0][i, j], bounds[node][1][i, j], *norms[node][j].tolist())
               for node, m in enumerate(shapes) for j in range(m) if norms[node][j, 0] <= norms[node][j, 1] for i in range(m)]
        kinds = (*[pa.int32()] * 3, *[pa.float64()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], k) for c, k in enumerate(kinds)],
                                         names=["node", "i", "j", "near", "far", "low", "high"])

    found = (rows.select("x").mapInArrow(read, "node int, i int, j int, near double, far double, low double, high double")
             .groupBy("node", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far"),
                                            F.min("low").alias("low"), F.max("high").alias("high")).collect())
    near = [np.full((m, m), np.inf) for m in shapes]     # an empty subtree meets nothing
    far = [np.full((m, m), -np.inf) for m in shapes]
    norms = [np.zeros((m, 2)) for m in shapes]
    for r in found:
        near[r["node"]][r["i"], r["j"]], far[r["node"]][r["i"], r["j"]] = r["near"], r["far"]
        norms[r["node"]][r["j"]] = [r["low"], r["high"]]
    return Tree(tree.points, near, far, norms)


def _prepared(df: DataFrame, anchors: Column, key: str, label: str, vector: str, scale: float) -> DataFrame:
    """(id, label, anchor, x): usable rows with whole-number vectors."""
    def read(batches):
        for batch in batches:
            if batch.num_rows:
                x = floors(matrix(batch.column(3)), scale)
                if not (x * x).sum(axis=1).max() < 2.0 ** 53:
                    raise OverflowError("a squared norm is too large for exact scores")
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], flat], names=["id", "label", "anchor", "x"])

    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                     F.coalesce(anchors, F.lit(False)).alias("anchor"), numeric(df, vector).alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")))
    return rows.mapInArrow(read, "id long, label long, anchor boolean, x array<double>")


def _dealt(rows: DataFrame, tree: Tree) -> DataFrame:
    """The rows with their leaves."""
    def read(batches):
        for batch in batches:
            if batch.num_rows:
                top, below = tree.deal(matrix(batch.column(3)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((top * FAN + below).astype(np.int32))],
                                                 names=["id", "label", "anchor", "x", "leaf"])

    return rows.mapInArrow(read, "id long, label long, anchor boolean, x array<double>, leaf int")


_ASKED = "id long, label long, x array<double>, low array<long>, high array<long>"


class _Index:
    """Leaves in chunks, and searches in them."""

    def __init__(self, rows: DataFrame, tree: Tree, chunk: int, block: int):
        self.tree, self.chunk = tree, chunk
        sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("many"), F.count_if("anchor").alias("asked")).collect()
        self.chunks = {r["leaf"]: -(-r["many"] // chunk) for r in sizes}   # FAN ** 2 leaves at most
        self.blocks = max(1, -(-sum(r["asked"] for r in sizes) // block))
        counts = F.create_map(*[F.lit(v) for leaf, n in self.chunks.items() for v in (leaf, n)])
        self.rows = rows.select("leaf", F.pmod(F.xxhash64("id"), counts[F.col("leaf")]).cast("int").alias("chunk"),
                                "id", "label", "x")

    def visits(self, asked: DataFrame, own_leaf: bool) -> DataFrame:
        """``asked`` (id, label, x, low, high), a row for each chunk to be compared."""
        tree, chunks = self.tree, self.chunks

        def read(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, at, leaves, parts = matrix(batch.column(2)), [], [], []
                low, high = batch.column(3).to_pylist(), batch.column(4).to_pylist()
                top, below = tree.deal(x)
                for i, anchor in enumerate(x):
                    found = [int(top[i]) * FAN + int(below[i])] if own_leaf else tree.leaves(
                        anchor, np.array(low[i], dtype=float), np.array(high[i], dtype=float))
                    for leaf in found:
                        n = chunks.get(leaf, 0)
                        at += [i] * n
                        leaves += [leaf] * n
                        parts += range(n)
                taken = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves, pa.int32()), pa.array(parts, pa.int32())],
                                                 names=["id", "label", "x", "low", "high", "leaf", "chunk"])

        return (asked.mapInArrow(read, f"{_ASKED}, leaf int, chunk int")
                .withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(self.blocks)).cast("int")))

    def compare(self, asked: DataFrame, own_leaf: bool, best_of, schema: str) -> DataFrame:
        """``best_of(anchors, rows, scores)`` of every chunk and block of anchors that meet."""
        visits = stored(self.visits(asked, own_leaf), "visits")
        # A copy of a chunk for each block of anchors that visits it.
        met = visits.select(F.col("leaf").alias("at_leaf"), F.col("chunk").alias("at_chunk"),
                            F.col("block").alias("at_block")).distinct()
        rows = self.rows.join(met, (F.col("leaf") == F.col("at_leaf")) & (F.col("chunk") == F.col("at_chunk")))

        def meet(anchors: pa.Table, own: pa.Table) -> pa.Table:
            if not len(anchors) or not len(own):
                return best_of(None, None, None)
            return best_of(anchors, own, matrix(anchors["x"]) @ matrix(own["x"]).T)

        return (visits.groupBy("leaf", "chunk", "block")
                .cogroup(rows.select("at_leaf", "at_chunk", "at_block", "id", "label", "x").groupBy("at_leaf", "at_chunk", "at_block"))
                .applyInArrow(meet, schema))


def _positives(anchors: pa.Table, rows: pa.Table, scores: np.ndarray, k: int) -> pa.Table:
    out = []
    if anchors is not None:
        names, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        order = np.argsort(names, kind="stable")
        names, labels, scores = names[order], labels[order], scores[:, order]
        for name, label, own in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), scores):
            at = np.flatnonzero((labels == label) & (names != name))
            at = at[np.argsort(-own[at], kind="stable")]
            if len(at):
                _, first = np.unique(names[at], return_index=True)
                at = at[np.sort(first)][:k]
                out.append((name, label, names[at], own[at].astype(np.int64)))
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.table({c: pa.array([o[i] for o in out], kinds[i]) for i, c in enumerate(("anchor", "label", "ids", "scores"))})


def _negatives(anchors: pa.Table, rows: pa.Table, scores: np.ndarray, k: int) -> pa.Table:
    out = []
    if anchors is not None:
        names, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        order = np.argsort(names, kind="stable")
        names, labels, scores = names[order], labels[order], scores[:, order].astype(np.int64)
        for name, label, low, high, own in zip(*(anchors[c].to_pylist() for c in ("id", "label", "low", "high")), scores):
            at = np.flatnonzero((labels != label) & (names != name) & (own >= min(low)) & (own <= max(high)))
            at = at[np.argsort(-own[at], kind="stable")]
            _, first = np.unique(names[at], return_index=True)
            at = at[np.sort(first)]
            for a, b in sorted(set(zip(low, high))):
                within = at[(own[at] >= a) & (own[at] <= b)][:k]
                if len(within):
                    out.append((name, label, a, b, names[within], own[within]))
    kinds = (*[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = ("anchor", "label", "low", "high", "ids", "scores")
    return pa.table({c: pa.array([o[i] for o in out], kinds[i]) for i, c in enumerate(names)})


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, other, score, nth): the first ``k`` different ids of each list by score and id."""
    rows = (found.select(*by, F.inline(F.arrays_zip("ids", "scores"))).groupBy(*by, F.col("ids").alias("other"))
            .agg(F.max("scores").alias("score")))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "other"))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= k)


def mine_hard_negatives(df: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label",
                        vector: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                        scale: float = 256, sample: int = SAMPLE, chunk: int = CHUNK, block: int = ANCHORS) -> DataFrame:
    """For each anchor and each of its first positives the first rows of other labels whose score lies in
    ``low`` to ``high`` percent of the positive's: anchor_id, positive_id, rank, negative_id and both scores."""
    spark = df.sparkSession
    rows = _prepared(df, anchors, key, label, vector, scale)
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("x").collect()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not chosen:
        return spark.createDataFrame([], empty)
    tree = split_points(np.unique(np.array([r["x"] for r in chosen]), axis=0))
    rows = stored(_dealt(rows, tree), "leaves")
    tree = _ranges(rows, tree)
    index = _Index(rows, tree, chunk, block)
    none = F.array().cast("array<long>")
    asked = rows.filter("anchor").select("id", "label", "x").distinct()
    positive_schema = "anchor long, label long, ids array<long>, scores array<long>"

    first = index.compare(asked.select("*", none.alias("low"), none.alias("high")), True,
                          lambda a, r, s: _positives(a, r, s, positives), positive_schema)
    bound = (_best(first, ["anchor", "label"], positives).filter(F.col("nth") == positives)
             .select(F.col("anchor").alias("id"), "label", F.col("score").alias("bound")))
    # Nothing scores more than a norm allows, so the upper end may be any number beyond.
    wide = asked.join(bound, ["id", "label"], "left").select(
        "id", "label", "x", F.array(F.coalesce("bound", F.lit(-(1 << 53)))).alias("low"),
        F.array(F.lit(1 << 53)).alias("high"))
    partners = stored(_best(index.compare(wide, False, lambda a, r, s: _positives(a, r, s, positives), positive_schema),
                            ["anchor", "label"], positives), "positives")

    # low * score <= 100 * negative <= high * score, in whole numbers; a score below zero leaves no window.
    partners = partners.select("anchor", "label", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
                               F.ceil(F.col("score") * low / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
                               F.floor(F.col("score") * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"))
    windows = (partners.filter("low <= high").groupBy(F.col("anchor").alias("id"), "label")
               .agg(F.collect_list(F.struct("low", "high")).alias("w"))
               .select("id", "label", F.col("w.low").alias("low"), F.col("w.high").alias("high")))
    searched = asked.join(windows, ["id", "label"]).select("id", "label", "x", "low", "high")
    found = _best(index.compare(searched, False, lambda a, r, s: _negatives(a, r, s, negatives),
                                "anchor long, label long, low long, high long, ids array<long>, scores array<long>"),
                  ["anchor", "label", "low", "high"], negatives)
    return partners.join(found, ["anchor", "label", "low", "high"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("nth").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


#: The same by a full scan.
ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
