"""Many K-Means fits of one table in the same passes: each pass over the rows serves every fit that still moves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.session import ship_code

BLOCK = 1024      # rows whose distances are computed together
INIT_ROUNDS = 2   # of k-means||, each draws about 2 k candidates a fit
LOCAL_ROUNDS = 30

Groups = list[tuple[list[int], np.ndarray]]  # numbers of fits, their centers as fits x centers x features


def _groups(centers: dict[int, np.ndarray]) -> Groups:
    """Fits with as many centers together; a center that others lack lies infinitely far away."""
    by_size: dict[int, list[int]] = {}
    for fit, c in centers.items():
        by_size.setdefault(1 << (len(c) - 1).bit_length() if len(c) > 16 else len(c), []).append(fit)
    out = []
    for fits in by_size.values():
        most = max(len(centers[f]) for f in fits)
        stacked = np.full((len(fits), most, centers[fits[0]].shape[1]), np.inf)
        for i, f in enumerate(fits):
            stacked[i, :len(centers[f])] = centers[f]
        out.append((fits, stacked))
    return out


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance to the nearest center and its number, fits x rows; ties go to the first."""
    real = np.isfinite(c[:, :, 0])
    plain = np.where(real[:, :, None], c, 0.0)
    gaps = np.matmul(plain * -2.0, x.T)
    gaps += np.where(real, (plain * plain).sum(axis=2), np.inf)[:, :, None]
    best, label = gaps[:, 0].copy(), np.zeros((len(c), len(x)), np.int32)
    for j in range(1, c.shape[1]):
        label[gaps[:, j] < best] = j
        np.minimum(best, gaps[:, j], out=best)
    return np.maximum(best + (x * x).sum(axis=1), 0.0), label


def _blocks(batches: Iterator[pa.RecordBatch], axes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with their first ``axes`` columns as a matrix."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            block = batch.slice(first, BLOCK)
            yield block, np.column_stack([block.column(i).to_numpy(zero_copy_only=False) for i in range(axes)])


def _sums(df: DataFrame, axes: list[str], centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """By fit: sums and numbers of the rows of each center, and the cost; one pass, one row back for each center."""
    groups, d = _groups(centers), len(axes)

    def partial(batches):
        sums = [np.zeros((*c.shape[:2], d + 2)) for _, c in groups]
        for _, x in _blocks(batches, d):
            wide = np.column_stack([x, np.ones(len(x))])
            for (_, c), total in zip(groups, sums):
                best, label = _nearest(x, c)
                hit = label[:, None, :] == np.arange(c.shape[1])[:, None]
                total[:, :, :d + 1] += np.matmul(hit.astype(float), wide)
                total[:, 0, d + 1] += best.sum(axis=1)
        for (fits, c), total in zip(groups, sums):
            number = [[f] * c.shape[1] for f in fits]
            flat = total.reshape(-1, d + 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ravel(number), pa.int32()), pa.array(np.tile(np.arange(c.shape[1]), len(fits)), pa.int32()),
                 *[pa.array(flat[:, i]) for i in range(d + 2)]], names=names)

    names = ["fit", "center", *[f"s{i}" for i in range(d)], "n", "cost"]
    parts = df.select(*axes).mapInArrow(partial, ", ".join(f"{c} {'int' if i < 2 else 'double'}" for i, c in enumerate(names)))
    rows = parts.groupBy("fit", "center").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()
    out = {f: (np.zeros(c.shape), np.zeros(len(c)), 0.0) for f, c in centers.items()}
    for fit, center, *values in rows:
        total, n, cost = out[fit]
        if center < len(n):
            total[center], n[center] = values[:d], values[d]
        out[fit] = (total, n, cost + values[d + 1])
    return out


def _uniform(draws: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes, the same however the rows lie in partitions."""
    with np.errstate(over="ignore"):
        z = draws.astype(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _drawn(df: DataFrame, axes: list[str], centers: dict[int, np.ndarray], wanted: dict[int, float],
           salts: dict[int, int]) -> dict[int, list[list[float]]]:
    """Rows of each fit drawn by their share of its cost: about ``2 k`` of them, ``wanted`` is 2 k over the cost."""
    groups, d = _groups(centers), len(axes)

    def draw(batches):
        for block, x in _blocks(batches, d):
            hashes = block.column(d).to_numpy(zero_copy_only=False)
            for fits, c in groups:
                best, _ = _nearest(x, c)
                for i, f in enumerate(fits):
                    at = np.flatnonzero(_uniform(hashes, salts[f]) < best[i] * wanted[f])
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array([f] * len(at), pa.int32()), pa.array(x[at].tolist())],
                                                         names=["fit", "x"])

    found: dict[int, list[list[float]]] = {}
    for fit, x in sorted(df.select(*axes, "draw").mapInArrow(draw, "fit int, x array<double>").collect()):
        found.setdefault(fit, []).append(x)
    return found


def _chosen(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the weighted candidates by k-means++, moved by a few rounds among them."""
    if len(candidates) <= k:
        return candidates
    weights = np.maximum(weights, 1e-9)
    picked = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    gaps = ((candidates - candidates[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < k:
        share = gaps * weights
        if not share.sum() > 0:
            break
        picked.append(int(rng.choice(len(candidates), p=share / share.sum())))
        gaps = np.minimum(gaps, ((candidates - candidates[picked[-1]]) ** 2).sum(axis=1))
    centers, before = candidates[picked].copy(), None
    for _ in range(LOCAL_ROUNDS):
        label = ((candidates[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        if before is not None and (label == before).all():
            break
        before = label
        for j in range(len(centers)):
            if (label == j).any():
                centers[j] = np.average(candidates[label == j], axis=0, weights=weights[label == j])
    return centers


def _started(df: DataFrame, axes: list[str], fits: list[tuple[int, int]]) -> dict[int, np.ndarray]:
    """First centers of all fits by k-means||; a fit of fewer distinct rows than ``k`` has fewer centers."""
    seeds = sorted({seed for _, seed in fits})
    rows = df.orderBy("draw", *axes).limit(len(seeds)).select(*axes).collect()
    if not rows:
        raise ValueError("no rows to fit")
    first = {seed: np.array([rows[i % len(rows)]], dtype=float) for i, seed in enumerate(seeds)}
    candidates = {f: first[seed] for f, (_, seed) in enumerate(fits)}
    for turn in range(INIT_ROUNDS):
        costs = {f: cost for f, (_, _, cost) in _sums(df, axes, candidates).items()}
        wanted = {f: 2.0 * k / costs[f] if costs[f] > 0 else 0.0 for f, (k, _) in enumerate(fits)}
        drawn = _drawn(df, axes, candidates, wanted, {f: 1 + seed * INIT_ROUNDS + turn for f, (_, seed) in enumerate(fits)})
        candidates = {f: np.unique(np.vstack([c, *([drawn[f]] if f in drawn else [])]), axis=0) for f, c in candidates.items()}
    weights = _sums(df, axes, candidates)
    return {f: _chosen(candidates[f], weights[f][1], k, np.random.default_rng(seed)) for f, (k, seed) in enumerate(fits)}


def fit_many(df: DataFrame, axes: list[str], fits: list[tuple[int, int]], max_iter: int = 100,
             tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """(centers, cost) of a K-Means fit for each (k, seed) of ``fits``.

    ``df`` has the features as doubles without null or NaN in ``axes``, and a 64-bit hash of each row in ``draw``; it is read
    in every pass, so it should be stored. k-means|| first, then Lloyd's rounds until no center of a fit moves farther than
    ``tol``. Only sums for each fit and center come to the driver. Draws follow from the rows, not from their partitions.
    """
    ship_code(df.sparkSession)
    centers = _started(df, axes, fits)
    moving = dict(centers)
    for _ in range(max_iter):
        for f, (total, n, _) in _sums(df, axes, moving).items():
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1.0)[:, None], centers[f])
            if (((moved - centers[f]) ** 2).sum(axis=1) <= tol * tol).all():
                del moving[f]
            else:
                moving[f] = moved
            centers[f] = moved
        if not moving:
            break
    costs = _sums(df, axes, centers)
    return [(centers[f], costs[f][2]) for f in range(len(fits))]


def with_labels(df: DataFrame, axes: list[str], models: dict[str, np.ndarray]) -> DataFrame:
    """``axes`` first, then the other columns, then a column for each model with the number of the nearest center."""
    rest = [c for c in df.columns if c not in axes]
    d, models = len(axes), dict(models)
    ship_code(df.sparkSession)

    def label(batches):
        for block, x in _blocks(batches, d):
            found = [pa.array(_nearest(x, c[None])[1][0], pa.int32()) for c in models.values()]
            yield pa.RecordBatch.from_arrays([*block.columns, *found], names=[*block.schema.names, *models])

    kept = df.select(*axes, *rest)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + [f"`{m}` int" for m in models])
    return kept.mapInArrow(label, schema)
