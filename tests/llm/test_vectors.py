"""Whitening, nearest neighbours and hard negatives against plain numpy versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolake.llm import curves, gnat, whitening
from ludolake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def table_of(spark, rows, clash=True):
    """(vec_id, embedding, label) rows, with columns named like the operators' own."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("id", "v", "x", "name", "h1", "chunk", "leaf", "component", "rank", "query") if clash else ():
        df = df.withColumn(name, F.lit("other"))
    return df


ODD = [(None, [1.0, 2.0, 0.5], 1), (901, None, 1), (902, [], 2), (903, [1.0, None, 1.0], 1), (904, [1.0, NAN, 1.0], 1),
       (905, [INF, 1.0, 1.0], 1), (906, [0.0, -0.0, 0.0], 3), (907, [0.25, 0.5, 1.0], None)]


def random_rows(n, d=3, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in np.float32(rng.normal(size=d))], int(rng.integers(4))) for i in range(n)]
    return rows + [(n + i, rows[0][1], int(i % 4)) for i in range(copies)]


def loaded(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    return [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64), [r["label"] for r in rows]


# Operator 11


def plain_whitening(x):
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    return fit, values[::-1], axes[:, ::-1]


def test_whitening_matches_a_full_decomposition(spark):
    ids, values, _ = loaded(spark)
    x = np.floor(256 * values)
    fit, own, axes = plain_whitening(x)
    rows = QUERIES["op11_embedding_whitening"](spark, SMALL).collect()
    assert len(rows) == 4 * len(ids)
    sums = [int(s) for s in fit.sum(axis=0)]
    z = ((x - fit.mean(axis=0)) @ axes[:, :4]) / np.sqrt(own[:4])
    got = np.zeros((len(ids), 4))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(fit) and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(own[r["component"] - 1] / own.sum(), rel=1e-9)
        assert r["deviation"] == sum((len(fit) * int(v) - s) ** 2 for v, s in zip(x[r["vec_id"]], sums))
    sign = np.sign((got * z).sum(axis=0))
    assert np.abs(got * sign - z).max() < 1e-8


def test_few_dimensions_copies_and_odd_rows(spark):
    df = table_of(spark, random_rows(50, copies=30) + ODD)
    model = whitening.fit_whitening(df)
    x = np.floor(256 * np.array([r[1] for r in random_rows(50)] + [[1.0, 2.0, 0.5], [0.0] * 3, [0.25, 0.5, 1.0]]))
    fit, values, _ = plain_whitening(x)
    assert model.n == 53 and np.allclose(model.values, values) and model.identity_error < 1e-9
    rows = whitening.whiten(df, model).collect()
    assert len(rows) == 83 * 3 and {r["component"] for r in rows} == {1, 2, 3}
    assert sum(r["vec_id"] is None for r in rows) == 3


def test_flat_directions_single_vectors_and_empty_tables(spark):
    line = [(i, [float(i), 2.0 * i, 7.0], 0) for i in range(20)]
    model = whitening.fit_whitening(table_of(spark, line))
    assert len(model.values) == 1 and model.identity_error < 1e-9
    for rows in ([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [], [(1, None, 0)]):
        df = table_of(spark, rows)
        assert whitening.whiten(df, whitening.fit_whitening(df)).collect() == []
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit_whitening(table_of(spark, [(1, [1.0], 0), (2, [1.0, 2.0], 0)]))


def test_wide_entries_keep_exact_deviations(spark):
    rows = [(i, [float(3000 * i), float(-(2 ** 24) + i)], 0) for i in range(5)]
    df = table_of(spark, rows)
    x = [[int(np.floor(256 * v)) for v in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df, whitening.fit_whitening(df)).collect()}
    assert got == {i: sum((5 * v - s) ** 2 for v, s in zip(x[i], sums)) for i in range(5)}


def test_the_polynomial_damps_the_unwanted_spectrum():
    spectrum = np.linspace(10, 0, 40)
    start = np.ones((40, 1))
    end = filtered = whitening.filtered(start, spectrum[:, None] * start, lambda q: spectrum[:, None] * q, 8, 8.0, 10.0)
    below = np.abs(end[spectrum <= 8]).max()
    assert np.abs(filtered[0, 0]) > 100 * below


def test_the_iteration_finds_close_eigenvalues():
    rng = np.random.default_rng(2)
    axes, _ = np.linalg.qr(rng.normal(size=(120, 120)))
    values = np.r_[[5.0, 4.999, 4.0, 3.9], np.linspace(3.8, 1, 116)]
    a = (axes * values) @ axes.T
    asked = []

    def times(q):
        asked.append(1)
        return a @ q

    got, vectors, residual = whitening.subspace(times, 120, 4)
    assert np.allclose(got, values[:4], atol=1e-12) and residual < 1e-11 and len(asked) < 150
    assert np.abs(np.abs((vectors * axes[:, :4]).sum(axis=0)) - 1).max() < 1e-12


# Operator 12


def plain_nearest(ids, x, asked, k=20):
    out = set()
    for q in asked:
        scores = [(-float((x[ids.index(q)] * v).sum()), i) for i, v in zip(ids, x) if i != q]
        out |= {(q, rank + 1, i) for rank, (_, i) in enumerate(sorted(scores)[:k])}
    return out


def test_neighbouring_cells_follow_each_other_on_the_curve():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = curves.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_nearest_of_one_chunk_are_exact(spark):
    ids, x, _ = loaded(spark)
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in QUERIES["op12_nearest_neighbours"](spark, SMALL).collect()}
    assert got == plain_nearest(ids, x, [i for i in ids if i % 20 == 0])


def test_recall_over_many_chunks(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)
    asked = [i for i in ids if i % 20 == 0]
    got = {(r["query_id"], r["vec_id"]) for r in curves.search_nearest(df, F.col("vec_id") % 20 == 0, chunk=64).collect()}
    true = {(q, i) for q, _, i in plain_nearest(ids, x, asked)}
    assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)


def test_copies_ties_and_odd_rows_of_a_search(spark):
    rows = random_rows(200, copies=100, seed=3)
    rows += [(500 + i, [1.0, float(i % 2), 0.0], 0) for i in range(10)] + [(20, rows[20][1], 0)] + ODD
    got = {(r["query_id"], r["rank"], r["vec_id"])
           for r in curves.search_nearest(table_of(spark, rows), F.col("vec_id") % 20 == 0, chunk=4096).collect()}
    used = {r[0]: r[1] for r in rows if r[0] is not None and not 901 <= r[0] <= 906}
    x = np.array(list(used.values()), dtype=np.float64)
    assert got == plain_nearest(list(used), x, [i for i in used if i % 20 == 0])


def test_few_candidates_and_empty_searches(spark):
    two = table_of(spark, [(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [0.0, 0.0], 0)])
    assert [tuple(r) for r in curves.search_nearest(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    for rows in ([], [(0, None, 0)], [(1, [1.0], 0)]):
        assert curves.search_nearest(table_of(spark, rows), F.col("vec_id") == 0).collect() == []


# Operator 13


def plain_negatives(rows, asked, low=80):
    x = {i: np.floor(256 * np.array(v, dtype=np.float64)) for i, v, _ in rows}
    label = {i: c for i, _, c in rows}
    out = set()
    for a in asked:
        scores = sorted((-int(x[a] @ x[i]), i) for i in x if i != a)
        for s, p in [(s, i) for s, i in scores if label[i] == label[a]][:5]:
            near = [(t, i) for t, i in scores if label[i] != label[a] and low * -s <= 100 * -t <= 100 * -s][:5]
            out |= {(a, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("options", [{}, {"sample": 40, "chunk": 16, "block": 2}])
def test_hard_negatives_match_a_full_scan(spark, options):
    rows = random_rows(300, copies=80, seed=5)
    df = table_of(spark, rows + [r for r in ODD if r[0] != 906])
    got = gnat.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()
    assert len({tuple(r) for r in got}) == len(got)
    assert {tuple(r) for r in got} == plain_negatives(rows, [r[0] for r in rows if r[0] % 10 == 0])


def test_clustered_rows_are_left_out_but_results_stay(spark):
    rng = np.random.default_rng(7)
    centres = 4 * rng.normal(size=(12, 8))
    rows = [(i, [float(v) for v in np.float32(centres[i % 12] + 0.05 * rng.normal(size=8))], int(rng.integers(3)))
            for i in range(600)]
    whole = np.floor(256 * np.array([r[1] for r in rows], dtype=np.float64))
    tree = gnat.split_points(whole[::5])
    prepared = gnat._prepared(table_of(spark, rows), F.lit(False), "vec_id", "label", "embedding", 256)
    tree = gnat._ranges(gnat._dealt(prepared, tree), tree)
    top, below = tree.deal(whole)
    leaves = top * gnat.FAN + below
    visited = 0
    for a in range(0, 600, 20):
        scores = whole @ whole[a]
        low, high = np.array([0.9 * scores[a]]), np.array([float(scores[a])])
        alive = tree.leaves(whole[a], low, high)
        within = (scores >= low) & (scores <= high)
        assert set(leaves[within].tolist()) <= set(alive)
        visited += np.isin(leaves, alive).sum()
    assert visited < 0.7 * 30 * 600
    got = {tuple(r) for r in gnat.mine_hard_negatives(table_of(spark, rows), F.col("vec_id") % 20 == 0).collect()}
    assert got == plain_negatives(rows, range(0, 600, 20))


def test_mining_without_anchors_rows_or_negatives(spark):
    for rows in ([], [(0, None, 0)], [(1, [1.0, 0.0], 0)], [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0)],
                 [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-1.0, 0.0], 1)]):
        assert gnat.mine_hard_negatives(table_of(spark, rows), F.col("vec_id") == 0).collect() == []
