"""Masked scoring: gradients, normalisation, and that trained order scores above shuffled words."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ludolake.llm import lm


def network(seed=0):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.3, s).astype(np.float64) for k, s in lm._SHAPES.items()}


def test_probabilities_sum_to_one():
    net = network()
    around = np.array([[3], [70], [lm.EDGE], [9]], dtype=np.int32)
    total = np.exp(lm.log_probabilities(net, np.arange(lm.SIZE), np.repeat(around, lm.SIZE, axis=1))).sum()
    assert abs(total - 1) < 1e-6


def test_steps_follow_the_gradient():
    """The step's direction is that of numeric differences."""
    net, rng = network(), np.random.default_rng(1)
    t, around = rng.integers(0, lm.SIZE, 50), rng.integers(0, lm.SIZE + 1, (4, 50)).astype(np.int32)
    speed = {k: np.full(s, 1e12) for k, s in lm._SHAPES.items()}  # step = rate * gradient / 1e6
    moved = {k: v.copy() for k, v in net.items()}
    lm.train_batch(moved, speed, t, around, 1e6)
    for name in lm._SHAPES:
        step = net[name] - moved[name]
        for at in np.argsort(-np.abs(step).ravel())[:3]:
            lo, hi = ({k: v.copy() for k, v in net.items()} for _ in range(2))
            lo[name].ravel()[at] -= 1e-5
            hi[name].ravel()[at] += 1e-5
            slope = -(lm.log_probabilities(hi, t, around).mean() - lm.log_probabilities(lo, t, around).mean()) / 2e-5
            assert abs(slope - step.ravel()[at]) < 1e-3 * max(1, abs(slope)) + 1e-4, name


def test_contexts_stay_inside_a_text():
    ids, bounds = np.arange(7, dtype=np.int32), np.array([0, 3, 3, 4, 7])
    e = lm.EDGE
    assert lm._contexts(ids, bounds).tolist() == [[e, e, 0, e, e, e, 4], [e, 0, 1, e, e, 4, 5], [1, 2, e, e, 5, 6, e], [2, e, e, e, 6, e, e]]


@pytest.fixture(scope="module")
def scored(docs_of):
    rng = random.Random(4)
    sentence = lambda: " ".join(f"{rng.choice('abc')}{k}" for k in range(12))
    good = [" ".join(sentence() for _ in range(20)) for _ in range(300)]
    bad = [" ".join(rng.sample(g.split(), len(g.split()))) for g in good[:20]]
    return lm.score_documents(docs_of(good + bad)).collect()


def test_order_scores_above_shuffled_words(scored):
    mean = {r["doc_id"]: r["mean_log_likelihood"] for r in scored}
    assert len(mean) == 320 and np.mean([mean[i] for i in range(300)]) > np.mean([mean[i] for i in range(300, 320)]) + 0.5


def test_sums(scored):
    assert all(r["n_words"] == 240 and abs(r["log_likelihood"] / 240 - r["mean_log_likelihood"]) < 1e-9 for r in scored)


def test_odd_rows(odd_docs):
    rows = lm.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all((r["n_words"] == 0) == (r["mean_log_likelihood"] is None) and r["log_likelihood"] <= 0 for r in rows)
    assert lm.score_documents(odd_docs.limit(0)).count() == 0


def test_scores_are_log_probabilities_of_words(docs_of, monkeypatch):
    """With a plain network, the score of a text is the sum over all its words, rare ones with their shares."""
    from collections import Counter

    monkeypatch.setattr(lm, "train_network", lambda docs, net, *_: net | {"embed": net["embed"] * 0})
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(300)) for _ in range(100)] + ["once", "", None]
    counts = Counter(w for t in texts for w in (t or "").split())
    assert len(counts) > 1.5 * lm.SIZE
    hash_of = {w: next(lm.words(lm.pa.array([w]), fold=True)).hashes[0] for w in counts}
    frequent = sorted(counts, key=lambda w: (-counts[w], int(hash_of[w].view(np.int64))))[:lm.SIZE - lm.OTHERS]
    vocabulary = lm.Vocabulary(np.array([hash_of[w] for w in frequent], np.uint64))
    ids = dict(zip(counts, vocabulary(np.array([hash_of[w] for w in counts], np.uint64)).tolist()))
    words_of, kinds = Counter(), Counter()
    for w, i in ids.items():
        words_of[i], kinds[i] = words_of[i] + counts[w], kinds[i] + 1
    net = lm.start_network(np.array([counts[w] for w in frequent]), sum(counts.values()))
    around = np.full((len(lm.REACH), lm.SIZE), lm.EDGE, dtype=np.int32)
    by_id = lm.log_probabilities(net | {"embed": net["embed"] * 0}, np.arange(lm.SIZE), around)
    log = {w: by_id[i] + (np.log(counts[w] / (words_of[i] + kinds[i])) if i >= lm.SIZE - lm.OTHERS else 0) for w, i in ids.items()}
    unseen = sum(np.exp(by_id[i]) * (kinds[i] / (words_of[i] + kinds[i]) if kinds[i] else 1) for i in range(lm.SIZE - lm.OTHERS, lm.SIZE))
    assert abs(sum(np.exp(x) for x in log.values()) + unseen - 1) < 1e-4
    rows = {r["doc_id"]: r for r in lm.score_documents(docs_of(texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert abs(rows[i]["log_likelihood"] - sum(log[w] for w in (t or "").split())) < 1e-3, i


def test_shares_of_a_class():
    sums = np.zeros((2, lm.OTHERS), np.int64)
    sums[:, 3] = 10, 4
    at = lm.SIZE - lm.OTHERS + 3
    shares = np.exp(lm.log_shares(np.array([5, at, at, at, at, at, at + 1]), np.array([9, 5, 3, 1, 1, 0, 0]), sums))
    assert np.allclose(shares, [1, 5 / 14, 3 / 14, 1 / 14, 1 / 14, 4 / 14, 1]) and abs(shares[1:6].sum() - 1) < 1e-9
