"""Weak supervision: held-out accuracy on planted families, and what the label model finds."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ludolake.llm import toxicity as T


@pytest.fixture(scope="module")
def planted(spark, docs_of):
    """Toxic texts have words that begin with one of a few stems, each with an ending of its own."""
    rng = random.Random(2)
    word = lambda: rng.choice("bcdfg") + "".join(rng.choice("aeioulmn") for _ in range(rng.randint(2, 7)))
    texts, labels = [], []
    for d in range(1600):
        own, toxic = [word() for _ in range(rng.randint(20, 150))], d % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                own.insert(rng.randrange(len(own)), rng.choice(["zorg", "qwipp", "vlekt"]) + word())
        texts.append((d, " ".join(own)))
        if d % 3 != 1:
            labels.append((d, 1, int(toxic)))
    labels += [(None, 1, 1), (0, 1, None)]
    return docs_of(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(planted):
    docs, labels = planted
    rows = T.score_toxicity(docs, T.fit_toxicity(docs, labels)).collect()
    assert len(rows) == 1600 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = [r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held]
    assert sum(right) / len(right) > 0.98


def test_held_out_labels_are_not_used(planted, spark):
    docs, labels = planted
    turned = labels.withColumn("toxic", T.F.when(T.held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    one, other = (T.fit_toxicity(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.buckets, other.buckets)


def votes_of(seed: int = 0, spoiled: bool = False):
    """(truth, patterns, annotated): three voters, of which the second mostly repeats the first; a tenth is annotated."""
    rng = np.random.default_rng(seed)
    y = rng.random(40_000) < 0.2
    a = np.where(rng.random(len(y)) < np.where(y, 0.8, 0.05), 2, 1)
    b = np.where(rng.random(len(y)) < 0.9, a, np.where(y, 2, 1))
    c = np.where(rng.random(len(y)) < (0.3 if spoiled else np.where(y, 0.7, 0.1)), 2, 1)
    return y, np.stack([a, b, c], axis=1), np.where(rng.random(len(y)) < 0.1, np.where(y, 2, 1), 0)


def fitted(patterns, annotated):
    return T.fit_label_model(lambda f: f(patterns, annotated, np.ones(len(annotated))), (annotated > 0).sum(), len(annotated))


def test_label_model_finds_rates_and_correlations():
    y, patterns, annotated = votes_of()
    model = fitted(patterns, annotated)
    assert abs(model.share - 0.2) < 0.05 and abs(model.rate[1, 0, 2] - 0.8) < 0.1 and abs(model.rate[0, 2, 2] - 0.1) < 0.05
    assert model.link[0, 1] > 0.5 > model.link[0, 2]
    assert ((model.posterior(patterns) > 0.5) == y).mean() > 0.9


def test_posteriors_come_from_votes_alone():
    """Rows with equal votes have one posterior, whatever the annotators said of them."""
    _, patterns, annotated = votes_of()
    model = fitted(patterns, annotated)
    assert len({(tuple(p), q) for p, q in zip(patterns.tolist(), model.posterior(patterns).tolist())}) == len({*map(tuple, patterns.tolist())})


def test_a_spoiled_voter_changes_the_result():
    y, patterns, annotated = votes_of()
    _, worse, _ = votes_of(spoiled=True)
    good, bad = fitted(patterns, annotated), fitted(worse, annotated)
    evidence = lambda m: np.log(m.rate[1, 2] / m.rate[0, 2])[1:]  # noqa: E731  of the third voter's votes
    assert (abs(evidence(good)) > 1).all() and (abs(evidence(bad)) < 0.2).all()
    last = np.array([[1, 1, 2], [2, 2, 1]])
    assert (abs(good.posterior(last) - bad.posterior(last)) > 0.02).all()
    rows = [{"places": [0] * int(p[2] == 2), "n": 1, "hits": int(p[2] == 2)} for p in worse[:2000].tolist()]
    assert abs(T._train(rows, good.posterior(patterns[:2000]), 1) - T._train(rows, bad.posterior(worse[:2000]), 1)).max() > 0.05


def test_one_pass_or_many_parts():
    """The sums of a split table fit the same model as one part."""
    _, patterns, annotated = votes_of(3)
    parts = np.array_split(np.arange(len(annotated)), 7)
    split = T.fit_label_model(lambda f: sum(f(patterns[p], annotated[p], np.ones(len(p))) for p in parts),
                              (annotated > 0).sum(), len(annotated))
    whole = fitted(patterns, annotated)
    assert np.allclose(split.rate, whole.rate, atol=1e-6) and np.allclose(split.link, whole.link, atol=1e-6)


def test_votes_of_the_writing():
    votes = lambda t: dict(zip(T.PATTERNS, T._vote_list(len(t.split()), np.zeros(0, np.int64), np.frombuffer(t.encode(), np.uint8),
                                                        np.zeros(0, np.int64))[T.LEXICONS:]))
    assert len(T.VOTERS) >= 24 and votes("")["no_hit"] == 1
    assert votes("PLAIN SHOUTING OF A TEXT IN CAPITALS")["shouting"] == 2 and votes("Plain text of one capital")["shouting"] == 0
    assert votes("no! no! no!")["exclaiming"] == 2 and votes("such a f**k, d*mn")["masked"] == 2 and votes("3 * 4, a *b*")["masked"] == 0


def test_odd_rows(odd_docs, spark, planted):
    docs, labels = planted
    model = T.fit_toxicity(docs, labels)
    rows = T.score_toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] < 0.3 for r in rows)
    kept = T.remove_toxic(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert T.score_toxicity(odd_docs.limit(0), T.fit_toxicity(odd_docs.limit(0), labels.limit(0))).count() == 0
