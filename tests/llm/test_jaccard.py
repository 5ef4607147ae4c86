"""Shingle links against brute force."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from ludolake.llm import jaccard as J

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, size=4, percent=85):
    sets, out = [], {}
    for _, text in rows:
        w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size
                    else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            parent[root(i)] = root(j)
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.setdefault((doc, len(sets[i]), min(ids, default=None) if sets[i] else doc), 0)
        out[doc, len(sets[i]), min(ids, default=None) if sets[i] else doc] += 1
    return out


def linked(df, **options):
    out = {}
    for r in J.link_documents(df, **options).collect():
        out[tuple(r)] = out.get(tuple(r), 0) + 1
    return out


def variants(rng, base, number, most):
    out = []
    for _ in range(number):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def groups():
    """Groups of near copies around the limit, with passages that many texts share."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(rng.choice([8, 30, 90, 200]))]
        texts += variants(rng, base + (passage if g % 3 == 0 else []), rng.choice([2, 5, 40]), 4)
    texts += [" ".join(passage + [f"own{i}"]) for i in range(30)] + [" ".join(f"u{rng.random()}" for _ in range(50)) for _ in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_links_match_brute_force(docs_of, groups, percent):
    assert linked(docs_of(groups), percent=percent) == brute(groups, percent=percent)


def test_small_limits_give_the_same(docs_of, groups, monkeypatch):
    """Everything frequent, blocks and cells of a few rows: the paths that large inputs take."""
    for name, value in (("RARE", 1), ("BLOCK_NODES", 7), ("GROUP_BYTES", 2000), ("FLUSH", 500), ("PER_BUCKET", 100)):
        monkeypatch.setattr(J, name, value)
    monkeypatch.setattr(J, "FREQUENT_SHARE", 0.0)
    assert linked(docs_of(groups)) == brute(groups)


def test_whole_sample(sample):
    docs = sample("documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert linked(docs) == brute(rows)


def test_prefixes_of_similar_sets_share_a_combination():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(6, 400))
        a = np.unique(rng.integers(1, 1 << 60, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, len(a) // 8)))
        b = np.unique(np.r_[a[drop:], rng.integers(1, 1 << 60, int(rng.integers(0, max(1, len(a) // 10))), dtype=np.uint64)])
        both = np.intersect1d(a, b)
        if 100 * len(both) < 85 * (len(a) + len(b) - len(both)) or len(a) == len(both) == len(b):
            continue
        rank = {int(x): int(r) for x, r in zip(both, rng.choice([2, 3, 64, 65, 500, 9000], len(both)))}
        mine = [np.array([rank[int(x)] for x in both])] * 2
        keys = [J.prefix_combinations(len(s), both, m, 85) for s, m in zip((a, b), mine)]
        assert len(np.intersect1d(*keys)), (len(a), len(b), len(both))


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert linked(odd_docs) == brute(rows)
    assert linked(odd_docs.limit(0)) == {}
    kept = J.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert sum(t == "one" for t in texts) == 2  # one has a null id and takes no part
    assert sum(not (t or "").strip() for t in texts) == 6


def test_keep_first_takes_one_of_each_group(docs_of, groups):
    components = {c for _, n, c in brute(groups) if n}
    assert {r["doc_id"] for r in J.keep_first(docs_of(groups)).collect()} == components


def test_components_of_long_chains(spark):
    rng = random.Random(0)
    names = list(range(3000))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(2999) if i % 1000 != 999]
    got = {r["node"]: r["component"] for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for k in range(3):
        part = names[k * 1000:(k + 1) * 1000]
        assert {got[x] for x in part if x in got} == {min(part)}
