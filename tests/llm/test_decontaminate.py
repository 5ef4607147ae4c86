"""Benchmark overlaps: planted copies with substitutions are found, clean texts are not."""

from __future__ import annotations

import random
import re

import pytest

from ludolake.llm import decontaminate as D


@pytest.fixture(scope="module")
def planted(spark, docs_of):
    rng = random.Random(5)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(15, 60)))) for i in range(40)]
    items += [(100, "six short words in this item"), (101, "five words of an item"), (102, "too short"), (103, None), (104, items[0][1])]
    texts, truth = [], set()
    for d in range(200):
        own = [word() for _ in range(rng.randint(0, 300))]
        if d % 4 == 0:
            i = rng.randrange(40)
            copy = items[i][1].split()
            every = rng.choice([0, 3, 4, 5, 7])
            copy = [f"sub{rng.randrange(10 ** 6)}" if every and k % every == every - 1 else w for k, w in enumerate(copy)]
            if every == 3 and len(copy) < 20:
                copy = items[i][1].split()
            at = rng.randint(0, len(own))
            own[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in copy]
            truth.add((d, i))
            if i == 0:
                truth.add((d, 104))
        texts.append((d, " ".join(own)))
    texts += [(300, "so: Six SHORT words, in this item!"), (301, "five words of an item"), (302, "five words of no item"), (303, "too short")]
    truth |= {(300, 100), (301, 101)}
    return docs_of(texts), spark.createDataFrame(items, "item_id long, text string"), truth


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_planted_overlaps_are_found_and_no_others(planted):
    docs, items, truth = planted
    assert pairs(D.overlaps(docs, items)) == truth


def test_a_full_bit_map_only_costs_time(planted, monkeypatch):
    docs, items, truth = planted
    monkeypatch.setattr(D, "MOST_BITS", 1 << 16)
    assert pairs(D.overlaps(docs, items)) == truth


def test_removal(planted):
    docs, items, truth = planted
    kept = D.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in truth}


def test_against_a_plain_search(sample):
    """Items that a text holds word for word."""
    words = lambda t: " " + " ".join(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(
        {c: c + 32 for c in range(65, 91)}))) + " "
    docs, items = sample("documents"), sample("benchmark")
    plain = [(r["item_id"], words(r["text"])) for r in items.collect()]
    truth = {(d["doc_id"], i) for d in docs.collect() for i, t in plain if len(t.split()) >= 5 and t in words(d["text"])}
    found = D.overlaps(docs, items)
    assert truth and pairs(found) == truth
    assert pairs(found.filter("coverage = 1")) == truth


@pytest.fixture(scope="module")
def short_items(docs_of, spark):
    """Items of 1 to 16 words, and texts that hold them with 0 to 5 substituted words at random places."""
    rng = random.Random(11)
    items = [(100 * n + k, [f"w{n}x{k}x{i}" for i in range(n)]) for n in range(1, 17) for k in range(3)]
    texts, d = [], 0
    for key, own in items:
        for many in range(0, min(len(own), 6)):
            for _ in range(6):
                copy = list(own)
                for at in rng.sample(range(len(copy)), many):
                    copy[at] = f"other{rng.randrange(10 ** 6)}"
                texts.append((d, [f"a{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 40))] + copy + ["end"] * rng.randint(0, 3)))
                d += 1
    return items, texts, docs_of([(d, " ".join(t)) for d, t in texts]), spark.createDataFrame(
        [(k, " ".join(i)) for k, i in items], "item_id long, text string")


def aligned_by_hand(text, item):
    """Whether some alignment without gaps has a stretch with enough equal words, by trying all of them."""
    need = D.needed_words(len(item))
    for shift in range(-len(item), len(text) + 1):
        equal = [0 <= shift + i < len(text) and text[shift + i] == w for i, w in enumerate(item)]
        if sum(equal) < need:
            continue
        spans = [(sum(equal[b:e]), e - b) for b in range(len(item)) for e in range(b + 1, len(item) + 1)]
        most = max(2 * n - size for n, size in spans)
        if any(2 * n - size == most and n >= need and n >= D.IDENTITY * size for n, size in spans):
            return True
    return False


def test_short_items_against_a_plain_aligner(short_items):
    items, texts, docs, table = short_items
    truth = {(d, k) for d, t in texts for k, i in items if set(t) & set(i) and aligned_by_hand(t, i)}
    found = pairs(D.overlaps(docs, table, shortest=1))
    assert found <= truth
    sizes = {k: len(i) for k, i in items}
    for n in range(1, 17):
        own = {p for p in truth if sizes[p[1]] == n}
        assert own and len(found & own) >= (1.0 if n <= D.ALL_EQUAL else 0.9) * len(own), n
    assert any(sizes[k] == 9 and sum(w in texts[d][1] for w in dict(items)[k]) == 8 for d, k in found)
    assert pairs(D.overlaps(docs, table)) == {p for p in found if sizes[p[1]] >= D.SHORTEST}


def test_odd_rows(odd_docs, sample, spark):
    items = spark.createDataFrame([(None, "word " * 9), (1, "word " * 9), (1, "word " * 9), (2, None), (3, "one")],
                                  "item_id long, text string").withColumn("seed", D.F.lit(1))
    found = pairs(D.overlaps(odd_docs, items))
    assert found == {(7, None), (7, 1)}
    kept = D.remove_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert D.overlaps(odd_docs.limit(0), items).count() == 0
    assert D.overlaps(odd_docs, items.limit(0)).count() == 0
