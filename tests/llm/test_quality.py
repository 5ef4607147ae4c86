"""Quality rules against a plain version, and the guarantee on planted labels."""

from __future__ import annotations

import math
import re

from ludolake.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    spans = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = {}
    for s in spans:
        count[s] = count.get(s, 0) + 1
    covered = {i + k for i, s in enumerate(spans) if count[s] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), lines)


def stats_of(df):
    rows = df.select("doc_id", "text", Q.text_stats(Q.as_text("text")).alias("s")).collect()
    return [(r["text"], tuple(r["s"])) for r in rows]


def test_stats_match_a_plain_version(sample):
    for text, got in stats_of(sample("documents")):
        assert got == plain_stats(text)


def test_stats_of_odd_texts(odd_docs, docs_of):
    made = docs_of(["a b\na b\n a b\n\n", "x y z w v u t s " * 3, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "ab", "cd"])
    for frame in (odd_docs, made):
        for text, got in stats_of(frame):
            assert got == plain_stats(text), (text or "")[:40]


def test_binomial_tail():
    for k, n, p in ((0, 10, 0.1), (3, 20, 0.2), (20, 20, 0.5), (5, 5000, 0.01)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(Q.binomial_tail(k, n, p) - exact) < 1e-9


def test_few_labels_reject_nothing_beyond_the_base_rule(sample):
    docs = sample("documents")
    model = Q.fit_quality(docs, sample("labels").limit(10))
    assert model.chosen == {}
    for r in Q.judge_quality(docs, model).collect():
        n, *_, repeat, _ = plain_stats(r["text"])
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert r["kept"] == (not r["base_failed"])


def test_cutoffs_keep_good_and_reject_poor(spark, docs_of):
    good = [" ".join(f"w{i * k % 977}x" for k in range(1, 30)) for i in range(1500)]
    poor = [" ".join(f"w{i * k % 977}x###" for k in range(1, 30)) for i in range(1, 301)]
    docs = docs_of(good + poor)
    labels = spark.createDataFrame([(i, int(i < 1500), 0) for i in range(1800)] + [(None, 1, 0), (0, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = Q.fit_quality(docs, labels)
    assert set(model.chosen) == {"en"}
    assert all(e["tail"] <= 0.05 or e["setting"] > model.chosen["en"] for e in model.evidence)
    kept = {r["doc_id"] for r in Q.keep_good(docs, labels).collect()}
    assert kept <= set(range(1500)) and len(kept) >= 1480


def test_odd_rows(odd_docs, sample):
    out = Q.keep_good(odd_docs, sample("labels"))
    assert out.columns == odd_docs.columns
    out.collect()
    assert Q.keep_good(odd_docs.limit(0), sample("labels").limit(0)).count() == 0
