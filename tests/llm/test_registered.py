"""The registered queries and the pipeline."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from oracle import compare, duck

import corpus_pipeline
from ludolake.llm import jaccard, quality, toxicity
from ludolake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_benchmark_decontamination", "op5_toxicity", "op6_html_extraction", "op9_quality_rules"])
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).collect()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, sample, tokenizer):
    """Each stage keeps the rows that the operator's own verdicts keep, with all columns of documents."""
    docs, labels = sample("documents"), sample("labels")
    columns, ids = docs.columns, lambda df: sorted(r["doc_id"] for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, FOLDER)
    verdicts = quality.judge_quality(docs, quality.fit_quality(docs, labels))
    assert good.columns == columns and ids(good) == ids(verdicts.filter("kept"))
    kind = stages["toxicity"](spark, good, FOLDER)
    scores = toxicity.score_toxicity(good, toxicity.fit_toxicity(good, labels))
    assert kind.columns == columns and ids(kind) == ids(scores.filter("score < 0.3"))
    single = stages["ngram_jaccard_join"](spark, kind, FOLDER)
    assert single.columns == columns
    links = jaccard.link_documents(kind, size=5, percent=80).collect()
    assert ids(single) == sorted({r["component_id"] for r in links if r["n_shingles"]} | {r["doc_id"] for r in links if not r["n_shingles"]})
    clean = stages["benchmark_decontamination"](spark, single, FOLDER)
    assert clean.columns == columns and set(ids(clean)) < set(ids(single))
    out = stages["packing"](spark, clean, FOLDER)
    assert sorted({r["doc_id"] for r in out.collect()}) == ids(clean)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted({r["doc_id"] for r in whole.collect()}) == ids(clean)


def test_pipeline_keeps_odd_rows_from_breaking_a_stage(spark, odd_docs, tokenizer):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    docs.collect()


def test_the_rest_works_without_these_folders(tmp_path):
    """A copy without the subpackage and the pipeline still imports, with all other queries."""
    root = Path(__file__).parent.parent.parent
    for file in [root / "__spark_entry__.py", *[f for f in (root / "ludolake").rglob("*.py") if "llm" not in f.parts]]:
        target = tmp_path / file.relative_to(root)
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(file.read_bytes())
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)
    many, oracles = map(int, said.stdout.split())
    assert many > 150 and oracles > 140, said.stderr


def test_near_copies_of_the_pipeline_by_brute_force(spark, docs_of):
    """Five words and 0.8: a text with a fifth appended is a copy, one with a third appended is none."""
    import random

    from test_jaccard import brute, variants

    rng, rows = random.Random(8), []
    for _ in range(12):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([100, 300, 1000]))]
        more = [f"w{rng.randrange(10 ** 6)}" for _ in range(len(base) // 3)]
        rows += [" ".join(base), " ".join(base + more[:len(base) // 5]), " ".join(base + more), *variants(rng, base, 3, len(base) // 20)]
    rows = list(enumerate(rows))
    first = {doc for doc, _, least in brute(rows, 5, 80) if doc == least}
    assert first < {doc for doc, _, least in brute(rows) if doc == least}
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs_of(rows), FOLDER)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first)
