"""Token counts against the library, and packing as an exact round trip."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ludolake.llm import encoding as E
from ludolake.llm import packing as P


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer)
    return lambda t: own.encode(t or "", add_special_tokens=False).ids


ODD = ["don't I'll we've x's'S 'RE", "a b c d\x85e\x1cf", "é e ́x", "ÀÉ×÷ ß ẞ İ ſ ﬁ ½ Ⅷ ² ª º µ",
       "12345 1,234.50 a1b2", "<|endoftext|>x<|startoftext|> <|end of text|> <|ENDOFTEXT|>", "日本語 テキスト ไทย हिन्दी", "🙂👩‍👩‍👧 ok",
       "\n\n  \t x\r\ny\x0bz\x0c", "a" * 3000, "x-" * 500, "﻿bom ​ zero", "ΑΣ ΣΑΣ", "_under_score_", "\x00\x7f", "'", "' s"]


def test_odd_texts_match_the_library(tokenizer, library):
    own = E.Encoder(tokenizer)
    assert own.piecewise
    texts = ODD + [" ".join(ODD), "\n".join(reversed(ODD))]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library(text), text[:50]
    assert E.Encoder(tokenizer).lengths(texts) == [len(library(t)) for t in texts]


def test_pieces_of_letters_need_no_patterns(tokenizer, library, monkeypatch):
    """Also while generations change in the middle of a text."""
    text = "".join(f"{a}{b}{c} " for a in "qwx" for b in "UerT" for c in ("zq", "Lo", "mist")) * 3
    monkeypatch.setattr(E, "_COMMON", None)
    monkeypatch.setattr(E, "_WORDS", None)
    for room in (100, 3000, 1 << 20):
        assert np.frombuffer(E.Encoder(tokenizer, room).ids(text), "<u4").tolist() == library(text)


def test_random_texts_match_the_library(tokenizer, library, monkeypatch):
    monkeypatch.setattr(E, "REMEMBERED_BYTES", 4000)
    monkeypatch.setattr(E, "LONG_PIECE", 12)
    own, rng = E.Encoder(tokenizer), random.Random(1)
    letters = "ab zZ éÉ '.,-\n\t19²½ßſ́ 日<|>s"
    for _ in range(400):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3)]
        for text in texts:
            assert np.frombuffer(own.ids(text), "<u4").tolist() == library(text), repr(text)
        assert own.lengths(texts) == [len(library(t)) for t in texts], repr(texts)
        assert len(own.known) + len(own.sizes) + len(own.older) + len(own.older_sizes) < 60


def test_long_texts_without_blanks_are_cut_at_safe_places(tokenizer, library):
    own, rng = E.Encoder(tokenizer), random.Random(2)
    text = "".join(rng.choice("abcXYZé019'.,;=\u0338\u0301-_s") for _ in range(20_000))
    assert max(map(len, own._pieces(text))) < 200
    assert own.lengths([text]) == [len(library(text))]
    held = text[:3000] + "<|endoftext|>" + text[3000:]
    assert own._pieces(held) == [held] and own.lengths([held]) == [len(library(held))]


def test_new_pieces_go_through_the_library_in_calls_of_bounded_bytes(tokenizer, library, monkeypatch):
    monkeypatch.setattr(E, "CALL_BYTES", 300)
    own, calls = E.Encoder(tokenizer), []

    class Counting:
        def __init__(self, whole):
            self.whole = whole

        def encode_batch_fast(self, pieces, **options):
            calls.append(list(pieces))
            return self.whole.encode_batch_fast(pieces, **options)

    own.whole = Counting(own.whole)
    texts = [" ".join(f"word{i % 90}x" for i in range(k, k + 50)) for k in range(0, 200, 20)]
    assert own.lengths(texts) == [len(library(t)) for t in texts]
    assert len(calls) > 1 and all(sum(map(len, c)) < 400 for c in calls)
    assert sum(map(len, calls)) == 90  # each once
    assert own.lengths(texts) and sum(map(len, calls)) == 90


def test_batches_are_balanced_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(E, "BATCH_BYTES", 1000)
    texts = ["x" * n for n in (10, 500, 400, 300, 5000, 0, 1, 999)] + [None]
    parts = [p.to_pylist() for p in E.balanced(pa.array(texts))]
    assert [t for p in parts for t in p] == texts
    assert all(sum(len(t or "") for t in p) <= 1000 or len(p) == 1 for p in parts) and len(parts) == 4


def test_counts(sample, odd_docs, tokenizer, library):
    for docs in (sample("documents"), odd_docs):
        want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(library(r["text"]))) for r in docs.collect())
        got = E.count_tokens(docs, tokenizer).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert E.count_tokens(odd_docs.limit(0), tokenizer).count() == 0


def test_piece_models(docs_of):
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "hello there", "日本語 x", "<s> </s>"]
    got = {r["doc_id"]: r["n_tokens"] for r in E.count_tokens(docs_of(texts), path).collect()}
    assert [got[i] for i in range(len(texts))] == [len(model.encode(t)) for t in texts]


def check_packing(docs, out, library, window):
    """Every id in one piece, sequences gapless and within the window; returns padding and ids."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    padding = total = 0
    for rows in sequences.values():
        end = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == end and r["length"] > 0
            end += r["length"]
        assert end <= window
        total += end
        padding += 0 if end & (end - 1) == 0 else window - end
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append([*library(r["text"]), 2])
    for doc, rows in by_doc.items():
        assert sum(r["length"] for r in rows) == sum(map(len, texts[doc]))
        if len(texts[doc]) == 1:
            ids, end = texts[doc][0], 0
            for r in sorted(rows, key=lambda r: r["start"]):
                assert r["start"] == end and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[end:end + r["length"]], "<u4").tobytes())
                end += r["length"]
            assert end == len(ids)
    assert set(by_doc) == set(texts)
    return padding, total


@pytest.mark.parametrize("parts", [1, 7])
def test_packing(sample, tokenizer, library, parts):
    docs = sample("documents").repartition(parts)
    out = P.pack(docs, tokenizer).collect()
    padding, total = check_packing(docs, out, library, P.WINDOW)
    assert padding <= 0.01 * total


def test_packing_of_odd_rows(odd_docs, tokenizer, library):
    out = P.pack(odd_docs, tokenizer, window=64, open_windows=2, min_head=4).collect()
    padding, total = check_packing(odd_docs, out, library, 64)
    assert padding <= 0.05 * total
    assert P.pack(odd_docs.limit(0), tokenizer).count() == 0


def test_pieces_are_the_same_when_run_again(sample, tokenizer):
    docs = sample("documents")
    first, again = (sorted(map(tuple, P.pack(docs, tokenizer).collect())) for _ in range(2))
    assert first == again
