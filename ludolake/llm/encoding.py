"""Operator 8: token counts of whole texts, and the token ids that packing needs.

A text is cut at spaces and line feeds, where the tokenizer always cuts: its normalizer works character
by character around them, its pattern never matches across white space, and its special strings contain
none. A longer stretch without them is cut before digits and between a letter and a mark, where the
pattern always ends a match, unless it holds a special string. So a text of any length is encoded piece by piece.

Token counts: Arrow batches are regrouped to about ``BATCH_BYTES`` of text, whatever the rows' lengths. The pieces of such a
group that have not been seen before go through the library's batch encoding in calls of about ``CALL_BYTES``, of
which only the lengths are kept; a text's count is the sum over its pieces.

Token ids: a piece seen before is looked up. A new
piece of common Latin letters, digits and marks is cut further by the tokenizer's own pattern, and its
words go straight to the tokenizer's model; any other piece goes through the library as it is.

Files whose normalizer or pattern is not of this kind are encoded by whole texts by the library.
What a worker remembers is bounded in bytes, in two generations: when the newer is full, the older is dropped.

Defined results: null and empty texts have 0 tokens. Repeated rows are counted alike; other columns are not read, so they
may have any name; an empty table gives no rows; texts of any length are counted whole.
"""

from __future__ import annotations

import json
import re
import weakref
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import as_text
from ludolake.llm.wordhash import RELEASES, give_back, text_bytes

BATCH_BYTES = 4 << 20
CALL_BYTES = 1 << 20
REMEMBERED_BYTES = 192 << 20  # of pieces and words that a worker remembers; callers may ask for less
ENTRY_BYTES = 200            # of a remembered piece besides its text and ids
LONGEST_REMEMBERED = 64
LONG_PIECE = 1024            # characters from which a stretch without blanks is cut further

_LATIN = "a-zß-öø-ÿ"
_SAFE = re.compile(r"(?=[0-9])|(?<=[A-Za-z])(?=[!-/:-@\[-`{-~])")
_COMMON = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The tokenizer file's pattern, for lower-case Latin text.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\s{_LATIN}0-9]+")
# The parts of a tokenizer file that the piecewise way is made for.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write bytes as printable characters; others get the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids by piece; its encoder finds those of a piece that isn't held. It doesn't keep the encoder, which goes when it is let go."""

    def __init__(self, owner: Encoder):
        super().__init__({"": b""})
        self.owner = weakref.proxy(owner)

    def __missing__(self, piece: str) -> bytes:
        return self.owner._piece(piece)


class Encoder:
    """Ids of pieces and texts for one tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str, remembered: int | None = None):
        import os

        self.room = (REMEMBERED_BYTES if remembered is None else remembered) // 2
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.piecewise = (kinds == _NORMALIZERS and len(parts) == 2 and parts[1]["type"] == "ByteLevel"
                          and parts[0].get("pattern", {}).get("Regex") == _PATTERN
                          and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                                      for t in spec["added_tokens"]))
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"\Z\A.").search
        # letters alone hold no special string, so a piece of them is one word of the pattern
        self.plain = not any(t["content"].isalpha() for t in spec["added_tokens"])
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size(with_added_tokens=True))]
        del spec
        self.model, self.letters = self.whole.model, str.maketrans(_byte_letters())
        self.known = _Known(self)  # pieces and words
        self.sizes: dict[str, int] = {"": 0}      # numbers of tokens of pieces
        self.older: dict[str, bytes] = {}
        self.older_sizes: dict[str, int] = {}
        self.held = 0

    def _grow(self, many: int) -> None:
        self.held += many
        if self.held > self.room:
            self.older, self.known, self.held = self.known, _Known(self), 0
            self.older_sizes, self.sizes = self.sizes, {"": 0}

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(piece) <= LONGEST_REMEMBERED:
            self._grow(ENTRY_BYTES + len(piece) + len(ids))
            self.known[piece] = ids
        return ids

    def _pieces(self, text: str) -> list[str]:
        pieces = text.replace("\n", " ").split(" ")
        if len(text) < LONG_PIECE or max(map(len, pieces)) < LONG_PIECE:
            return pieces
        out = []
        for piece in pieces:
            out += [piece] if len(piece) < LONG_PIECE or self.special(piece) else _SAFE.split(piece)
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        """Numbers of tokens of the texts, by batch encoding of all pieces that are new."""
        if not self.piecewise:
            return [len(e) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        cut, own = [self._pieces(t) for t in texts], {}
        for piece in set().union(*cut):
            found = self.sizes.get(piece)
            own[piece] = self.older_sizes.get(piece) if found is None else found
        fresh = [p for p, n in own.items() if n is None]
        ends = np.cumsum([len(p) for p in fresh]) // CALL_BYTES
        for part in np.split(np.arange(len(fresh)), np.flatnonzero(np.diff(ends)) + 1) if fresh else ():
            pieces = [fresh[i] for i in part.tolist()]
            for piece, encoded in zip(pieces, self.whole.encode_batch_fast(pieces, add_special_tokens=False)):
                own[piece] = len(encoded)
        for piece, n in own.items():
            if len(piece) <= LONGEST_REMEMBERED and piece not in self.sizes:
                self._grow(ENTRY_BYTES + len(piece))
                self.sizes[piece] = n
        return [sum(map(own.__getitem__, pieces)) for pieces in cut]

    def _word(self, word: str) -> bytes:
        """Ids of a word that the pattern has cut; as a piece it has the same ids."""
        found = self.known.get(word)
        if found is None and word in self.older:
            return self._remember(word, self.older[word])
        if found is None:
            # printable ASCII is written as itself
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            found = self._remember(word, b"".join([self.bytes_of[t.id] for t in self.model.tokenize(letters)]))
        return found

    def _piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None and piece in self.older:
            return self._remember(piece, self.older[piece])
        if found is None:
            if self.plain and piece.isascii() and piece.isalpha():
                word = piece.lower()
                found = self._word(word)
                return found if word == piece else self._remember(piece, found)
            if not _COMMON.fullmatch(piece) or self.special(piece):
                return self._remember(piece, self._library(piece))
            words = _WORDS.findall(piece.lower())
            found = b"".join(map(self._word, words))
            if words != [piece]:
                self._remember(piece, found)
        return found

    def _library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if not self.piecewise:
            return self._library(text)
        # the generation may change on the way; the one that was asked first still finds what it lacks
        return b"".join(map(self.known.__getitem__, self._pieces(text)))


class PieceCounter:
    """Token counts by a SentencePiece model, text by text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_bos=False, add_eos=False), dtype="<u4").tobytes()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, add_bos=False, add_eos=False)]


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int | None = None) -> Encoder | PieceCounter:
    """One encoder for each file and worker; what it remembers serves all tasks of the worker."""
    made = PieceCounter(path) if path.endswith(".model") else Encoder(path, remembered)
    give_back()  # what reading the file took
    return made


RELEASES.append(encoder.cache_clear)


def balanced(texts: pa.Array):
    """Slices of a column with about ``BATCH_BYTES`` each; a longer text is alone."""
    _, offsets = text_bytes(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + BATCH_BYTES, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield texts.slice(first, last - first)
        first = last


def token_counts(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a text column, for a tokenizer file that all executors can read."""
    def count(texts: pa.Array) -> pa.Array:
        own = encoder(tokenizer)
        out = [n for part in balanced(texts) for n in own.lengths([t or "" for t in part.to_pylist()])]
        return pa.array(out, pa.int64())

    return F.arrow_udf(count, "long")(text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    out = docs.select(F.col(f"`{key}`").alias("doc_id"), as_text(text).alias("text"))
    out = out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                     token_counts(F.col("text"), tokenizer).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
