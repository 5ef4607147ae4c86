"""Operator 4: bounded-space online packing of tokenized documents into fixed windows.

Each partition keeps ``open_windows`` windows. A document longer than a window is first cut into full
windows and a rest. A piece goes to the open window where it leaves the least room; when none has room,
the fullest is emitted, topped up with the head of the piece if its gap is ``min_head`` or more, and the rest of the piece
goes on. At its end a partition hands its open windows, which are bounded, to the second step. There the
leftovers of ``MERGED`` partitions meet in one group and are packed anew in the same way, largest first;
the last, partly filled windows are joined and cut to sequences whose lengths are powers of two, so they
need no padding either.

A sequence id has the partition or merge group in its upper bits, so packing needs no global numbering,
and a task that runs again gives the same ids.

Defined results: a null or empty text is a document of one id, the end mark. Repeated rows are packed as
often as they occur; null doc_ids stay null. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import as_text, stored
from ludolake.llm.encoding import balanced, encoder
from ludolake.llm.wordhash import give_back

WINDOW = 4096
OPEN_WINDOWS = 32
MIN_HEAD = 32      # smaller gaps of an emitted window stay empty
MERGED = 16        # partitions whose leftovers meet in one group
END = np.array([2], dtype="<u4").tobytes()
_MERGE_BIT = 1 << 62

_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, ids binary")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
_KINDS = [*[pa.int64()] * 7, pa.binary()]


class Piece:
    """Consecutive ids of one document."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:4 * size], self.doc_tokens),
                Piece(self.doc_id, self.start + size, self.ids[4 * size:], self.doc_tokens))


class Packer:
    """Open windows of one task; ``add`` yields the windows that are complete."""

    def __init__(self, window: int, open_windows: int, min_head: int):
        self.window, self.most, self.min_head = window, open_windows, min_head
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.window:
            head, piece = piece.cut(self.window)
            yield [head]
        while len(piece):
            fits = [(r, i) for i, r in enumerate(self.room) if r >= len(piece)]
            if fits:
                room, i = min(fits)
                self.open[i].append(piece)
                self.room[i] = room - len(piece)
                if not self.room[i]:
                    yield self._take(i)
                return
            if len(self.open) < self.most:
                self.open.append([piece])
                self.room.append(self.window - len(piece))
                return
            room, i = min((r, i) for i, r in enumerate(self.room))
            if room >= self.min_head:
                head, piece = piece.cut(room)
                self.open[i].append(head)
            yield self._take(i)

    def _take(self, i: int) -> list[Piece]:
        self.room.pop(i)
        return self.open.pop(i)


def _rows(found: list[tuple[int, list[Piece]]], leftover: bool = False) -> pa.RecordBatch:
    """Rows of ``_PIECES``; leftovers keep their ids and have no sequence yet."""
    columns = [[] for _ in _NAMES]
    for sequence, pieces in found:
        offset = 0
        for p in pieces:
            for column, value in zip(columns, (p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens,
                                               sequence, offset, p.ids if leftover else None)):
                column.append(value)
            offset += len(p)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _powers(pieces: list[Piece], window: int) -> Iterator[list[Piece]]:
    """The pieces as sequences of at most ``window`` ids, each a power of two long or full."""
    left = sum(len(p) for p in pieces)
    queue = list(reversed(pieces))
    while left:
        size = window if left >= window else 1 << (left.bit_length() - 1)
        out, room = [], size
        while room:
            piece = queue.pop()
            if len(piece) > room:
                piece, rest = piece.cut(room)
                queue.append(rest)
            out.append(piece)
            room -= len(piece)
        left -= size
        yield out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         min_head: int = MIN_HEAD, text: str = "text", key: str = "doc_id", remembered: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``remembered`` bounds the bytes of encoded pieces that a worker keeps, for jobs whose workers serve other stages, too;
    less memory costs time, the rows are the same.
    """
    def first(batches):
        give_back()
        own, packer, count = encoder(tokenizer, remembered), Packer(window, open_windows, min_head), 0
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = table["doc_id"].to_pylist()
            at = 0
            for part in balanced(table["text"].combine_chunks()):
                done = []
                for value in part.to_pylist():
                    ids = own.ids(value or "") + END
                    for pieces in packer.add(Piece(keys[at], 0, ids, len(ids) // 4)):
                        done.append((base + count, pieces))
                        count += 1
                    at += 1
                yield _rows(done)
        # The leftovers carry the partition until they are merged.
        yield _rows([(base, pieces) for pieces in packer.open], leftover=True)

    def merge(t: pa.Table) -> pa.Table:
        group, done = t["group"][0].as_py(), []
        found = [Piece(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in t.to_pylist()]
        found.sort(key=lambda p: (-len(p), p.doc_id is None, p.doc_id or 0, p.start, p.ids))
        packer = Packer(window, max(open_windows, 1), min_head)
        for piece in found:
            done += packer.add(piece)
        done += _powers([p for w in packer.open for p in w], window)
        return pa.Table.from_batches([_rows([(_MERGE_BIT + (group << 36) + i, p) for i, p in enumerate(done)])])

    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), as_text(text).alias("text"))
    pieces = stored(docs.mapInArrow(first, _PIECES), "pieces")
    group = F.shiftright("sequence_id", 36).cast("long")
    left = (pieces.filter("ids is not null").withColumn("group", F.floor(group / MERGED).cast("long"))
            .groupBy("group").applyInArrow(merge, _PIECES))
    return pieces.filter("ids is null").unionByName(left).drop("ids")
