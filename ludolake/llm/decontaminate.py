"""Operator 2: benchmark decontamination by spaced-seed hashing.

A mask selects some of the word positions of a short span and ignores the others; the hash of the
selected words still matches where an ignored word was substituted. Test items are hashed under all
``MASKS`` at all positions. The same pass over the training texts keeps only positions whose hash is set
in a bit map of the item hashes, whose size is bounded, and sends them, with the word hashes around
them, to a join with the item hashes. Each joined pair fixes an alignment of text and item; the best
stretch of it, where equal words count 1 and unequal ones -1, is verified: at least ``min_equal`` equal
words that make up ``identity`` of the stretch. Of items that are too short for that, ``SHARE`` of the words must be equal, and
of items of up to ``ALL_EQUAL`` words all.

Words are lower-cased (A-Z) and parted by white space and ASCII marks. Items of less than ``LIGHT_BELOW`` words have
the lighter masks ``LIGHT``, too: of all ways to substitute words of an item of 6 to 16 words so that it still counts, at least 93 % are hit.
Items of up to ``ALL_EQUAL`` words are hashed whole. Those of fewer than ``shortest`` words are not searched: 5 unless the
caller says otherwise, as shorter ones occur by chance; 1 searches all. Only masks that some item uses are hashed in texts.

Defined results: null and empty texts overlap with nothing; items that are null, without words or too short neither.
Repeated rows and repeated items are all reported. Of equally good stretches the first in the text is reported. Rows with a
null ``doc_id`` are found, too, and ``remove_contaminated`` drops them by their text. Other columns are passed through, and
only the named ones are read. Without documents or items nothing overlaps. Texts of any length are searched whole.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.llm.bloom import bit_map_of, may_hold, without
from ludolake.llm.common import as_text, stored
from ludolake.llm.wordhash import WHITE_AND_MARKS, mix, words

#: Selected (1) and ignored (0) positions. Together they hit around every second, third, fourth or
#: fifth substituted word, and single ones at any place.
MASKS = ("111111", "11011011", "1110111", "111101111", "1010101010101")
#: For short items; with the others they hit most items of which three in ten words were substituted.
LIGHT = ("1111", "11011", "1010101")
LIGHT_BELOW = 17
SHORTEST = 5
ALL_EQUAL = 5
SHARE = 0.7
AROUND = 64           # words kept on both sides of a hit
MOST_BITS = 1 << 28   # of the bit map: 32 MB
BITS_A_SEED = 128
MIN_EQUAL = 10
IDENTITY = 0.6


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the selected words for every position where the mask fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.full(n, len(mask), np.uint64), 1
    for k, selected in enumerate(mask):
        if selected == "1":
            factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
            out += hashes[k:k + n] * np.uint64(factor)
    return mix(out + np.uint64(int(mask, 2) * 0x2545F491 % (1 << 64)))


def _own_masks(count: int, shortest: int) -> list[str]:
    """Masks for an item of ``count`` words."""
    if count < max(shortest, 1):
        return []
    if count <= ALL_EQUAL:
        return ["1" * count]
    return [m for m in (*MASKS, *(LIGHT if count < LIGHT_BELOW else ())) if len(m) <= count]


def needed_words(count: int, min_equal: int = MIN_EQUAL) -> int:
    """Equal words that an overlap with an item of ``count`` words needs."""
    return count if count <= ALL_EQUAL else min(min_equal, ceil(SHARE * count))


def _token_lists(texts: pa.Array):
    for own in words(texts, fold=True, separators=WHITE_AND_MARKS):
        for b, e in zip(own.bounds[:-1].tolist(), own.bounds[1:].tolist()):
            yield own.hashes[b:e]


def _item_seeds(items: DataFrame, text: str, key: str, shortest: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(item_id, item, words binary), (seed, item, position) and the masks in use; ``item`` numbers distinct rows by content."""
    def read(batches):
        for batch in batches:
            rows = [(_seed_lists(h, shortest), h.tobytes()) for h in _token_lists(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("item"), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[0][0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[0][1] for r in rows], pa.list_(pa.int32()))],
                names=["item_id", "item", "words", "seeds", "positions"])

    plain = items.select(F.col(f"`{key}`").cast("long").alias("item_id"), as_text(text).alias("text"))
    plain = plain.withColumn("item", F.xxhash64("item_id", "text"))
    kept = stored(plain.mapInArrow(read, "item_id long, item long, words binary, seeds array<long>, positions array<int>"),
                  "items")
    seeds = kept.select("item", F.inline(F.arrays_zip("seeds", "positions"))).select(
        F.col("seeds").alias("seed"), "item", F.col("positions").alias("position")).distinct()
    longest = max(LIGHT_BELOW, *map(len, MASKS))  # longer items have the same masks
    sizes = kept.select(F.least(F.octet_length("words") / 8, F.lit(longest)).cast("int").alias("n")).distinct().collect()
    masks = sorted({m for r in sizes for m in _own_masks(r["n"], shortest)})
    return kept.select("item_id", "item", "words").distinct(), seeds, masks


def _seed_lists(hashes: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    found = [_seeds(hashes, m) for m in _own_masks(len(hashes), shortest)]
    positions = [np.arange(len(s), dtype=np.int32) for s in found]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(found).view(np.int64), np.concatenate(positions)


def _hits(docs: DataFrame, bit_map, masks: list[str]) -> DataFrame:
    """(doc, doc_id, begin, words, seeds, positions): regions of texts with hits; positions count in the text."""
    def read(batches):
        bits = bit_map.value
        for batch in batches:
            rows = []
            for i, hashes in enumerate(_token_lists(batch.column("text"))):
                found, positions = [], []
                for m in masks:
                    seeds = _seeds(hashes, m)
                    at = may_hold(seeds, bits)
                    found.append(seeds[at])
                    positions.append(at)
                positions = np.concatenate(positions) if positions else np.zeros(0, np.int64)
                if not len(positions):
                    continue
                order = np.argsort(positions, kind="stable")
                positions, found = positions[order], np.concatenate(found)[order].view(np.int64)
                for part in np.split(np.arange(len(order)), np.flatnonzero(np.diff(positions) > 2 * AROUND) + 1):
                    begin = max(0, int(positions[part[0]]) - AROUND)
                    end = int(positions[part[-1]]) + AROUND + max(map(len, masks))
                    rows.append((i, begin, hashes[begin:end].tobytes(), found[part], positions[part].astype(np.int32)))
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(at), batch.column("doc_id").take(at),
                 *[pa.array([r[k] for r in rows], t) for k, t in
                   ((1, pa.int32()), (2, pa.binary()), (3, pa.list_(pa.int64())), (4, pa.list_(pa.int32())))]],
                names=["doc", "doc_id", "begin", "words", "seeds", "positions"])

    return docs.mapInArrow(read, "doc long, doc_id long, begin int, words binary, seeds array<long>, positions array<int>")


def _best_stretch(equal: np.ndarray, identity: float) -> tuple[int, int, int]:
    """Begin, end and equal words of the stretch with the largest number of equal less unequal words.

    Of equally good ones (from the first or to the last best end) the one with most equal words that make up ``identity`` of it.
    """
    sums = np.r_[0, np.cumsum(np.where(equal, 1, -1))]
    lowest = np.minimum.accumulate(sums)
    ends = np.flatnonzero(sums - lowest == (sums - lowest).max())
    best = (0, 0, 0)
    for end in {int(ends[0]), int(ends[-1])}:
        begins = np.flatnonzero(sums[:end + 1] == lowest[end])
        size = end - begins
        many = (size + sums[end] - lowest[end]) // 2
        good = np.flatnonzero(many >= identity * size)
        if len(good) and (int(many[good[0]]), -end) > (best[2], -best[1]):
            best = (int(begins[good[0]]), end, int(many[good[0]]))
    return best


def _verify(min_equal: int, identity: float):
    def check(begin: pa.Array, text: pa.Array, item: pa.Array, diagonal: pa.Array) -> pa.Array:
        out = []
        for b, t, i, d in zip(begin.to_pylist(), text.to_pylist(), item.to_pylist(), diagonal.to_pylist()):
            t, i = np.frombuffer(t, np.uint64), np.frombuffer(i, np.uint64)
            first, last = max(0, b - d), min(len(i), b + len(t) - d)  # item positions that the region covers
            s, e, n = _best_stretch(t[first + d - b:last + d - b] == i[first:last], identity) if last > first else (0, 0, 0)
            passed = n >= needed_words(len(i), min_equal) and n > 0
            out.append({"equal": n, "span": e - s, "item_begin": first + s, "text_begin": first + s + d,
                        "coverage": n / len(i) if len(i) else 0.0} if passed else None)
        return pa.array(out, pa.struct([("equal", pa.int64()), ("span", pa.int64()), ("item_begin", pa.int64()),
                                        ("text_begin", pa.int64()), ("coverage", pa.float64())]))

    return F.arrow_udf(check, "equal long, span long, item_begin long, text_begin long, coverage double")


def _doc_key(text: str, key: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`").cast("long"), as_text(text))


def overlaps(docs: DataFrame, items: DataFrame, min_equal: int = MIN_EQUAL, identity: float = IDENTITY, shortest: int = SHORTEST,
             text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per document row and item that overlap, with the longest verified stretch.

    Columns: doc (a hash of id and text), doc_id, item_id, equal, span, item_begin, text_begin (in words) and
    coverage, the share of the item's words that are equal.
    """
    spark = docs.sparkSession
    items_, seeds, masks = _item_seeds(items, item_text, item_key, shortest)
    plain = docs.select(_doc_key(text, key).alias("doc"), F.col(f"`{key}`").cast("long").alias("doc_id"),
                        as_text(text).alias("text"))
    bit_map = spark.sparkContext.broadcast(bit_map_of(seeds, BITS_A_SEED, MOST_BITS))
    regions = stored(_hits(plain, bit_map, masks), "regions")
    bit_map.unpersist()  # what executors hold; a lost one that runs again gets it from the driver
    aligned = (regions.select("doc", "begin", F.inline(F.arrays_zip("seeds", "positions")))
               .join(seeds, F.col("seeds") == F.col("seed"))
               .select("doc", "begin", "item", (F.col("positions") - F.col("position")).alias("diagonal")).distinct())
    held = regions.select("doc", "doc_id", "begin", F.col("words").alias("region")).distinct()
    pairs = aligned.join(held, ["doc", "begin"]).join(items_, "item")
    checked = pairs.select("doc", "doc_id", "item", "item_id", _verify(min_equal, identity)(
        F.col("begin"), F.col("region"), F.col("words"), F.col("diagonal")).alias("v")).filter("v is not null")
    best = F.max(F.struct("v.equal", F.negative("v.span").alias("span"), F.negative("v.text_begin").alias("text_begin"),
                          F.negative("v.item_begin").alias("item_begin"), "v.coverage"))
    return (checked.groupBy("doc", "doc_id", "item", "item_id").agg(best.alias("b"))
            .select("doc", "doc_id", "item_id", "b.equal", F.negative("b.span").alias("span"),
                    F.negative("b.item_begin").alias("item_begin"), F.negative("b.text_begin").alias("text_begin"),
                    "b.coverage"))


def remove_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with their columns."""
    found = overlaps(docs, items, text=text, key=key, **options).select("doc").distinct()
    return without(docs, _doc_key(text, key), stored(found, "contaminated"))
