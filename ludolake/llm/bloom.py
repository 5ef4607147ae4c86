"""Bloom filters of bounded size, and an anti-join in which only suspects travel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28       # of a bit map: 32 MB; a fuller one lets more pass, nothing is lost
BITS_A_KEY = 32
PROBES = (0, 12, 24, 36)  # a hash sets the bits that it names from these bits on


def bit_map_of(hashes: DataFrame, bits_each: int = BITS_A_KEY, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bloom filter of a frame's only or first column of 64-bit hashes."""
    name = hashes.columns[0]
    width = min(most_bits, max(1 << 16, 1 << (bits_each * hashes.count()).bit_length())).bit_length() - 1
    places = F.array(*[F.shiftrightunsigned(name, 64 - width - r).bitwiseAND((1 << width) - 1) + 1 for r in PROBES])
    rows = (hashes.select(F.explode(places).alias("v")).groupBy(F.bitmap_bucket_number("v").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("b")).collect())
    out = np.zeros((1 << width) // 8, dtype=np.uint8)
    for row in rows:
        own = np.frombuffer(row["b"], dtype=np.uint8)
        begin = (row["k"] - 1) * len(own)
        out[begin:begin + len(own)] = own[:len(out) - begin]
    return out


def may_hold(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the filter lets pass."""
    width = (len(bits) * 8).bit_length() - 1
    at = np.arange(len(hashes))
    for r in PROBES:
        place = ((hashes[at] >> np.uint64(64 - width - r)) & np.uint64((1 << width) - 1)).astype(np.int64)
        at = at[((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)]
    return at


def without(df: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not in the one column of ``dropped``; null keys stay.

    A Bloom filter of the dropped keys tells most of the other rows, which stay where they are; only rows that may be dropped are
    joined. So texts that are kept don't travel, at any size, and the result is exact.
    """
    bits = bit_map_of(dropped.select(F.xxhash64(dropped.columns[0])))

    def suspect(hashes: pa.Array) -> pa.Array:
        out = np.zeros(len(hashes), dtype=bool)
        out[may_hold(hashes.to_numpy().view(np.uint64), bits)] = True
        return pa.array(out)

    asked = F.arrow_udf(suspect, "boolean")(F.xxhash64(key))
    gone = dropped.toDF("__dropped")
    return df.filter(~asked).unionByName(df.filter(asked).join(gone, key == F.col("__dropped"), "left_anti"))
