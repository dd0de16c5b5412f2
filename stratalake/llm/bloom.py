"""Bloom filters of bounded size over 64-bit hashes.

A filter is an array of 64-bit words.  The upper bits of a hash choose a word and its lower bits
four bits of that word, so a hash is looked up with one access and filters are merged by OR.  A
filter never misses a hash; the larger the set is next to the filter, the more others it lets
through.  All users confirm exactly, so a full filter costs work, never results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import U64, ship

ship(__name__)
PER_WORD = 4  # hashes a word aims at
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 22  # 8 KB to 32 MB, whatever the input


def word_count(hashes: int) -> int:
    """The power of two of words that ``hashes`` hashes call for, within the bounds."""
    want = max(1, -(-hashes // PER_WORD))
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << (want - 1).bit_length()))


def places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bits of every hash (uint64)."""
    at = (hashes >> U64(65 - words.bit_length())).astype(np.int64)
    bits = np.zeros(len(hashes), U64)
    for shift in (0, 6, 12, 18):
        bits |= U64(1) << ((hashes >> U64(shift)) & U64(63))
    return at, bits


@dataclass
class Bloom:
    words: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at, bits = places(hashes, len(self.words))
        return (self.words[at] & bits) == bits


def collected(parts: DataFrame, words: int) -> Bloom:
    """The filter whose words (``at``, ``bits``) are the rows of ``parts``: no more rows than words."""
    table = parts.toArrow()
    out = np.zeros(words, U64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(U64)
    return Bloom(out)


def bloom(df: DataFrame, column: str, count: int) -> Bloom:
    """Filter over a column of 64-bit hashes, merged in Spark; only its words reach the driver."""
    words = word_count(count)
    bits = " | ".join(
        f"shiftleft(1L, cast(shiftrightunsigned({column}, {shift}) & 63L as int))" for shift in (0, 6, 12, 18)
    )
    parts = df.select(
        F.shiftrightunsigned(column, 65 - words.bit_length()).alias("at"), F.expr(bits).alias("bits")
    )
    return collected(parts.groupBy("at").agg(F.bit_or("bits").alias("bits")), words)
