"""What several operators share: batches of bounded size, hashing of words, bounded samples.

All text work is done on the UTF-8 bytes of an Arrow column at once, so Python never loops
over the words of a text.  Hashes are 64 bits wide and do not depend on how rows are batched.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send the functions of this module to tasks by value: workers need no copy of the library."""
    register_pickle_by_value(sys.modules[module])


ship(__name__)
U64 = np.uint64
SLICE_BYTES = 1 << 20  # text bytes handled at a time in a task; one longer text is handled alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows, cut so that the texts of a batch have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(
            pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)
        )
        part = (np.cumsum(sizes + 64) // limit).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def lower_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in the inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


LOWER = lower_table()
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # of lower-cased ASCII
_BYTE = numbers(11, 256)
_BASE = 0x9E3779B97F4A7C15


def process_cache() -> dict:
    """A dict that lives as long as the Python process and is never sent to tasks."""
    name = "_stratalake_process_cache"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers of an odd number and of its inverse, modulo 2**64."""
    kept = process_cache().get("powers")
    if kept is None or len(kept[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        kept = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            kept.append(np.cumprod(steps))
        process_cache()["powers"] = kept
    return kept[0], kept[1]


@dataclass
class Words:
    """The words of a column: byte ranges, 64-bit hashes, and the first word of each row
    (``first`` has one entry more than rows)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words are the longest runs of bytes outside ``separators``, lower-cased over A-Z."""
    n = len(data)
    low = LOWER[data]
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[low]
    edge = np.zeros(n + 1, bool)  # a row begins here
    edge[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[low] * power[:n], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    value = mix(value + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))
    return Words(start, end, value, np.searchsorted(start, offsets))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``size`` words within one row."""
    weights = numbers(1000 + size, size)
    n = len(w.hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    value = np.zeros(n - size + 1, U64)
    for j in range(size):
        value += w.hash[j : n - size + 1 + j] * weights[j]
    at = np.arange(n - size + 1)
    ends = np.repeat(w.first[1:], w.count)[: n - size + 1]
    keep = at + size <= ends
    return at[keep], mix(value[keep])


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, ordered; a shorter row is one shingle."""
    at, value = windows(w, size)
    row = w.row[at]
    for short in range(1, size):
        rows = np.flatnonzero(w.count == short)
        if len(rows):
            weights = numbers(1000 + short, short)
            total = sum(w.hash[w.first[rows] + j] * weights[j] for j in range(short))
            row, value = np.concatenate([row, rows]), np.concatenate([value, mix(total)])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, always the same ones: those with the smallest hash of ``key``.

    The count of all rows gives a bound that about twice as many hashes pass, so sorting and cutting
    are left with so many rows whatever the number of tasks.  ``df`` should hold each key once.
    """
    rank = F.xxhash64(F.col(key).cast("string"), F.lit(7))
    rows = df.count()
    if rows > 4 * limit:  # far below, hashes could be too uneven for a bound
        share = min(1.0, (2 * limit + 1000) / rows)
        df = df.where(rank < int(-(2**63) + share * 2**64) if share < 1 else F.lit(True))
    return df.orderBy(rank, key).limit(limit)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text, label of at most ``limit`` labelled documents that have a text.

    A doc_id with several labels counts with the largest, one with several texts with the smallest
    text (the choice is made in the tasks first), so repeated ids add no rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = bounded_sample(known.groupBy("doc_id").agg(F.max(label).alias(label)), "doc_id", limit)
    texts = docs.where("text is not null").select("doc_id", "text")
    return (
        texts.join(F.broadcast(chosen), "doc_id")  # no more than ``limit`` ids
        .groupBy("doc_id", label)
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", label)
    )


def fold(key: str, modulus: int):
    """crc32 of the key as text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string")) % modulus
