"""Vector codes: product quantisation in whole numbers, nearest entries by slice-and-intersect masks.

A vector is cut into equal parts; each part position has a codebook of at most 64 entries, and a
part is coded by the index of its nearest entry.  A codebook is searched without comparing a part
with every entry:

* per dimension the entries are sorted by their coordinate, and ``prefix[i]`` is the 64-bit mask of
  the first ``i`` of them, so the mask of any range of coordinates is the XOR of two prefixes;
* the entries next to the part in each dimension give an initial radius: none nearer than the best
  of these lies outside the box of that radius;
* the masks of the box's sides are ANDed; what is left is compared exactly, lowest index first.

All arithmetic is on integers floor(256 * x).  Components so large that a squared distance could
pass 64 bits take the same steps in Python's integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import U64, ship
from stratalake.storage import written_copy

ship(__name__)
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMB = 30  # bits of the pieces in which very large sums travel
LONGEST = (1 << 63) - 1
ROWS = 4096  # vectors searched at a time
HOT = 1000  # a label held by more than 1 / HOT of all rows is joined apart


def bound(width: int) -> int:
    """Components up to this size have squared distances of ``width`` terms below 2**62."""
    return math.isqrt((1 << 62) // width) // 2 - 1


class Slices:
    """One codebook with its sorted coordinates and prefix masks."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.order = np.argsort(book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, self.order, 0)
        self.prefix = np.zeros((len(book) + 1, book.shape[1]), U64)
        for i in range(len(book)):
            self.prefix[i + 1] = self.prefix[i] | (U64(1) << self.order[i].astype(U64))

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mask of the entries in the box around each row, and the squared radius behind it."""
        n, width = x.shape
        least = np.full(n, LONGEST)
        for d in range(width):
            at = np.searchsorted(self.sorted[:, d], x[:, d])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(self.book) - 1)):
                entry = self.book[self.order[near, d]]
                least = np.minimum(least, ((x - entry) ** 2).sum(1))
        radius = np.sqrt(least.astype(float)).astype(np.int64) + 1
        mask = np.full(n, ~U64(0))
        for d in range(width):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            mask &= self.prefix[high, d] ^ self.prefix[low, d]
        return mask, least

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row (ties to the lower one) and squared distance."""
        mask, _ = self.candidates(x)
        index, best = np.zeros(len(x), np.int64), np.full(len(x), LONGEST)
        rows = np.arange(len(x))
        while len(rows):
            left = mask[rows]
            lowest = left & (~left + U64(1))
            entry = np.bitwise_count(lowest - U64(1)).astype(np.int64)
            distance = ((x[rows] - self.book[entry]) ** 2).sum(1)
            closer = distance < best[rows]
            index[rows[closer]], best[rows[closer]] = entry[closer], distance[closer]
            mask[rows] = left ^ lowest
            rows = rows[mask[rows] != 0]
        return index, best


def _nearest_wide(x: list[int], book: list[list[int]]) -> tuple[int, int]:
    distance = [sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)) for entry in book]
    least = min(distance)
    return distance.index(least), least


def _whole(x: float) -> int:
    """floor(SCALE * x), exact for any finite x."""
    return math.floor(x * SCALE) if abs(x) < 2.0**60 else int(x) * SCALE


@dataclass
class Books:
    """Codebooks by part position: entries of integer components, all of the same number."""

    entries: list[list[list[int]]]  # part, entry, component
    width: int  # components of a part

    def __post_init__(self):
        limit = bound(self.width)
        flat = (abs(c) for part in self.entries for entry in part for c in entry)
        self.narrow = all(c <= limit for c in flat)
        self.slices = [Slices(np.array(part, np.int64)) for part in self.entries] if self.narrow else []

    @property
    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, comma-joined."""
        flat = ",".join(str(c) for part in self.entries for entry in part for c in entry)
        return hashlib.sha256(flat.encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Entry and squared distance by row and part, and the integer components, of finite
        vectors (rows of doubles).  Distances and components are Python integers where the
        components of a row are too large."""
        n, parts = len(x), len(self.entries)
        wide = np.full(n, not self.narrow) | (np.abs(x) * SCALE > bound(self.width) - 1).any(1)
        whole = np.floor(np.where(wide[:, None], 0, x) * SCALE).astype(np.int64)
        index = np.zeros((n, parts), np.int64)
        distance = np.zeros((n, parts), object if wide.any() else np.int64)
        if self.narrow:
            for p, part in enumerate(self.slices):
                index[:, p], distance[:, p] = part.nearest(whole[:, p * self.width : (p + 1) * self.width])
        big = []
        for i in np.flatnonzero(wide):
            row = [_whole(c) for c in x[i].tolist()]
            for p, book in enumerate(self.entries):
                index[i, p], distance[i, p] = _nearest_wide(row[p * self.width : (p + 1) * self.width], book)
            big.append((i, row))
        return index, distance, [whole, wide, big]


def _kept(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.where(F.col(vector).isNotNull() & finite)


def _matrices(batches: Iterator[pa.RecordBatch], vector: str, length: int):
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            flat = part.column(vector).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.astype(np.float64).reshape(-1, length)


def _sums(books: Books, vector: str, length: int):
    """Arrow function: per part, entry and position the sum of the components coded by the entry,
    in limbs of ``LIMB`` bits where they are large, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, most, width = len(books.entries), len(books.entries[0]), books.width
        total = np.zeros((parts, most, width), np.int64)
        count = np.zeros((parts, most), np.int64)
        rows = 0

        def taken(total: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            p, e = np.nonzero(count)
            values = total[p, e].reshape(-1)
            columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)),
                       np.zeros(len(values), np.int64), values, np.repeat(count[p, e], width)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _SUMS)

        for _, x in _matrices(batches, vector, length):
            index, _, (whole, wide, big) = books.assign(x)
            plain = ~wide
            for p in range(parts):
                own = whole[plain, p * width : (p + 1) * width]
                np.add.at(total[p], index[plain, p], own)
                count[p] += np.bincount(index[plain, p], minlength=most)
            out = []
            for i, row in big:
                for p in range(parts):
                    for d in range(width):
                        value, sign, limb = abs(row[p * width + d]), 1 if row[p * width + d] >= 0 else -1, 0
                        while limb == 0 or value:
                            out.append((p, int(index[i, p]), d, limb, sign * (value & ((1 << LIMB) - 1)), int(limb == 0)))
                            value, limb = value >> LIMB, limb + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], _SUMS)
            rows += int(plain.sum())
            if rows * bound(width) >= 1 << 60:  # before a sum could pass 64 bits
                yield taken(total, count)
                total[:], count[:], rows = 0, 0, 0
        if rows:
            yield taken(total, count)

    return run


_SUMS = ["part", "entry", "place", "limb", "total", "n"]


def fit(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Books | None:
    """Codebooks of all kept rows; ``None`` when there are none.

    They start as the parts of the rows with the ``entries`` smallest keys (nulls last, equal keys
    by vector); a round codes every row and moves each used entry to its parts' mean, rounded down.
    The sums are added in Spark; the driver sees one row per component of the codebooks.
    """
    if not 1 <= entries <= 64:
        raise ValueError("a mask holds 64 entries")
    kept = _kept(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector")
    length = _length(kept, "vector", parts)
    if length is None:
        return None
    kept = kept.where(F.size("vector") == length)
    # Written by a task, so that the driver gets the chosen rows and not every task's best.
    first = written_copy(kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries), "first_codes")
    width = length // parts
    order = (F.col("key").asc_nulls_last(), "vector")
    rows = [[_whole(c) for c in r["vector"]] for r in first.orderBy(*order).collect()]
    books = Books([[row[p * width : (p + 1) * width] for row in rows] for p in range(parts)], width)
    for _ in range(rounds):
        sums = (
            kept.select("vector")
            .mapInArrow(_sums(books, "vector", length), ", ".join(f"{c} long" for c in _SUMS))
            .groupBy("part", "entry", "place", "limb")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
            .collect()
        )
        total: dict[tuple, int] = {}
        count: dict[tuple, int] = {}
        for r in sums:
            at = (r["part"], r["entry"], r["place"])
            total[at] = total.get(at, 0) + (int(r["total"]) << (LIMB * r["limb"]))
            count[at] = count.get(at, 0) + r["n"]
        books = Books(
            [
                [
                    [total[p, e, d] // count[p, e, d] if (p, e, d) in total else c for d, c in enumerate(entry)]
                    for e, entry in enumerate(part)
                ]
                for p, part in enumerate(books.entries)
            ],
            width,
        )
    return books


def _length(kept: DataFrame, vector: str, parts: int) -> int | None:
    """The most common length that can be cut into ``parts``, the smaller of equally common ones."""
    size = F.size(vector)
    found = (
        kept.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).count()
        .agg(F.max_by("size", F.struct("count", -F.col("size"))).alias("size")).first()
    )
    return found["size"]


def encode(df: DataFrame, books: Books | None, vector: str = "embedding", keep: Sequence[str] = ("vec_id", "label")) -> DataFrame:
    """The ``keep`` columns, ``code`` (two hex digits a part) and ``error`` of every kept row.

    Rows whose vector is null, or holds a null or non-finite component, go; so do vectors of
    another length than the codebooks are for.  Repeated rows each get their code; an empty table,
    or no codebooks, gives no rows.  An error beyond 64 bits counts as the largest long.
    """
    columns = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(vector).alias("vector"))
    kinds = ", ".join(f"k{i} {columns.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    length = books.width * len(books.entries) if books else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, "vector", length):
            index, distance, _ = books.assign(x)
            code = [bytes(row).hex() for row in index.astype(np.uint8)]
            error = [min(int(e), LONGEST) for e in distance.sum(1)]
            held = [part.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(code, pa.string()), pa.array(error, pa.int64())],
                [*[f"k{i}" for i in range(len(keep))], "code", "error"],
            )

    if books is None:
        coded = columns.where(F.lit(False)).withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}).drop("vector")
    else:
        coded = _kept(columns, "vector").where(F.size("vector") == length).mapInArrow(
            run, f"{kinds}, code string, error long"
        )
    return coded.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "code", "error")


def decode(codes: DataFrame, books: Books, code: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the vector that each code stands for, as doubles."""
    tables = [[[c / SCALE for c in entry] for entry in part] for part in books.entries]
    at = [F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") + 1 for p in range(len(tables))]
    parts = [F.element_at(F.lit(table), i) for table, i in zip(tables, at, strict=True)]
    return codes.withColumn("decoded", F.concat(*parts))


def with_group_error(coded: DataFrame, group: str, name: str = "label_error") -> DataFrame:
    """``coded`` with its ``error`` summed over the rows of equal ``group`` (nulls together).

    Groups with more than 1 / ``HOT`` of all rows, at most ``HOT`` of them, are joined by broadcast;
    the others have no hot key left.
    """
    coded = written_copy(coded, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    sums = written_copy(
        coded.groupBy(F.col(group).alias("_g")).agg(total.cast("long").alias(name), F.count("*").alias("_n")), "group_sums"
    )
    rows = coded.count()
    hot = F.broadcast(sums.where(F.col("_n") * HOT > rows).drop("_n"))
    cold = sums.where(F.col("_n") * HOT <= rows).drop("_n")
    same = coded[group].eqNullSafe(F.col("_g"))
    apart = coded.join(hot, same, "left_anti")
    rest = apart.join(cold, apart[group].eqNullSafe(cold["_g"]))
    return coded.join(hot, same).unionByName(rest).drop("_g")


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (
  SELECT r, vec_id, label, CAST((i - 1) // (len(e) // 16) AS INTEGER) AS p, (i - 1) % (len(e) // 16) AS d,
    CAST(floor(256 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM v)),
s AS (SELECT r, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS k FROM v),
b0 AS (SELECT p, k, d, x FROM c JOIN s USING (r) WHERE k < 64),
{rounds}
a AS (
  SELECT r, p, arg_min(k, e * 64 + k) AS k, min(e) AS e
  FROM (SELECT c.r, c.p, b.k, sum((c.x - b.x) * (c.x - b.x)) AS e FROM c JOIN b2 b USING (p, d) GROUP BY ALL)
  GROUP BY ALL),
o AS (SELECT r, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(e) AS BIGINT) AS error
      FROM a GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, d)) FROM b2) AS codebooks_sha256
FROM v JOIN o USING (r)
"""
_ROUND = """a{i} AS (
  SELECT r, p, arg_min(k, e * 64 + k) AS k
  FROM (SELECT c.r, c.p, b.k, sum((c.x - b.x) * (c.x - b.x)) AS e FROM c JOIN b{i} b USING (p, d) GROUP BY ALL)
  GROUP BY ALL),
m{i} AS (SELECT p, k, d, CAST(sum(x) AS HUGEINT) AS t, count(*) AS n FROM a{i} JOIN c USING (r, p) GROUP BY ALL),
b{j} AS (SELECT b.p, b.k, b.d, CAST(CASE WHEN n IS NULL THEN b.x ELSE (t - ((t % n) + n) % n) // n END AS BIGINT) AS x
  FROM b{i} b LEFT JOIN m{i} USING (p, k, d)),"""
SQL = SQL.replace("{rounds}", "\n".join(_ROUND.replace("{i}", str(i)).replace("{j}", str(i + 1)) for i in range(ROUNDS)))
