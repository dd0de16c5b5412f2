"""Shards of nearly equal size by a histogram sort, in DataFrame operations only.

Rows are ordered by a 64-bit key.  For every border between shards, the bytes below candidate
keys are counted exactly over all partitions; the candidates then close in on the key at which
the wanted share of bytes lies, until the error is within the tolerance or the border is exact.
Only then are rows exchanged, once, by ranges that are as fine as a task should be large.

The key starts with a hash of doc_id and text and ends with bits that differ between equal rows,
so a group of copies or a repeated id, however large, is spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.storage import written_copy

SHARDS, STEP, RANGE_ROWS = 40, 12, 100_000
OVERHEAD = 16  # bytes counted for every row besides its text



def splitters(keyed: DataFrame, shards: int, tolerance: float) -> tuple[list[int], int, int]:
    """Keys at which shards 1, 2, ... begin, and the number of rows and bytes.

    ``keyed`` has ``_key`` (0 <= key < 2**60) and ``size``.  Each round counts bytes and rows
    between 2**STEP probes of every open border in one pass; at most ``shards * 2**STEP`` counts
    reach the driver, whatever the input.
    """
    rows, total = keyed.agg(F.count("*"), F.sum("size")).first()
    if not rows:
        return [], 0, 0
    wanted = [total * i / shards for i in range(1, shards)]
    slack = max(1.0, tolerance * total / shards)
    bits = 60 - STEP
    low = dict.fromkeys(range(shards - 1), 0)  # border -> low end of the interval that holds it
    below = dict.fromkeys(range(shards - 1), 0)  # bytes below that low end
    found: dict[int, int] = {}
    while low:
        starts = sorted(set(low.values()))
        width = 1 << (bits + STEP)
        interval = F.col("_key").bitwiseAND(F.lit(-width))
        counts = (
            keyed.where(interval.isin(starts))
            .groupBy(interval.alias("low"), F.shiftrightunsigned("_key", bits).alias("probe"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        cells: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(counts, key=lambda r: r["probe"]):
            cells.setdefault(r["low"], []).append((r["probe"] << bits, r["bytes"]))
        for border in list(low):
            at, seen = low[border], below[border]
            best = (abs(seen - wanted[border]), at)
            inner = None
            for probe, size in cells[at]:
                if seen <= wanted[border] < seen + size:
                    inner = (probe, seen)
                best = min(best, (abs(seen - wanted[border]), probe))
                seen += size
                best = min(best, (abs(seen - wanted[border]), probe + (1 << bits)))
            if best[0] <= slack or bits == 0 or inner is None:
                found[border] = best[1]
                del low[border]
            else:
                low[border], below[border] = inner
        bits = max(0, bits - STEP)
    borders = [found[i] for i in range(shards - 1)]
    for i in range(1, len(borders)):
        borders[i] = max(borders[i], borders[i - 1])
    return borders, rows, total


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = 0.001) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    The law is ``bytes``: sizes differ from the mean by at most the tolerance or about one row.
    Null and empty texts count ``OVERHEAD`` bytes and have checksum 0.  Equal rows and null ids
    are spread like others.  Slots count the rows of a shard from 0 in key order.  More shards
    than rows leave shards empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 20) - 1))
    head = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(((1 << 60) - 1) ^ ((1 << 20) - 1)))
    keyed = written_copy(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            head.bitwiseOR(tie).alias("_key"),
        ),
        "shard-keys",
    )
    borders, rows, _ = splitters(keyed, shards, tolerance)
    number = F.lit(0)
    for border in borders:
        number = number + (F.col("_key") >= F.lit(border)).cast("int")
    fine = max(1, (max(rows, 1) // RANGE_ROWS)).bit_length() + 6  # 64 ranges or more
    placed = keyed.withColumn("shard", number).withColumn(
        "_range", F.shiftrightunsigned("_key", 60 - min(fine, 40))
    )
    counts = placed.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("shard", "_range").orderBy("_key", "doc_id", "text_crc32")
    return (
        placed.withColumn("_at", F.row_number().over(within))
        .join(before, ["shard", "_range"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
