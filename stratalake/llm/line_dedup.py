"""Line de-duplication: lines that many documents share stay in one of them.

A line's *key* is the line without blanks at its ends, A-Z lower-cased.  Two Bloom filters note
the keys seen once and those seen again, each document counting once:

1. every task fills a pair of filters from its documents; the pairs are merged word by word, where
   bits that two sides have seen once count as seen again;
2. only lines found in the merged second filter, the *suspects*, are shuffled: exact groups by the
   key's text give the keys of at least ``least_docs`` documents and the document that keeps them;
3. documents that lose lines get the numbers of these lines by a join; the others never move.

A filter has at most 32 MB.  With many more lines than it was made for, more lines are suspected
and shuffled; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.bloom import Bloom, bloom, collected, places, word_count
from stratalake.llm.common import LOWER, SPACES, U64, mix, numbers, powers, ship, slices, text_bytes
from stratalake.storage import written_copy

ship(__name__)
LEAST_CHARS, LEAST_DOCS = 20, 3
CHUNK = 10  # the words of a filter are merged in chunks of 2**CHUNK
HOT = 1000  # a key with more than 1 / HOT of all suspects is joined apart
_BYTE = numbers(61, 256)
_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_BLANKS = " \t\n\x0b\x0c\r"


class Lines:
    """The keys of a batch that have at least ``least`` code points, once per row: ``row``,
    number of the first line with it, hash, and place in the lower-cased bytes."""

    def __init__(self, column: pa.Array, least: int):
        data, offsets = text_bytes(column)
        n = len(data)
        self.low = LOWER[data]
        breaks = np.flatnonzero(data == 10)
        rows = len(offsets) - 1
        row = np.concatenate([np.arange(rows), np.searchsorted(offsets, breaks, "right") - 1])
        start = np.concatenate([offsets[:-1], breaks + 1])
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        first = np.searchsorted(row, np.arange(rows))
        end = np.append(start[1:] - 1, n) if len(start) else start
        end[np.append(first[1:] - 1, len(row) - 1)[: rows]] = offsets[1:]
        solid = np.flatnonzero(~SPACES[self.low])
        a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
        kept = np.flatnonzero(b > a)
        begin, stop = solid[a[kept]], solid[b[kept] - 1] + 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long = points[stop] - points[begin] >= least
        kept, begin, stop = kept[long], begin[long], stop[long]
        power, inverse = powers(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[self.low] * power[:n], out=total[1:])
        value = mix((total[stop] - total[begin]) * inverse[begin] + (stop - begin).astype(U64))
        row, number = row[kept], kept - first[row[kept]]
        order = np.lexsort((number, value, row))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
        at = order[fresh]
        self.row, self.number, self.hash = row[at], number[at], value[at]
        self.begin, self.end = begin[at], stop[at]

    def texts(self, at: np.ndarray) -> pa.Array:
        size = self.end[at] - self.begin[at]
        cut = np.concatenate([[0], np.cumsum(size)])
        spot = np.repeat(self.begin[at] - cut[:-1], size) + np.arange(cut[-1])
        return pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(self.low[spot])
        ).cast(pa.string())


def _noted(words: int, least: int):
    """Arrow function: text -> at, once, again: the words of a task's pair of filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, again = np.zeros(words, U64), np.zeros(words, U64)
        for batch in slices(batches, "text"):
            value, times = np.unique(Lines(batch.column("text"), least).hash, return_counts=True)
            at, bits = places(value, words)
            np.bitwise_or.at(again, at[times > 1], bits[times > 1])
            order = np.argsort(at, kind="stable")
            _merge(once, again, at[order], bits[order], np.zeros(len(at), U64))
        yield from _words(once, again)

    return run


def _merge(once: np.ndarray, again: np.ndarray, at: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Add filter words (``at`` ordered; words repeat): bits seen once on two sides are seen again."""
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    for k in range(int(rank.max(initial=-1)) + 1):  # the k-th entry of every word
        pick = rank == k
        spot = at[pick]
        again[spot] |= two[pick] | (once[spot] & one[pick])
        once[spot] |= one[pick]


def _words(once: np.ndarray, again: np.ndarray, base: int = 0) -> Iterator[pa.RecordBatch]:
    used = np.flatnonzero(once)
    for a in range(0, len(used), 1 << 17):
        spot = used[a : a + (1 << 17)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(spot + base), pa.array(once[spot].view(np.int64)), pa.array(again[spot].view(np.int64))],
            ["at", "once", "again"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: words of many tasks, a chunk of the filter always in one partition, added up."""
    size = 1 << CHUNK
    chunks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        at, one, two = (batch.column(c).to_numpy() for c in ("at", "once", "again"))
        order = np.argsort(at, kind="stable")
        at, one, two = at[order], one[order].view(U64), two[order].view(U64)
        edges = np.flatnonzero(np.diff(at >> CHUNK, prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:], strict=False):
            pair = chunks.setdefault(int(at[a] >> CHUNK), (np.zeros(size, U64), np.zeros(size, U64)))
            _merge(*pair, at[a:b] & (size - 1), one[a:b], two[a:b])
    for chunk, pair in chunks.items():
        yield from _words(*pair, base=chunk * size)


def seen_again(docs: DataFrame, words: int, least: int = LEAST_CHARS) -> Bloom:
    """Filter that holds every key found in two documents or more, and others by chance."""
    kinds = "at long, once long, again long"
    parts = docs.select("text").mapInArrow(_noted(words, least), kinds)
    merged = parts.repartition(F.shiftright("at", CHUNK)).mapInArrow(_merged, kinds)
    return collected(merged.where("again != 0").select("at", F.col("again").alias("bits")), words)


def _suspects(again: Bloom, least: int, kind: str):
    """Arrow function: _a, _b, doc_id, text -> _a, _b, doc_id, line, key for suspected lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines = Lines(batch.column("text"), least)
            at = np.flatnonzero(again.has(lines.hash))
            row = pa.array(lines.row[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(row) for c in ("_a", "_b", "doc_id")), pa.array(lines.number[at]), lines.texts(at)],
                ["_a", "_b", "doc_id", "line", "key"],
            )

    return run, f"_a long, _b long, doc_id {kind}, line long, key string"


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: drops the lines whose key is that of one of the numbered lines."""
    for batch in slices(batches, "text"):
        count, dropped, texts = [], [], []
        for text, numbers_ in zip(batch.column("text").to_pylist(), batch.column("lines").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            keys = [line.strip(_BLANKS).translate(_FOLD) for line in lines]
            gone = {keys[k] for k in numbers_}
            kept = [line for line, key in zip(lines, keys, strict=True) if key not in gone]
            count.append(len(lines))
            dropped.append(len(lines) - len(kept))
            texts.append("\n".join(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"],
        )


def _row_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")


def dedup_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, words: int | None = None
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the remaining text of every row of ``docs``.

    Keys of at least ``least_chars`` code points found in at least ``least_docs`` rows lose all
    their lines, except in rows with the largest doc_id holding the key (null is the smallest).
    Null and empty texts are one empty line.  Rows are documents: repeated rows count one by one
    and each get their result, and rows that share the largest doc_id all keep the line.  Other
    columns are ignored; an empty table gives no rows.  ``words`` is the size of the filters, by
    default in proportion to the bytes of all texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    if words is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
        words = word_count(size // (least_chars + 1))  # no more such lines than that
    again = seen_again(docs, words, least_chars)
    keyed = docs.select(_row_key(7).alias("_a"), _row_key(8).alias("_b"), "doc_id", "text")
    suspects = written_copy(keyed.mapInArrow(*_suspects(again, least_chars, kind)), "suspect_lines")
    shared = written_copy(
        suspects.groupBy("key")
        .agg(F.count("*").alias("_n"), F.max("doc_id").alias("_keeper"))
        .where(F.col("_n") >= least_docs),
        "shared_lines",
    )
    rows = suspects.count()
    # At most HOT keys are in more than 1 / HOT of the suspects: they are known by digest in every
    # task, and the join of the others has no hot key.
    digest = F.sha2("key", 256)
    hot = F.broadcast(shared.where(F.col("_n") * HOT > rows).select(digest.alias("_sha"), "_keeper"))
    cold = shared.where(F.col("_n") * HOT <= rows).select("key", "_keeper")
    told = suspects.withColumn("_sha", digest)
    lose = ~F.col("doc_id").eqNullSafe(F.col("_keeper"))
    dropped = (
        told.join(hot, "_sha").where(lose).select("_a", "_b", "line")
        .unionByName(told.join(hot, "_sha", "left_anti").join(cold, "key").where(lose).select("_a", "_b", "line"))
    )
    lists = written_copy(dropped.groupBy("_a", "_b").agg(F.collect_set("line").alias("lines")), "dropped_lines")
    losing = bloom(lists, "_a", lists.count())

    @F.pandas_udf("boolean")
    def may_lose(key: pd.Series) -> pd.Series:
        return pd.Series(losing.has(key.to_numpy().view(U64)))

    text = F.coalesce("text", F.lit(""))
    whole = keyed.where(~may_lose("_a")).select(
        "doc_id",
        (F.regexp_count(text, F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        text.alias("text"),
    )
    none = F.expr("cast(array() as array<long>)")
    cut = (
        keyed.where(may_lose("_a"))
        .join(lists, ["_a", "_b"], "left")
        .select("doc_id", "text", F.coalesce("lines", none).alias("lines"))
        .mapInArrow(_shortened, f"doc_id {kind}, n_lines long, n_dropped long, text string")
    )
    return whole.unionByName(cut)


SQL = """
WITH l AS (
  SELECT r, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
k AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT r) >= 3),
m AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id IS DISTINCT FROM keeper AS gone FROM l LEFT JOIN k USING (key))
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
