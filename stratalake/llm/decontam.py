"""Benchmark passages in documents: a prefix-filtered set join with exact verification.

A benchmark item is its set of *windows*: runs of ten words, or the whole item if it has fewer.
A window is a set of word shingles with positions.  A document holds a window only if it holds
every shingle, so it must hold the window's rarest one, its *prefix token*: with containment 1
a prefix of one token is necessary and enough.  Rarity is counted over all documents.

Each pass over the documents looks up their shingles among the prefix tokens, places the window
by the token's offset (positional bound), drops windows that would leave the document (length
bound), and compares the remaining candidates word by word.

The windows travel to the tasks in blocks of about ``BLOCK`` windows, so what is broadcast has a
bound at any benchmark size; a larger benchmark means more passes, never fewer windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import (
    LOWER,
    NOT_ALNUM,
    U64,
    mix,
    numbers,
    ship,
    slices,
    text_bytes,
    windows,
    words,
)
from stratalake.storage import written_copy

ship(__name__)
WINDOW, SHINGLE, BLOCK = 10, 3, 100_000
HOT = 1000  # a list of items that more than 1 / HOT of the documents have is joined apart


def _item_windows(size: int):
    """Arrow function: item_id, text -> item_id, window (its words, blank-separated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            w = words(data, offsets, NOT_ALNUM)
            low = LOWER[data].tobytes()
            spelled = [low[a:b].decode() for a, b in zip(w.start, w.end, strict=True)]
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = int(w.first[i]), int(w.first[i + 1])
                last = max(b - size, a) if b > a else a - 1
                for begin in range(a, last + 1, 10_000):
                    out = [
                        " ".join(spelled[k : min(k + size, b)])
                        for k in range(begin, min(begin + 10_000, last + 1))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(out)), pa.array(out)], ["item_id", "window"]
                    )

    return run


class _Block:
    """The windows of one block, with the shingles of each by position."""

    def __init__(self, texts: list[str], sets: list[int]):
        self.text = [t.encode() for t in texts]
        self.sets = np.array(sets, np.int64)
        data = np.frombuffer(b"".join(self.text), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.text])]).astype(np.int64)
        w = words(data, offsets, NOT_ALNUM)
        self.length = w.count
        self.hash = np.zeros(len(texts), U64)
        none = np.zeros(0, np.int64)
        self.token, self.offset, self.owner, self.size = [none.view(U64)], [none], [none], [none]
        for length in np.unique(self.length):
            rows = np.flatnonzero(self.length == length)
            weights = numbers(1000 + int(length), int(length))
            at = w.first[rows]
            self.hash[rows] = mix(sum(w.hash[at + j] * weights[j] for j in range(length)))
            size = min(SHINGLE, int(length))
            weights = numbers(1000 + size, size)
            for o in range(int(length) - size + 1):
                self.token.append(mix(sum(w.hash[at + o + j] * weights[j] for j in range(size))))
                self.offset.append(np.full(len(rows), o))
                self.owner.append(rows)
                self.size.append(np.full(len(rows), size))
        self.token, self.offset, self.owner, self.size = map(
            np.concatenate, (self.token, self.offset, self.owner, self.size)
        )

    def keep_rarest(self, counts: dict[int, int]) -> None:
        """Keep one token per window: the rarest over all documents."""
        rarity = np.array([counts.get(t, 0) for t in self.token.view(np.int64).tolist()])
        order = np.lexsort((self.token, rarity, self.owner))
        _, first = np.unique(self.owner[order], return_index=True)
        chosen = order[first]
        chosen = chosen[np.argsort(self.token[chosen], kind="stable")]
        for name in ("token", "offset", "owner", "size"):
            setattr(self, name, getattr(self, name)[chosen])


def _counts(tokens: np.ndarray, sizes: list[int]):
    """Arrow function: text -> how often each of ``tokens`` occurs in the rows of a task."""
    tokens = np.unique(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in slices(batches, "text"):
            w = words(*text_bytes(batch.column("text")), NOT_ALNUM)
            for size in sizes:
                _, value = windows(w, size)
                at = np.searchsorted(tokens, value)
                at[at == len(tokens)] = 0
                total += np.bincount(at[tokens[at] == value], minlength=len(tokens))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[seen].view(np.int64)), pa.array(total[seen])], ["token", "n"]
        )

    return run


def _marked(block: _Block, last: bool):
    """Arrow function: adds the block's hits to ``_marks`` (begin, end, ... of word runs) and
    ``_sets``; the last pass replaces text and marks by counts."""

    def find(w, low):
        """(row, begin, end, set) of every verified window."""
        found = []
        for size in np.unique(block.size):
            mine = np.flatnonzero(block.size == size)  # ordered by token
            tokens, first = np.unique(block.token[mine], return_index=True)
            ends = np.append(first[1:], len(mine))
            at, value = windows(w, int(size))
            k = np.searchsorted(tokens, value)
            k[k == len(tokens)] = 0
            hit = tokens[k] == value
            at, k = at[hit], k[hit]
            times = (ends - first)[k]
            place = np.repeat(np.arange(len(at)), times)
            entry = mine[first[k][place] + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)]
            begin = at[place] - block.offset[entry]
            window = block.owner[entry]
            end = begin + block.length[window]
            row = w.row[at[place]]
            inside = (begin >= w.first[row]) & (end <= w.first[row + 1])
            for length in np.unique(block.length[window[inside]]):
                pick = np.flatnonzero(inside & (block.length[window] == length))
                weights = numbers(1000 + int(length), int(length))
                value = mix(sum(w.hash[begin[pick] + j] * weights[j] for j in range(length)))
                for i in pick[value == block.hash[window[pick]]]:
                    spelled = b" ".join(
                        low[a:b]
                        for a, b in zip(
                            w.start[begin[i] : end[i]], w.end[begin[i] : end[i]], strict=True
                        )
                    )
                    if spelled == block.text[window[i]]:
                        found.append((row[i], begin[i], end[i], window[i]))
        return np.array(found, np.int64).reshape(-1, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            w = words(data, offsets, NOT_ALNUM)
            found = find(w, LOWER[data].tobytes())
            marks = batch.column("_marks").to_pylist()
            sets = batch.column("_sets").to_pylist()
            step = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(step, found[:, 1], 1)
            np.add.at(step, found[:, 2], -1)
            for i, known in enumerate(marks):
                for a, b in zip(known[::2], known[1::2], strict=True):
                    step[w.first[i] + a] += 1
                    step[w.first[i] + b] -= 1
            # Runs may touch at the border of two rows, so each row is summed on its own.
            hit = np.cumsum(step)[:-1] > 0
            n_hit = np.bincount(w.row[hit], minlength=batch.num_rows)
            by_row: dict[int, set[int]] = {}
            for row, window in found[:, [0, 3]]:
                by_row.setdefault(int(row), set()).add(int(block.sets[window]))
            sets = [sorted({*s, *by_row.get(i, ())}) for i, s in enumerate(sets)]
            columns = {"doc_id": batch.column("doc_id")}
            if last:
                columns["n_words"] = pa.array(w.count.astype(np.int64))
                columns["n_hit"] = pa.array(n_hit.astype(np.int64))
            else:
                columns["text"] = batch.column("text")
                for i in np.flatnonzero(n_hit):
                    runs = np.flatnonzero(
                        np.diff(np.concatenate([[0], hit[w.first[i] : w.first[i + 1]], [0]]).astype(int))
                    )
                    marks[i] = runs.tolist()
                columns["_marks"] = pa.array(marks, pa.list_(pa.int64()))
            columns["_sets"] = pa.array(sets, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters, lower-cased over A-Z.  Null and
    empty texts have no words.  Items without words or with a null item_id have no windows;
    equal items count one by one.  Repeated rows each get their own result.  Other columns are
    ignored; an empty table on either side gives no rows or no hits.
    """
    parts = written_copy(
        benchmark.where("item_id is not null")
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
        .mapInArrow(_item_windows(window), "item_id string, window string")
        .distinct(),
        "windows",
    )
    # Windows with the same items share one set id, made without gathering the items.
    item = F.xxhash64("item_id")
    known = written_copy(
        parts.groupBy("window")
        .agg(F.xxhash64(F.count("*"), F.bit_xor(item), F.sum(item.cast("decimal(38,0)"))).alias("set"))
        , "sets"
    )
    members = parts.join(known, "window").select("set", "item_id").distinct()
    n_blocks = max(1, -(-known.count() // block))
    found = docs.select(
        "doc_id",
        "text",
        F.expr("cast(array() as array<long>)").alias("_marks"),
        F.expr("cast(array() as array<long>)").alias("_sets"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    for k in range(n_blocks):
        rows = known.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k).collect()
        part = _Block([r["window"] for r in rows], [r["set"] for r in rows])
        if rows:
            sizes = sorted(set(part.size.tolist()))
            counted = (
                docs.select("text")
                .mapInArrow(_counts(part.token, sizes), "token long, n long")
                .groupBy("token")
                .agg(F.sum("n"))
                .collect()
            )
            part.keep_rarest(dict(counted))
        last = k == n_blocks - 1
        kept = "n_words long, n_hit long" if last else "text string, _marks array<long>"
        found = found.mapInArrow(
            _marked(part, last), f"doc_id {id_type}, {kept}, _sets array<long>"
        )
    found = written_copy(found, "found")
    has = F.size("_sets") > 0
    keyed = found.where(has).withColumn("_key", F.xxhash64("_sets"))
    # One row per list of sets, with the number of documents that have it.
    lists = keyed.groupBy("_key", "_sets").agg(F.count("*").alias("_rows"))
    listed = written_copy(
        lists.withColumn("set", F.explode("_sets"))
        .join(members, "set")
        .groupBy("_key", "_rows")
        .agg(F.sort_array(F.collect_set("item_id")).alias("_items"))
        .select(
            "_key",
            "_rows",
            F.size("_items").cast("long").alias("_n"),
            F.sha2(F.concat_ws(",", "_items"), 256).alias("_sha"),
        ),
        "lists",
    )
    total = found.count()
    # At most HOT lists are those of more than 1 / HOT of the documents: they are broadcast.
    hot = F.broadcast(listed.where(F.col("_rows") * HOT > total).drop("_rows"))
    cold = listed.where(F.col("_rows") * HOT <= total).drop("_rows")
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of ""
    kept = ["doc_id", "n_words", "n_hit", "_n", "_sha"]
    clean = found.where(~has).withColumns({"_n": F.lit(0).cast("long"), "_sha": F.lit(nothing)})
    return (
        clean.select(kept)
        .unionByName(keyed.join(hot, "_key").select(kept))
        .unionByName(keyed.join(hot, "_key", "left_anti").join(cold, "_key").select(kept))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.col("_n").alias("n_items"),
            F.col("_sha").alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, w, least(10, len(w)) AS l FROM (SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS win
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM b)),
dw AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS win
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
h AS (SELECT r, i, l, item_id FROM dw JOIN bw USING (l, win)),
p AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + l)) AS x FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS list
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
