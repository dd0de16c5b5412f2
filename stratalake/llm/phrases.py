"""Phrase collocations by Rabin-Karp fingerprints.

Texts are cut at punctuation into pieces, pieces at blanks into words; a phrase is a run of words
within a piece.  The lower-cased words of a batch are laid out with one blank between them, and the
prefix sums of a polynomial over these bytes give the fingerprint of every run by a subtraction.

* One pass per length counts fingerprints in Spark; from four words on, one pass counts two lengths.
  A phrase is frequent only if its first and its last words but one are, so a pass looks up the
  frequent shorter phrases of the pass before in a Bloom filter and counts nothing else.
* The last pass follows the fingerprints that may be frequent back to the text: in every batch the
  occurrences of a fingerprint are compared, word by word, with the one its group points at, so
  two phrases that share a fingerprint are told apart, and the phrase is spelled once per batch.
  Spark adds up the spelled phrases: these counts are exact, and only frequent phrases are ever text.

Scores take the least surprising cut of a phrase into two parts, in exact arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.bloom import Bloom, bloom
from stratalake.llm.common import LOWER, U64, byte_set, mix, numbers, powers, ship, slices, text_bytes
from stratalake.storage import written_copy

ship(__name__)
LONGEST, LEAST, TOP = 5, 100, 2000  # words of a phrase at most; occurrences at least; phrases a language
SEGMENT = 1 << 20  # bytes of a long text handled at a time
BUFFER = 1 << 22  # fingerprints a task adds up before it hands them on
HANDED = 1 << 18  # rows handed on at a time
SALTS, PARTS = 8, 32  # copies of counts that parts of phrases meet; parts in which a language is ranked
BLANK = byte_set((0x20, 0x20), (0x09, 0x09))
BREAK = byte_set((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
_APART = BLANK | BREAK
_BYTE = numbers(71, 256)


def segments(data: np.ndarray, limit: int = SEGMENT, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of one long text and how many of their bytes are their own.  A part goes on for the
    ``longest`` - 1 words that phrases beginning in its own bytes may reach."""
    inside = ~_APART[data]
    ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    a = 0
    while a < len(data):
        k = int(np.searchsorted(ends, a + limit))
        if k + longest > len(ends):
            yield data[a:], len(data) - a
            return
        yield data[a : ends[k + longest - 1]], int(ends[k]) - a
        a = int(ends[k])


class Runs:
    """The words of some texts and the fingerprints of their runs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, own: int | None = None):
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_APART[data]
        edge = np.zeros(n + 1, bool)  # a text begins here
        edge[offsets] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        self.row = np.searchsorted(offsets, start, "right") - 1
        self.piece = np.concatenate([[0], np.cumsum(BREAK[data])])[start] + self.row
        self.own = len(start) if own is None else int(np.searchsorted(start, own))
        size = end - start
        self.begin = np.cumsum(size + 1) - (size + 1)
        self.end = self.begin + size
        self.laid = np.full(int((size + 1).sum()), 0x20, np.uint8)
        spot = np.repeat(start - self.begin, size + 1) + np.arange(len(self.laid))
        word = np.ones(len(self.laid), bool)
        word[self.end] = False
        self.laid[word] = LOWER[data[spot[word]]]
        power, self.inverse = powers(len(self.laid) + 1)
        self.total = np.zeros(len(self.laid) + 1, U64)
        np.cumsum(_BYTE[self.laid] * power[: len(self.laid)], out=self.total[1:])
        self.seeds = seeds

    def of(self, length: int, below: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of the runs of ``length`` words; with ``below``, of those
        whose two shorter runs are marked in it (by first word)."""
        n = len(self.begin)
        if n < length:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        keep = self.piece[: n - length + 1] == self.piece[length - 1 :]
        if below is not None:
            keep &= below[: n - length + 1] & below[1 : n - length + 2]
        at = np.flatnonzero(keep)
        first = self.begin[at]
        value = (self.total[self.end[at + length - 1]] - self.total[first]) * self.inverse[first]
        return at, mix(value + self.seeds[self.row[at]])

    def marked(self, length: int, frequent: Bloom) -> np.ndarray:
        """By first word: does a run of ``length`` words begin here that may be frequent?"""
        at, value = self.of(length)
        return self.marks(at[frequent.has(value)])

    def marks(self, at: np.ndarray) -> np.ndarray:
        """By first word: is it among ``at``?"""
        out = np.zeros(len(self.begin) + 1, bool)
        out[at] = True
        return out

    def ids(self) -> np.ndarray:
        """Numbers that are equal for equal words."""
        cut = np.append(self.begin, len(self.laid)).astype(np.int64)
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.begin), [None, pa.py_buffer(cut), pa.py_buffer(self.laid)]
        )
        return spelled.dictionary_encode().indices.to_numpy()

    def spelled(self, at: np.ndarray, length: int) -> pa.Array:
        first = self.begin[at]
        size = self.end[at + length - 1] - first
        cut = np.concatenate([[0], np.cumsum(size)])
        spot = np.repeat(first - cut[:-1], size) + np.arange(cut[-1])
        return pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(self.laid[spot])
        ).cast(pa.string())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Runs, np.ndarray, list[str]]]:
    """The runs of every slice, with the number of each row's language and the languages."""
    for batch in slices(batches, "text"):
        coded = batch.column("lang").dictionary_encode()
        langs = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy()
        data, offsets = text_bytes(batch.column("text"))
        seeds = _seeds(langs)[code]
        if len(data) <= 2 * SEGMENT:
            yield Runs(data, offsets, seeds), code, langs
            continue
        for i in range(batch.num_rows):
            for part, own in segments(data[offsets[i] : offsets[i + 1]]):
                yield Runs(part, np.array([0, len(part)]), seeds[i : i + 1], own), code[i : i + 1], langs


def _seeds(langs: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array(langs, pa.string()))
    power, _ = powers(len(data) + 1)
    return mix(np.array([(_BYTE[data[a:b]] * power[: b - a]).sum() for a, b in zip(offsets, offsets[1:], strict=False)], U64))


def _handed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, HANDED):
        yield batch.slice(a, HANDED)


def _added(held: list[np.ndarray]) -> pa.RecordBatch:
    """Every fingerprint once, with its number; empties ``held``."""
    value = np.concatenate(held)
    held.clear()
    value.sort()
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
    count = np.diff(np.append(first, len(value)))
    return pa.RecordBatch.from_arrays([pa.array(value[first].view(np.int64)), pa.array(count)], ["print", "n"])


def _counted(lengths: list[int], frequent: Bloom | None):
    """Arrow function: lang, text -> print, n of the runs of ``lengths`` words that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for runs, _, _ in _runs(batches):
            below = runs.marked(lengths[0] - 1, frequent) if frequent else None
            for length in lengths:
                at, value = runs.of(length, below)
                below = runs.marks(at)
                held.append(value[at < runs.own])
                size += len(held[-1])
            if size > BUFFER:
                yield from _handed(_added(held))
                size = 0
        if size:
            yield from _handed(_added(held))

    return run


def _grouped(runs: Runs, at: np.ndarray, value: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First words of one run for each different phrase among ``at``, and how many are equal to it.

    Runs with one fingerprint are compared with the run their group points at; ``parts`` are the
    numbers that make a phrase: its language and its words."""
    order = np.argsort(value)
    at, value, parts = at[order], value[order], [p[order] for p in parts]
    fresh = np.append(True, value[1:] != value[:-1])[: len(at)]
    group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    if not all((p == p[first][group]).all() for p in parts):  # a collision
        order = np.lexsort(parts[::-1])
        at, parts = at[order], [p[order] for p in parts]
        fresh = np.append(True, np.any([p[1:] != p[:-1] for p in parts], axis=0))[: len(at)]
        first = np.flatnonzero(fresh)
    return at[first], np.diff(np.append(first, len(at)))


def _spelled(frequent: list[Bloom]):
    """Arrow function: lang, text -> lang, phrase, n of the runs that may be frequent, by length;
    the number of all words under a null phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, code, langs in _runs(batches):
            if not runs.own:
                continue
            ids, spoken = runs.ids(), code[runs.row]
            words = np.bincount(spoken[: runs.own], minlength=len(langs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.nulls(len(langs), pa.string()), pa.array(words.astype(np.int64))],
                ["lang", "phrase", "n"],
            )
            below = None
            for length, known in enumerate(frequent, 1):
                at, value = runs.of(length, below)
                may = known.has(value)
                at, value = at[may], value[may]
                below = runs.marks(at)
                at, value = at[at < runs.own], value[at < runs.own]
                lead, count = _grouped(runs, at, value, [spoken[at], *[ids[at + j] for j in range(length)]])
                lang = pa.array(langs, pa.string()).take(pa.array(spoken[lead]))
                yield pa.RecordBatch.from_arrays(
                    [lang, runs.spelled(lead, length), pa.array(count.astype(np.int64))], ["lang", "phrase", "n"]
                )

    return run


def _passes(longest: int) -> list[list[int]]:
    """The lengths that are counted in one pass over the texts."""
    short = min(longest, 3)
    return [[m] for m in range(1, short + 1)] + [[*range(m, min(m + 1, longest) + 1)] for m in range(4, longest + 1, 2)]


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, n: every phrase of 1 to ``longest`` words with ``least`` occurrences or more in
    its language; and, under a null phrase, the number of words of every language that has any."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    blooms: list[Bloom] = []
    for lengths in _passes(longest):
        found = written_copy(
            texts.mapInArrow(_counted(lengths, blooms[-1] if blooms else None), "print long, n long")
            .groupBy("print")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least)
            .select("print"),
            f"frequent_{lengths[0]}",
        )
        count = found.count()
        if not count:
            break
        blooms += [bloom(found, "print", count)] * len(lengths)
    spelled = texts.mapInArrow(_spelled(blooms), "lang string, phrase string, n long")
    counted = spelled.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return written_copy(counted.where((F.col("phrase").isNull() & (F.col("n") > 0)) | (F.col("n") >= least)), "phrases")


def _part(first: str, size: str):
    return F.expr(f"array_join(slice(w, {first}, {size}), ' ')")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of two words or more that no longer phrase of
    the table with the same count holds."""
    texts = phrases.where("phrase is not null").withColumn("w", F.split("phrase", " ")).withColumn("m", F.size("w"))
    words = phrases.where("phrase is null").select("lang", F.col("n").alias("_words"))
    # A phrase occurs in any longer one, so counts only fall: if a longer phrase has the same count,
    # so has one that is a single word longer.
    longer = texts.where("m > 2")
    inner = F.explode(F.array(_part("1", "m - 1"), _part("2", "m - 1"))).alias("phrase")
    covered = longer.select("lang", "n", inner).distinct()
    whole = texts.where("m > 1").join(covered, ["lang", "phrase", "n"], "left_anti")
    # Cuts: many phrases share a part, so the keys are salted and the (few) counts repeated.
    salted = phrases.where("phrase is not null").select("lang", "phrase", "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    cuts = (
        whole.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
        .withColumn("k", F.explode(F.expr("sequence(1, m - 1)")))
        .withColumns({"x": _part("1", "k"), "y": _part("k + 1", "m - k")})
        .join(salted.select("lang", "salt", F.col("phrase").alias("x"), F.col("n").alias("l")), ["lang", "salt", "x"])
        .join(salted.select("lang", "salt", F.col("phrase").alias("y"), F.col("n").alias("r")), ["lang", "salt", "y"])
        .join(words, "lang")
    )
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("l", "r")}
    product = F.col("n").cast("decimal(38,0)") * F.lit(1000).cast("decimal(38,0)") * F.col("_words").cast("decimal(38,0)")
    cuts = cuts.withColumns({"_product": product, "_parts": wide["l"] * wide["r"]})
    best = cuts.withColumn("score", F.expr("cast(_product div _parts as bigint)")).groupBy("lang", "phrase", "n", "_words")
    return best.agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select(
        "lang", "phrase", F.col("n").alias("a"), "s.l", "s.r", F.col("_words").alias("n"), "s.score"
    )


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language by score, then count, then the phrase itself.

    lang, rank, phrase, a (its occurrences), l and r (those of the parts of its least surprising
    cut), n (words of the language), score = floor(1000 a n / (l r)).

    Words are lower-cased over A-Z.  A null lang is ``und``; null and empty texts have no words;
    repeated rows count each time; other columns are ignored; an empty table gives no rows.
    """
    best = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # The best of a language are among the best of its parts: no task ranks more than PARTS * top.
    found = scored(frequent_phrases(docs, longest, least)).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    of_part = Window.partitionBy("lang", "_part").orderBy(*best)
    found = found.withColumn("_place", F.row_number().over(of_part)).where(F.col("_place") <= top)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, array_to_string(w[j:j + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS j FROM w, unnest(range(1, 6)) u(m) WHERE len(w) >= m)
  GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE m >= 2 AND f >= 100),
k AS (
  SELECT *, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (
  SELECT k.lang, k.m, k.phrase, a, b.f AS l, e.f AS r, n,
    (1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (b.f::HUGEINT * e.f::HUGEINT) AS score
  FROM k JOIN g b ON b.lang = k.lang AND b.phrase = x JOIN g e ON e.lang = k.lang AND e.phrase = y
  JOIN t ON t.lang = k.lang
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM s WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.lang = s.lang AND c.m > s.m AND 100 * c.a >= 100 * s.a
    AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))
QUALIFY rank <= 2000
"""
