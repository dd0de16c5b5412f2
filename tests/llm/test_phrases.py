"""Phrase collocations against counting by hand."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from stratalake.llm import phrases as ph
from stratalake.llm.common import U64

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, w string, rank string"


def plain(rows, least, top=2000, longest=5):
    count, words = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    count[lang, tuple(w[i : i + m])] += 1
    candidates = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in candidates.items():
        inside = any(
            lg == lang and len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (lg, q), b in candidates.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((1000 * a * words[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    got = []
    for lang, found in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            got.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(got)


def rows_of(seed, n=150):
    r = random.Random(seed)
    vocabulary = ["The", "the", "of", "and", "é", "ß", "naïve", "😀", "x y", "N", "(a)", "of-the", "'s"]
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        if r.random() < 0.5:
            words[3:3] = ["One", "fixed", "phrase", "of", "five", "words"]
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!?", "\r\n", " \x0b"]) for w in words)
        rows.append((i, text, r.choice(["en", "en", "und", None, "de"]), "p", 1, "w", "r"))
    rows += [(None, None, None, None, None, None, None), (n, "", "en", *rows[0][3:]), (n, " \t.\n", "fr", *rows[0][3:])]
    rows += [rows[4], rows[4], (n + 1, "a a a a a a a a", "de", *rows[0][3:])]
    return rows


@pytest.mark.parametrize("seed,least,top", [(1, 3, 2000), (2, 10, 5), (3, 1000, 9)])
def test_against_a_plain_version(spark, seed, least, top):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ph.collocations(df, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, least, top)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rows = rows_of(7, 40)
    long = " ".join(str(r[1]) for r in rows_of(8, 120)) * 3
    rows.append((99, long + " " + "unbroken" * 300 + " tail of the text", "en", "p", 1, "w", "r"))
    data = np.frombuffer(long.encode(), np.uint8)
    for limit in (40, 333, 10_000_000):
        starts, at = [], 0
        for part, own in ph.segments(data, limit):
            runs = ph.Runs(part, np.array([0, len(part)]), np.zeros(1, U64), own)
            for length in (1, 5):
                first, _ = runs.of(length)
                starts += [(length, bytes(runs.laid[runs.begin[i] : runs.end[i + length - 1]])) for i in first if i < runs.own]
            at += own
        whole = ph.Runs(data, np.array([0, len(data)]), np.zeros(1, U64))
        want = [
            (length, bytes(whole.laid[whole.begin[i] : whole.end[i + length - 1]]))
            for length in (1, 5) for i in whole.of(length)[0]
        ]
        assert at == len(data) and sorted(starts) == sorted(want)
    monkeypatch.setattr(ph, "SEGMENT", 500)
    got = ph.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(1), least=4)
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, 4)


def test_empty_table(spark):
    assert ph.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_colliding_fingerprints_are_told_apart():
    data = np.frombuffer(b"a b a b c d a b c d c d", np.uint8)
    runs = ph.Runs(data, np.array([0, len(data)]), np.zeros(1, U64))
    at, value = runs.of(2)
    parts = [np.zeros(len(at), int), runs.ids()[at], runs.ids()[at + 1]]
    good = ph._grouped(runs, at, value, parts)
    same = ph._grouped(runs, at, np.full(len(at), 5, U64), parts)

    def spelled(got):
        return sorted(zip(runs.spelled(got[0], 2).to_pylist(), got[1].tolist()))

    assert spelled(good) == spelled(same) == [("a b", 3), ("b a", 1), ("b c", 2), ("c d", 3), ("d a", 1), ("d c", 1)]


def test_scores_are_exact_beyond_64_bits(spark):
    r = random.Random(3)
    rows, want = [("en", None, 9 * 10**16)], {}
    for i in range(40):
        left, right = (r.randrange(10**12, 10**15) for _ in range(2))
        a = r.randrange(10**11, min(left, right))
        rows += [("en", f"x{i}", left), ("en", f"y{i}", right), ("en", f"x{i} y{i}", a)]
        want[f"x{i} y{i}"] = 1000 * a * rows[0][2] // (left * right)
    got = ph.scored(spark.createDataFrame(rows, "lang string, phrase string, n long"))
    assert {x["phrase"]: x["score"] for x in got.collect()} == want


@pytest.mark.parametrize("longest", [1, 2, 3, 4, 5, 6])
def test_lengths_counted_together_and_small_buffers(spark, monkeypatch, longest):
    for name, size in (("BUFFER", 300), ("HANDED", 7)):
        monkeypatch.setattr(ph, name, size)
    rows = rows_of(longest)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = ph.collocations(df, longest=longest, least=4)
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, 4, longest=longest)


def test_fewer_passes_than_lengths(spark, monkeypatch):
    passes, counted = [], ph._counted
    monkeypatch.setattr(ph, "_counted", lambda lengths, frequent: passes.append(lengths) or counted(lengths, frequent))
    rows = rows_of(5)
    got = ph.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(2), least=4)
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, 4) and len(passes) == 4
