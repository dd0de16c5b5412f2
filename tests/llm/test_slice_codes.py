"""Slice-and-intersect vector codes against comparison with every entry."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import slice_codes as sc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, key int, k0 string, _g int, error long"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error) by brute force over Python integers, and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    whole = [[math.floor(c * 256) if abs(c) < 2.0**60 else int(c) * 256 for c in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    w = len(whole[0]) // parts
    cut = [[x[p * w : (p + 1) * w] for p in range(parts)] for x in whole]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for x in cut:
            d = [[sum((a - b) ** 2 for a, b in zip(x[p], e)) for e in books[p]] for p in range(parts)]
            out.append([(min(row), row.index(min(row))) for row in d])
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [x[p] for x, a in zip(cut, got) if a[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    coded = [("".join(f"{e:02x}" for _, e in a), min(sum(d for d, _ in a), sc.LONGEST)) for a in got]
    return sorted(((r[0], *c) for r, c in zip(kept, coded)), key=repr), books


def coded(df):
    books = sc.fit(df)
    return sorted(((r["vec_id"], r["code"], r["error"]) for r in sc.encode(df, books).collect()), key=repr), books


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_masks_find_the_nearest_entry(spread):
    """Few distinct coordinates make many ties; the lower index wins."""
    rng = np.random.default_rng(spread)
    for width in (1, 4, 7):
        for most in (1, 2, 63, 64):
            book, x = rng.integers(-spread, spread + 1, (most, width)), rng.integers(-2 * spread, 2 * spread, (300, width))
            distance = ((x[:, None] - book[None]) ** 2).sum(2)
            index, best = sc.Slices(book).nearest(x)
            assert (index == distance.argmin(1)).all() and (best == distance.min(1)).all()
            mask, _ = sc.Slices(book).candidates(x)
            assert (mask >> index.astype(np.uint64) & np.uint64(1)).all()


def test_few_candidates_are_compared():
    rng = np.random.default_rng(1)
    book, x = rng.normal(0, 100, (64, 4)).astype(int), rng.normal(0, 100, (2000, 4)).astype(int)
    mask, _ = sc.Slices(book).candidates(x)
    assert np.bitwise_count(mask).mean() < 16


def rows_of(n, wide=False):
    r = random.Random(n)
    rows = [(i, [r.choice([-1, 1]) * r.random() / 4 for _ in range(32)], i % 3, "c", 1, "k", 2, 5) for i in range(n)]
    rows += [(3, rows[3][1], 1, "c", 1, "k", 2, 5), (3, rows[5][1], None, "c", 1, "k", 2, 5)]  # a repeated row, a repeated id
    rows += [(None, [0.1] * 32, None, None, None, None, None, None), (n + 1, None, 1, "c", 1, "k", 2, 5)]
    rows += [(n + i, [bad, *[0.5] * 31], 1, "c", 1, "k", 2, 5) for i, bad in enumerate([None, float("nan"), float("inf"), float("-inf")])]
    if wide:
        rows += [(n + 20 + i, [c, *[-c] * 31], 1, "c", 1, "k", 2, 5) for i, c in enumerate([1e12, 3e30, 1e250, 2e12])]
    return rows


@pytest.mark.parametrize("n,wide", [(200, False), (90, True), (20, False), (20, True)])
def test_against_brute_force(spark, n, wide):
    rows = rows_of(n, wide)
    want, books = plain(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got, ours = coded(df)
    assert got == want and ours.entries == books


def test_empty_odd_lengths_and_decoding(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sc.fit(none) is None and sc.with_group_error(sc.encode(none, None), "label").count() == 0
    assert sc.fit(spark.createDataFrame([(1, [], 1), (2, [1.0], 1)], "vec_id long, embedding array<double>, label int")) is None
    rows = rows_of(30)
    other = [(900, [0.5] * 16, 1, "c", 1, "k", 2, 5), (901, [0.5] * 5, 1, "c", 1, "k", 2, 5)]
    df = spark.createDataFrame(rows + other, SCHEMA)
    got, books = coded(df)
    assert got == plain(rows)[0]  # vectors of another length than most go
    decoded = {r["vec_id"]: r["decoded"] for r in sc.decode(sc.encode(df, books), books).where("vec_id > 5").collect()}
    code = {v: c for v, c, _ in got}
    for v, x in decoded.items():
        want = [c / 256 for p in range(16) for c in books.entries[p][int(code[v][2 * p : 2 * p + 2], 16)]]
        assert x == want


def test_group_errors_with_hot_and_many_labels(spark):
    df = spark.range(4000).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("label"),
        F.lit("00").alias("code"),
        (F.col("id") * 3).alias("error"),
    )
    got = {r["vec_id"]: r["label_error"] for r in sc.with_group_error(df, "label").collect()}
    want = {}
    label = {i: 7 if i % 3 == 0 else i if i % 3 == 1 else None for i in range(4000)}
    for i in range(4000):
        want[label[i]] = want.get(label[i], 0) + 3 * i
    assert got == {i: want[label[i]] for i in range(4000)}
    most = spark.createDataFrame([(1, 1, "00", sc.LONGEST), (2, 1, "00", sc.LONGEST)], df.schema)
    assert {r["label_error"] for r in sc.with_group_error(most, "label").collect()} == {sc.LONGEST}
