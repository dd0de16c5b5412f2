"""Line de-duplication against a plain version."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import line_dedup as ld
from stratalake.llm.bloom import LEAST_WORDS, Bloom, bloom, places, word_count
from stratalake.llm.common import U64, mix

SCHEMA = "doc_id long, text string, key string, line int, _a string, lines int, n_lines string"


def key_of(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def plain(rows):
    held, keeper = Counter(), {}
    for doc, text, *_ in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= 20:
                held[key] += 1
                if doc is not None:
                    keeper[key] = max(doc, keeper.get(key, doc))
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if held[key_of(x)] < 3 or keeper.get(key_of(x)) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def rows_of(seed, n=300):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdé 😀") for _ in range(r.randint(15, 30))) for _ in range(40)] + [
        "a line that most documents hold", "short", "", " \t ", "exactly twenty chars", "nineteen chars long",
    ]
    rows = []
    for i in range(n):
        lines = [r.choice(pool) if r.random() < 0.4 else f"line {r.random()} of its own" for _ in range(r.randint(0, 12))]
        if r.random() < 0.4:
            lines += ["  A LINE that most documents Hold\t\r", "a line that most documents hold"]
        rows.append((i, "\n".join(lines), "k", 3, "x", 1, "y"))
    rows += [(None, None, None, None, None, None, None), (None, "a line that most documents hold", *rows[0][2:])]
    rows += [(n, "", *rows[0][2:]), (n, "\n\n", *rows[0][2:]), rows[5], rows[5], (7, rows[8][1], *rows[0][2:])]
    rows += [(None, "only nobody has this line of text", *rows[0][2:])] * 3
    rows += [(n + 3, "x" * 300_000 + "\n" + "a line that most documents hold", *rows[0][2:])]
    rows += [(n + 4, "\n".join(f"number {k} among very many" for k in range(90_000)), *rows[0][2:])]
    return rows


@pytest.mark.parametrize("seed,words", [(1, None), (2, None), (3, 64)])
def test_against_a_plain_version(spark, seed, words):
    """With a filter far too small nearly every line is suspected; the result is the same."""
    rows = rows_of(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ld.dedup_lines(df, words=words)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_empty_table_and_text_ids(spark):
    assert ld.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(f"d{i}", "the very same line in all\nown") for i in range(4)]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {"d0": 1, "d1": 1, "d2": 1, "d3": 0}


def test_a_hot_key_in_a_third_of_many_rows(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("row "), F.sha2(F.col("id").cast("string"), 256),
                 F.when(F.col("id") % 3 == 0, "\nPART OF A THIRD OF ALL ROWS").otherwise("")).alias("text"),
    )
    got = ld.dedup_lines(df)
    assert got.where("n_dropped = 1").count() == 1999 and got.where("n_dropped > 1").count() == 0
    assert got.where("n_dropped = 0 and n_lines = 2").first()["doc_id"] == 5997


def test_filters_never_miss_a_repeat(spark):
    """Keys of several batches and tasks; most keys that occur once are told apart."""
    r = random.Random(4)
    often = [f"a key that is repeated {i}" for i in range(500)]
    rows = [(i, "\n".join([r.choice(often), f"and one of its own {i} {r.random()}"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    again = ld.seen_again(df, word_count(8000))
    own = ld.Lines(pa.array([t.split("\n")[1] for _, t in rows]), 20).hash
    count = Counter(t.split("\n")[0] for _, t in rows)
    repeated = ld.Lines(pa.array([k for k, n in count.items() if n > 1]), 20).hash
    assert again.has(repeated).all() and again.has(own).mean() < 0.05


def test_blooms_built_in_spark_and_in_numpy_agree(spark):
    values = mix(np.arange(1, 5000, dtype=np.uint64))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "h long")
    built = bloom(df, "h", 5000)
    words = np.zeros(word_count(5000), U64)
    at, bits = places(values, len(words))
    np.bitwise_or.at(words, at, bits)
    assert (built.words == words).all() and built.has(values).all()
    assert built.has(mix(np.arange(10_000, 30_000, dtype=np.uint64))).mean() < 0.02
    assert not Bloom(np.zeros(LEAST_WORDS, U64)).has(values).any()
    assert word_count(0) == LEAST_WORDS and word_count(1 << 60) == 1 << 22
