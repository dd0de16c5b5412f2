"""The pipeline's filters decide by row: null and repeated doc_ids, against plain versions."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeimnorst") for _ in range(r.randint(2, 8))) for _ in range(n))


def rows_of():
    base = [prose(i, 60) for i in range(12)]
    near = [t.replace(t.split()[30], "changed", 1) for t in base]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(None, t) for t in near[:4]] + [(100 + i, t) for i, t in enumerate(near[3:6])]
    rows += [(None, base[7]), (None, base[7]), (None, prose(99, 50)), (None, prose(99, 50))]
    rows += [(5, base[5])] * 3 + [(5, prose(77, 70)), (5, prose(78, 70)), (None, None), (None, ""), (6, "")]
    return [(d, t, "en", "s", len(t or "")) for d, t in rows]


def shingles(text, size):
    w = re.findall(r"[^ \t-\r]+", (text or "").lower())
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def as_set(rows):
    return sorted(((r[0], r[1]) for r in rows), key=repr)


def test_one_row_of_each_group_stays(spark):
    rows = rows_of()
    sets = [shingles(r[1], 5) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if sets[i] and label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
                    changed = True
    want = [min((r for r, x in zip(rows, label) if x == c), key=lambda r: (r[0] is None, r[0] or 0)) for c in set(label)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, None)
    assert got.columns == docs.columns
    kept = got.collect()
    assert len(kept) == len(want)
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(r[0] for r in want if r[0] is not None)
    # Of one group any of the rows with its smallest doc_id may stay; the groups are the same.
    group = {(r[0], r[1]): x for r, x in zip(rows, label)}
    assert {group[r[0], r[1]] for r in kept if r[1]} == {x for r, x in zip(rows, label) if r[1]}


@pytest.mark.parametrize("passages", [2, 0])
def test_rows_with_a_passage_go_and_others_with_their_id_stay(spark, tmp_path, passages):
    rows = rows_of()
    items = [" ".join(prose(i, 60).split()[20:35]) for i in (3, 5)][:passages]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))

    def hit(text):
        words = " ".join(re.findall("[a-z0-9]+", (text or "").lower()))
        return any(" ".join(item.split()[i : i + 10]) in words for item in items for i in range(6))

    want = [r for r in rows if not hit(r[1])]
    got = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path))
    assert as_set(got.collect()) == as_set(want)
    assert (len(want) < len(rows)) == bool(passages)
