"""op10: every word of a text counts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stratalake.llm import toxicity


@pytest.mark.parametrize("often", [1000, 2])
def test_examples_are_found_by_any_word(spark, monkeypatch, often):
    """Rare words and clean ones count: cosines over all words, by brute force."""
    monkeypatch.setattr(toxicity, "OFTEN", often)  # how rare a word is must not matter
    r = random.Random(6)
    common = [f"c{i}" for i in range(30)]
    texts = [" ".join([*r.choices(common, k=20), f"only{i // 2}", *[f"lone{i}"] * (i % 3)]) for i in range(160)]
    rows = list(enumerate(texts)) + [(150, texts[150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 < 2)) for i in range(100)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    names = sorted({w for t in texts for w in t.split()})
    times = np.array([[t.split().count(w) for w in names] for _, t in rows], float)
    weight = np.where(times > 0, 1 + np.log(np.maximum(times, 1)), 0) * np.maximum(np.log((len(rows) + 1) / ((times > 0).sum(0) + 0.5)), 0.01) ** 2
    weight /= np.linalg.norm(weight, axis=1)[:, None]
    assert len(got) == len(rows)
    for row in got:
        exact = weight[:100] @ weight[row["doc_id"]]
        order = np.lexsort((np.arange(100), -np.round(exact, 12)))
        want = np.array([j for label in (0, 1) for j in [j for j in order if (j % 10 < 2) == label][: toxicity.NEAREST]])
        assert [e["toxic"] for e in row["evidence"]] == [int(j % 10 < 2) for j in want]
        assert [e["doc_id"] for e in row["evidence"]] == want.tolist()
        assert np.allclose([e["cosine"] for e in row["evidence"]], exact[want])


def test_one_label_alone_and_repeated_ids(spark):
    """One labelled doc_id that fills the table stays one example; one label gives its share."""
    rows = [(7, f"the same words {i % 3}") for i in range(5000)] + [(i, f"other words {i} " * 3) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(7, 1)] * 500 + [(i, i % 2) for i in range(100, 160)] + [(100, 1), (None, 1), (101, None)]
    index = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert sorted(index.ids.tolist()).count(7) == 1 and len(index.ids) <= 62
    got = toxicity.score(docs, index).collect()
    assert len(got) == 5060 and all(0 <= r["score"] <= 1 for r in got)
    clean = toxicity.train(docs, spark.createDataFrame([(i, 0) for i in range(100, 160)], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, clean).collect()} == {0.0}
