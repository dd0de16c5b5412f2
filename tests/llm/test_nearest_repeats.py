"""op2: repeats of a vec_id take one place among the nearest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import spann


def test_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    others = [(7, [float(v) for v in x[0] + 0.001 * (j + 1)]) for j in range(12)]  # 12 vectors under one id
    table = spark.createDataFrame(rows * 2 + rows[5:6] * 15 + others, "vec_id long, embedding array<double>")
    got = spann.nearest(table, F.col("vec_id") % 10 == 0).collect()
    vectors = [(i, np.array(v)) for i, v in rows + others]
    for q in range(0, 60, 10):
        best = {}
        for i, v in vectors:
            if i != q:
                best[i] = min(best.get(i, np.inf), float(np.sqrt(((x[q] - v) ** 2).sum())))
        want = sorted(best, key=lambda i: (best[i], i))[:10]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["vec_id"] for r in mine] == want


def test_a_part_yields_ten_ids():
    x = np.random.default_rng(5).normal(size=(40, 4))
    ids = np.repeat(np.arange(40), 11)
    held = pa.table({"vec_id": pa.array(ids), "vector": pa.array(np.repeat(x, 11, axis=0).tolist())})
    asked = pa.table({"vec_id": pa.array([1000]), "vector": pa.array([[0.0] * 4])})
    found = spann._searched(10)(asked, held)["vec_id"].to_pylist()
    assert found == np.argsort((x**2).sum(1))[:10].tolist()


def table_of(spark, x):
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")


def true_nearest(x, asked, k=10):
    d = (x**2).sum(1) - 2 * x[asked] @ x.T
    d[np.arange(len(asked)), asked] = np.inf
    return np.argsort(d, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("kind", ["clusters", "isotropic"])
def test_recall_with_hundreds_of_lists(spark, monkeypatch, kind):
    monkeypatch.setattr(spann, "LIST_ROWS", 12)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 24))
    if kind == "clusters":
        x = x[rng.integers(0, 60, 6000)] + 0.2 * rng.normal(size=(6000, 24))
    got = spann.nearest(table_of(spark, x), F.col("vec_id") % 100 == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    asked = np.arange(0, 6000, 100)
    hits = sum(len(found[q] & set(w)) for q, w in zip(asked.tolist(), true_nearest(x, asked).tolist()))
    assert len(got) == 600 and hits / 600 >= 0.9


def test_small_lists_and_queries_at_their_centroid_still_give_ten(spark, monkeypatch):
    monkeypatch.setattr(spann, "LIST_ROWS", 4)
    rng = np.random.default_rng(9)
    pairs = np.repeat(rng.normal(size=(200, 6)), 2, axis=0)  # equal vectors: lists of one place
    for x in (rng.normal(size=(400, 6)), pairs):
        got = spann.nearest(table_of(spark, x), F.lit(True)).groupBy("query_id").count().collect()
        assert len(got) == 400 and {r["count"] for r in got} == {10}


def test_extra_columns_with_clashing_names(spark):
    x = np.random.default_rng(2).normal(size=(50, 6))
    table = table_of(spark, x)
    clash = table.withColumns({c: F.lit("x") for c in ("vector", "list", "part", "score", "rank", "query_id", "is_query", "n", "d")})
    want = sorted(map(tuple, spann.nearest(table, F.col("vec_id") % 10 == 0).collect()))
    assert sorted(map(tuple, spann.nearest(clash, F.col("vec_id") % 10 == 0).collect())) == want
