"""op8: the query returns ids that decode to the texts."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from stratalake.llm import queries, sentencepieces

SF_DIR = "/root/testdata/sf0.001"


def test_query_returns_ids_of_documents_and_samples(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = queries.op8_sentencepieces(spark, SF_DIR)
    assert {(r["doc_id"], r["text"]) for r in sentencepieces.decode(got).collect()} == set(texts.items())
    v = sentencepieces._vocabulary(open(sentencepieces.MODEL, "rb").read(), 1.0)
    for r in got.collect():
        assert r["decoded"] and len(r["ids"]) == r["n_tokens"]
        for s in r["samples"]:
            assert len(s["ids"]) == s["n_tokens"]
            assert v.decoded(np.array(s["ids"])).tobytes().decode()[1:] == texts[r["doc_id"]]


def test_a_wrong_id_is_noticed():
    v = sentencepieces._vocabulary(open(sentencepieces.MODEL, "rb").read(), 1.0)
    ids = v.processor.encode("hello there")
    kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32()))]))
    samples = pa.array([[{"ids": ids}], [{"ids": ids}, {"ids": ids[:-1]}], [], []], kind)
    own = pa.array([ids, ids, ids[:-1], []], pa.list_(pa.int32()))
    text = pa.array(["hello there", "hello there", "hello there", None])
    assert sentencepieces._decoded_same(v, own, samples, text).to_pylist() == [True, False, False, True]
    assert sentencepieces.texts_of(v, pa.array([None, [int(v.byte_id[0xC3])]], pa.list_(pa.int32()))).to_pylist() == ["", ""]


def test_segmenting_a_megabyte_takes_little_memory():
    """The two workers of an executor keep what a slice took while the pipeline goes on."""
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) for _ in range(20_000)]
    texts = [" ".join(r.choices(words, k=300)) for _ in range(500)]
    number = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([number, pa.array(texts), number], ["doc_id", "text", "_seed"])
    proto = open(sentencepieces.MODEL, "rb").read()
    sentencepieces._vocabulary(proto, 1.0)
    sentencepieces.powers(1 << 21)
    tracemalloc.start()
    try:
        rows = sum(x.num_rows for x in sentencepieces.segment(proto, 2, 1.0, True)(iter([batch])))
        assert rows == len(texts) and tracemalloc.get_traced_memory()[1] < 55e6
    finally:
        tracemalloc.stop()
