"""Every corpus operator on awkward tables and against a plain version of itself."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import compare, connect
from stratalake.llm import (
    decontam,
    html_extract,
    langid,
    odd_sketch,
    quality_crf,
    queries,
    semicrf,
    sentencepieces,
    spann,
    toxicity,
)
from stratalake.llm.shard import shard

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, _x string, component string, score double, id long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeimnorst") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, short and long ones, repeated rows, clashing columns."""
    long = "\n".join(prose(s, 40) for s in range(60))
    texts = [None, "", "  \n ", "one", "a b", prose(1, 50), prose(1, 50), prose(1, 50) + " end", long, "é ß 😀 ▁"]
    rows = [(i, t, "en", "x", "c", 0.5, 7) for i, t in enumerate(texts)]
    rows += [(5, prose(1, 50), "en", "x", "c", 0.5, 7), (None, "nobody here", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


def test_near_duplicates(spark, odd):
    got = {}
    for r in odd_sketch.near_duplicates(odd, 5).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[5]) == 2 and sum(map(len, got.values())) == 12
    assert [got[i][0]["component_id"] for i in (5, 6, 7)] == [5, 5, 5]
    assert got[0][0]["n_shingles"] == got[1][0]["n_shingles"] == got[2][0]["n_shingles"] == 0
    assert got[0][0]["component_id"] == 0 and got[0][0]["kept"]
    assert got[None][0]["component_id"] is None and got[None][0]["kept"]
    assert odd_sketch.near_duplicates(odd.limit(0), 5).count() == 0


@pytest.mark.parametrize("places", [120, 25])
def test_near_duplicates_in_one_large_group(spark, places):
    """Edited copies of one text, most of them unlike each other: components by brute force.

    With few places to edit, copies also share some of their edits with one or two others."""
    r, base = random.Random(5), prose(9, 120).split()
    texts = []
    for _ in range(120):
        edited = list(base)
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            word = f"w{r.random():.6f}" if places == 120 else r.choice(["new", "other", "third"])
            edited[r.randrange(places)] = word
        texts.append(" ".join(edited))
    sets = [{tuple(t.split()[i : i + 4]) for i in range(117)} for t in texts]
    label = list(range(120))
    changed = True
    links = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed = changed or label[i] != low or label[j] != low
            label[i] = label[j] = low
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(docs, 4).collect()}
    assert got == dict(enumerate(label))
    # A doc_id with a second text, unlike all others, keeps the links of its first.
    more = docs.union(spark.createDataFrame([(i, prose(500 + i, 90)) for i in range(0, 120, 3)], docs.schema))
    got = {}
    for r in odd_sketch.near_duplicates(more, 4).collect():  # a second text may be alone
        got[r["doc_id"]] = min(r["component_id"], got.get(r["doc_id"], 1000))
    assert got == dict(enumerate(label))


def test_contamination(spark, odd):
    bench = spark.createDataFrame([(1, prose(1, 50)), (2, "one"), (3, None), (4, ""), (None, "a b"), (5, prose(1, 12))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.contamination(odd, bench).collect()}
    assert got[5]["n_hit"] == got[5]["n_words"] == 50 and got[5]["n_items"] == 2
    assert got[3]["contaminated"] and not got[4]["contaminated"] and not got[0]["contaminated"]
    many = decontam.contamination(odd, bench, block=7)  # several passes, same result
    assert {tuple(r) for r in many.collect()} == {tuple(r) for r in decontam.contamination(odd, bench).collect()}
    assert decontam.contamination(odd, bench.limit(0)).where("contaminated").count() == 0
    clash = bench.withColumns({c: F.lit("x") for c in ("window", "set", "_key", "_sets", "n", "doc_id", "contaminated")})
    assert {tuple(r) for r in decontam.contamination(odd, clash).collect()} == {tuple(r) for r in many.collect()}
    # A list of items that a third of all rows have, and many others.
    hot = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit(prose(1, 50))).when(F.col("id") % 3 == 1, F.lit(prose(2, 30))).alias("text"),
    )
    got = decontam.contamination(hot, bench).groupBy("contaminated", "n_items", "n_hit").count().collect()
    assert sorted(map(tuple, got)) == [(False, 0, 0, 2000), (True, 2, 50, 1000)]
    assert decontam.contamination(odd.limit(0), bench).count() == 0


def test_shards(spark, odd):
    rows = shard(odd, shards=3).collect()
    assert len(rows) == 12 and shard(odd.limit(0)).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    null = next(r for r in rows if r["doc_id"] == 0)
    assert (null["size"], null["text_crc32"]) == (16, 0)
    copies = spark.range(20_000).select((F.col("id") % 3).alias("doc_id"), F.lit("same text").alias("text"))
    sizes = [r["s"] for r in shard(copies, shards=7).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 0.01 * sum(sizes)


def test_shard_sizes_and_checksums(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = queries.op7_histogram_shards(spark, SF_DIR).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(k, len(t) + 16, zlib.crc32(t)) for k, t in texts.items()}


def plain_spans(text: str):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((*m.span(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 12 <= len(d) <= 19 and semicrf.luhn(d):
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], semicrf.KINDS.index(s[2])))


def test_base_spans_match_the_patterns():
    r = random.Random(8)
    for _ in range(4000):
        text = "".join(r.choice(["a", "b@", "@", ".", "1", "23", "255", "4111111111111111", " ", "-", "+4", "(", ")", "é", "x.y"]) for _ in range(r.randint(1, 25)))
        assert semicrf.base_spans(text) == plain_spans(text), text


def test_personal_data(spark, odd):
    finder = semicrf.Finder(semicrf.trained())
    assert [k for *_, k in finder.added("reach anna (at) example dot com today", [])] == ["email"]
    assert finder.added("Apache License, Version 2.0, since 1999, id 12345678", []) == []
    rows = {r["doc_id"]: r for r in semicrf.find(odd).collect()}
    assert rows[0]["spans"] == rows[1]["spans"] == "" and semicrf.find(odd.limit(0)).count() == 0
    texts = spark.createDataFrame([(1, "é a@b.org +1 (988) 555-2485", "k"), (2, None, "k")], "doc_id long, text string, spans string")
    assert semicrf.find(texts).where("doc_id = 1").first()["spans"] == "email:2:9,phone:10:27"
    assert {tuple(r) for r in semicrf.mask(texts).collect()} == {(1, "é [EMAIL] [PHONE]", "k"), (2, None, "k")}


def test_quality(spark, odd, labels):
    for chosen in (labels, labels.limit(0)):
        model = quality_crf.train(odd, chosen)
        rows = quality_crf.score(odd, model).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_crf.score(odd.limit(0), model).count() == 0
    assert quality_crf.keep_good(odd, model).columns == odd.columns


def test_line_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    score, move = rng.normal(size=4), rng.normal(size=(2, 2))
    total, good = 0.0, np.zeros(4)
    for k in range(16):
        y = [(k >> i) & 1 for i in range(4)]
        w = np.exp(sum(s * v for s, v in zip(score, y)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
    got, _ = quality_crf.marginals(score, np.array([0, 4]), move)
    assert np.allclose(got, good / total)


def test_toxicity(spark, odd, labels):
    for chosen in (labels, labels.limit(0)):
        index = toxicity.train(odd, chosen)
        rows = toxicity.score(odd, index).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(odd.limit(0), index).count() == 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    vocab = np.sort(rng.integers(-(2**60), 2**60, 30))
    bags = []
    for i in range(400):
        pick = np.sort(rng.choice(vocab, rng.integers(0, 6), replace=False))
        bags.append({"doc_id": i, "toxic": int(i % 7 == 0), "words": pick.tolist(), "times": rng.integers(1, 4, len(pick)).tolist()})
    index = toxicity.build(vocab, rng.uniform(0.5, 4, 30), bags)
    dense = np.zeros((400, 30))
    for t, (examples, values, _) in enumerate(index.postings):
        dense[examples, t] = values
    for i in range(0, 400, 9):
        terms = np.flatnonzero(dense[i])
        if len(terms):
            found, cosine = index.nearest(terms, dense[i, terms], 10)
            exact = np.round(dense @ dense[i], 12)
            order = [j for j in np.lexsort((index.ids, -exact)) if exact[j] > 0]
            best = [j for label in (0, 1) for j in [j for j in order if index.toxic[j] == label][:10]]
            assert found.tolist() == best and np.allclose(cosine, exact[best])
            one = index.of_all(np.zeros(len(terms), int), terms, dense[i, terms], 1)[0]
            assert np.allclose(one, [(dense @ dense[i])[index.toxic == c].mean() for c in (0, 1)])
    assert all(len(set(index.toxic[index.example[a:b]])) == 1 for a, b in zip(index.begin, index.begin[1:]))


def test_language(spark, odd):
    assert langid.train(odd.limit(0)) is None
    rows = {r["doc_id"]: r for r in langid.predict(odd, None).collect()}
    assert rows[5]["lang_pred"] == "und"
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    net = langid.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    held = langid.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id")
    held = held.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.9
    rows = {r["doc_id"]: r for r in langid.predict(odd, net).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and rows[5]["lang_pred"] != "und"


def test_network_gradient_by_differences():
    rng = np.random.default_rng(0)
    net = langid.train_network(rng.integers(0, 256, (8, 6)).astype(np.uint8), rng.integers(0, 2, 8), ["a", "b"])
    codes, label = rng.integers(0, 256, (5, 6)), rng.integers(0, 2, 6)

    def loss():
        p = net.positions(codes.astype(np.intp)).astype(float)
        return -np.mean([np.log(p[label[j], t, j]) for t in range(5) for j in range(6)])

    grads = langid._gradient(net, codes, label)
    for p, g in zip([*net.table, *net.inner, net.out], grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = p[at]
        p[at] = before + 0.01
        up = loss()
        p[at] = before - 0.01
        down = loss()
        p[at] = before
        assert abs((up - down) / 0.02 - g[at]) < 0.03 * abs(g[at]) + 2e-4


def test_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(5000, None), (5100, [0.0] * 16), (5200, [1.0, None] * 8), (5300, [float("nan")] * 16), (5400, [1.0]), (None, [1.0] * 16)]
    rows += [(6000, rows[7][1]), (6100, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = spann.nearest(table, F.col("vec_id") % 100 == 0).collect()
    ids = np.array([*range(3000), 6000, 6100])
    full = np.concatenate([x, x[7:8], x[7:8]])
    hits = 0
    asked = [i for i, v in enumerate(ids) if v % 100 == 0]
    for i in asked:
        d = np.sqrt(((full[i] - full) ** 2).sum(1))
        d[i] = np.inf
        want = ids[np.lexsort((ids, d))[:10]].tolist()
        mine = sorted((r for r in got if r["query_id"] == ids[i]), key=lambda r: r["rank"])
        hits += len({r["vec_id"] for r in mine} & set(want))
        assert [r["rank"] for r in mine] == list(range(1, 11))
    assert hits / 10 / len(asked) >= 0.9
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 6000][:2] == [7, 6100]
    assert spann.nearest(table.limit(0), F.lit(True)).count() == 0
    assert spann.nearest(table.where("vec_id < 4"), F.col("vec_id") == 0).count() == 3


def test_token_round_trip(spark, odd):
    encoded = sentencepieces.encode(odd, k=3)
    texts = {(r["doc_id"], r["text"] or "") for r in odd.collect()}
    assert {(r["doc_id"], r["text"]) for r in sentencepieces.decode(encoded).collect()} == texts
    v = sentencepieces._vocabulary(open(sentencepieces.MODEL, "rb").read(), 1.0)
    for r in encoded.collect():
        assert r["round_trip"]
        spelled = [v.decoded(np.array(s["ids"])).tobytes().decode()[1:] for s in r["samples"]]
        assert all((r["doc_id"], t) in texts for t in spelled)
        assert len({tuple(s["ids"]) for s in r["samples"]}) == len(r["samples"])
        values = [s["perturbed"] for s in r["samples"]]
        assert values == sorted(values, reverse=True)
    own = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert own[5] == v.processor.encode(prose(1, 50))
    assert sentencepieces.encode(odd.limit(0)).count() == 0


def test_samples_follow_their_probabilities():
    proto, n = open(sentencepieces.MODEL, "rb").read(), 4000
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["hello"] * n), pa.array(range(n))], ["doc_id", "text", "_seed"])
    made = [s for b in sentencepieces.segment(proto, 2, 0.3, True)(iter([batch])) for s in b.column("samples").to_pylist()]
    p = {tuple(s["ids"]): np.exp(s["log_p"]) for m in made for s in m}
    first = [tuple(m[0]["ids"]) for m in made]
    for ids, q in sorted(p.items(), key=lambda x: -x[1])[:4]:
        assert abs(first.count(ids) / n - q) < 4 * np.sqrt(q / n)
    estimate = [sum(np.exp(s["log_p"]) / s["inclusion"] for s in m) for m in made]
    assert abs(np.mean(estimate) - 1) < 0.05


def test_pages(spark):
    rows = [(1, "u", None, "t"), (2, "u", "", "t"), (3, "u", "<<a <b><div", "t"), (4, None, "<nav><a href=x>Menu</a></nav><article><h1>T &amp; t</h1><p>Some  long\nstory, with words.<p>And more of it here.</article><footer>f</footer>", "t"), (4, None, "plain", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert "T & t\n\nSome long story, with words.\n\nAnd more of it here." in [r["text"] for r in got]
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_decoding_has_no_kept_node_below_a_dropped_one():
    r = random.Random(4)
    for _ in range(30):
        page = html_extract.read(html_extract._made_page(r))
        keep = html_extract.kept(page, np.random.default_rng(r.randrange(99)).normal(0, 3, len(page.parent)))
        assert all(keep[page.parent[i]] or not keep[i] for i in range(1, len(keep)))


def test_real_pages_keep_exactly_the_article(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.op1_html_text(spark, SF_DIR).collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>)", pages[r["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", body)))
        want = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r["text"] == "\n\n".join(w for w in want if w)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) == ""


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns and kept.count() > 0, name
    out = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert out.where("not round_trip").count() == 0
