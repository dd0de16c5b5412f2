"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

All words of a text count, with weight (1 + log of its times) * idf ** ``POWER``; document
frequencies are counted over all documents.  The examples are as many toxic as clean ones, at most
``EACH`` of a label.  Examples of a label that are alike lie together, in blocks of ``BLOCK``; the
index keeps, per word and block, the largest weight.  What the few common words add is multiplied
out for all examples; the best of a block in that, and the sum of the query's other words times their
maxima, bound every cosine in the block.  The blocks with the largest bounds are read first, then all
whose bound reaches the k-th best cosine found: what is skipped cannot be among the nearest.

Examples vote with their cosine, for and against apart, so that the many clean ones do not always
win: the nearest one, the mean of the nearest few, and the mean of all of a label.  A logistic curve
over the logarithms of these votes, fitted on the examples, each held against the others, and moved
to the share of toxic labels, makes them a probability.  The nearest examples are the evidence.
Texts without any word of an example are scored by the examples without words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import NOT_ALNUM, U64, labelled_texts, mix, numbers, powers, ship, slices, text_bytes, words
from stratalake.storage import written_copy

ship(__name__)
EACH = 1500  # labelled examples of a label, at most
BLOCK, NEAREST, FIRST = 64, 15, 4  # examples of a block; examples searched of a label; blocks read at first
VOTES = (1, 3, 5, NEAREST)
COMMON, ROWS = 1000, 256  # words in most examples, multiplied out; queries multiplied at a time
POWER, LEAST_IDF = 2, 0.01
PRIOR, FAINT = 2.0, 1e-5  # weight of the share of toxic labels; added to votes before the logarithm
OFTEN, MOST_OFTEN = 1_000, 200_000  # documents that make a word frequent, at least; such words, at most


def _counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, times) of the distinct words of every text."""
    w = words(*text_bytes(batch.column("text")), NOT_ALNUM)
    row = w.row
    order = np.lexsort((w.hash, row))
    row, value = row[order], w.hash[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(fresh)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, toxic, text -> doc_id, toxic, words, times."""
    for batch in slices(batches, "text"):
        row, value, times = _counted(batch)
        cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("toxic"),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(value.view(np.int64))),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int64))),
            ],
            ["doc_id", "toxic", "words", "times"],
        )


@dataclass
class Index:
    """Examples as unit vectors in postings per term, cut into blocks with their maxima.

    An entry is a term's postings within one block; entries are ordered by term, then block.
    """

    vocabulary: np.ndarray  # all words of the examples, as ordered hashes
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray  # of each example, and of each block
    block_toxic: np.ndarray
    block_first: np.ndarray  # first example of each block, and their number
    common: np.ndarray  # place of each term among the common ones, or -1
    common_weight: np.ndarray  # of the common terms in every example
    first: np.ndarray  # first entry of each term, and their number
    block: np.ndarray  # of each entry
    most: np.ndarray  # largest weight of each entry
    begin: np.ndarray  # first posting of each entry, and their number
    example: np.ndarray  # of each posting
    weight: np.ndarray
    mean: np.ndarray  # weight of each term in the mean clean and the mean toxic example
    frequent: np.ndarray  # words of no example that many documents hold, as ordered hashes
    frequent_idf: np.ndarray
    empty: float = 0.0  # share of toxic examples among those without any term
    rate: float = 0.0  # of toxic labels
    centre: np.ndarray | None = None  # of the votes, their spread, and the curve over them
    spread: np.ndarray | None = None
    curve: np.ndarray | None = None
    rows: int = 0  # documents counted
    counts: DataFrame | None = None  # word, n: in how many documents; stays on the driver

    @property
    def postings(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per term: examples, weights, and where its blocks begin."""
        for a, b in zip(self.first, self.first[1:], strict=False):
            p = slice(self.begin[a], self.begin[b])
            yield self.example[p], self.weight[p], self.begin[a : b + 1] - self.begin[a]

    def search(self, row: np.ndarray, terms: np.ndarray, weight: np.ndarray, rows: int, k: int, skip: np.ndarray | None = None):
        """The ``k`` most similar examples of each label for many queries at once.

        ``row`` (ascending) says which query a term belongs to; ``skip`` is an example each query
        must not find.  Gives query, position and exact cosine, by query, clean examples before
        toxic ones, nearest first, ties to the smaller id.
        """
        n, blocks = len(self.ids), len(self.block_toxic)
        if not n or not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        common = self.common[terms]
        dense = np.zeros((rows, len(self.common_weight)))
        dense[row[common >= 0], common[common >= 0]] = weight[common >= 0]
        total = dense @ self.common_weight
        row, terms, weight = row[common < 0], terms[common < 0], weight[common < 0]
        count = self.first[terms + 1] - self.first[terms]
        entry, factor = _runs(self.first[terms], count), np.repeat(weight, count)
        pair = np.repeat(row, count) * blocks + self.block[entry]  # of query and block
        bound = np.maximum.reduceat(total, self.block_first[:-1], axis=1) + 1e-9
        bound += np.bincount(pair, factor * self.most[entry], rows * blocks).reshape(rows, blocks)
        wanted = np.zeros((rows, blocks), bool)
        for label in (0, 1):
            mine = np.flatnonzero(self.block_toxic == label)
            top = np.argpartition(-bound[:, mine], min(FIRST, len(mine)) - 1, axis=1)[:, :FIRST] if len(mine) else mine[None]
            wanted[np.arange(rows)[:, None], mine[top]] = True
        read, width = np.zeros((rows, n), bool), np.diff(self.block_first)
        floor = np.full((rows, 2), 1e-9)
        for _ in range(2):  # the best blocks, then all that may still hold one of the nearest
            pick = wanted.reshape(-1)[pair]
            e = entry[pick]
            size = self.begin[e + 1] - self.begin[e]
            p = _runs(self.begin[e], size)
            at = np.repeat(pair[pick] // blocks, size) * n + self.example[p]
            total += np.bincount(at, np.repeat(factor[pick], size) * self.weight[p], rows * n).reshape(rows, n)
            read |= np.repeat(wanted, width, axis=1)
            value = np.where(read, total, 0.0)
            if skip is not None:
                value[np.arange(rows), skip] = 0
            for label in (0, 1):
                mine = value[:, self.toxic == label]
                if mine.shape[1] >= k:
                    floor[:, label] = np.maximum(np.partition(mine, -k, axis=1)[:, -k] - 1e-9, 1e-9)
            wanted = ~read[:, self.block_first[:-1]] & (bound > floor[:, self.block_toxic])
        query, at = np.nonzero(value >= floor[:, self.toxic])
        cosine = value[query, at]
        order = np.lexsort((self.ids[at], -np.round(cosine, 12), self.toxic[at], query))
        query, at, cosine = query[order], at[order], cosine[order]
        group = query * 2 + self.toxic[at]
        keep = np.arange(len(group)) - np.searchsorted(group, group) < k
        return query[keep], at[keep], np.minimum(cosine[keep], 1.0)

    def nearest(self, terms: np.ndarray, weight: np.ndarray, k: int):
        """Positions and cosines for one query."""
        return self.search(np.zeros(len(terms), np.int64), terms, weight, 1, k)[1:]

    def of_all(self, row: np.ndarray, terms: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """Mean cosine of every query with the clean and with the toxic examples."""
        return np.stack([np.bincount(row, mean[terms] * weight, rows) for mean in self.mean], 1).astype(float)

    def votes(self, row: np.ndarray, found: np.ndarray, cosine: np.ndarray, of_all: np.ndarray) -> np.ndarray:
        """One row of votes per query from what :meth:`search` and :meth:`of_all` give."""
        group = row * 2 + self.toxic[found]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        near = [np.bincount(group, cosine * (place < k), 2 * len(of_all)).reshape(-1, 2) / k for k in VOTES]
        return np.log(np.concatenate([*near, of_all], 1) + FAINT)

    def score(self, votes: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(votes), self.rate)
        x = np.c_[(votes - self.centre) / self.spread, np.ones(len(votes))]
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -50, 50)))


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ..., ``size`` of them, of every run."""
    first, size = first.astype(np.int64), size.astype(np.int64)
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _upper(x: np.ndarray) -> np.ndarray:
    """The numbers in single precision, none of them smaller than before."""
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _idf(n, rows: int):
    return np.maximum(np.log((rows + 1) / (n + 0.5)), LEAST_IDF) ** POWER


def _alike_together(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` in parts of at most ``BLOCK``, cut at the median along the main direction of ``x``."""
    if len(rows) <= BLOCK:
        return [rows] if len(rows) else []
    part = x[rows] - x[rows].mean(0)
    direction = part[np.argmax((part**2).sum(1))]
    for _ in range(6):
        direction = part.T @ (part @ direction)
        direction /= np.linalg.norm(direction) + 1e-300
    order = rows[np.argsort(part @ direction, kind="stable")]
    left = -(-len(rows) // (2 * BLOCK)) * BLOCK
    return _alike_together(x, order[:left]) + _alike_together(x, order[left:])


def _found(words: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Place of every value among the ordered words, -1 for other values."""
    if not len(words):
        return np.full(len(value), -1)
    at = np.searchsorted(words, value)
    at[at == len(words)] = 0
    return np.where(words[at] == value, at, -1)


def build(vocab: np.ndarray, idf: np.ndarray, bags: list, rate: float | None = None) -> Index:
    """Index of examples (doc_id, toxic, words, times); ``rate`` is the share of toxic labels, by
    default that of the examples."""

    def plain(b, name: str) -> np.ndarray:
        return np.asarray(b[name], np.int64)

    bags = sorted(bags, key=lambda b: (b["doc_id"], plain(b, "words").tobytes(), plain(b, "times").tobytes()))
    n, none = len(bags), np.zeros(0, np.int64)
    toxic = np.array([b["toxic"] for b in bags], np.int64)
    term = _found(vocab, np.concatenate([none, *(plain(b, "words") for b in bags)]))
    times = np.concatenate([none, *(plain(b, "times") for b in bags)])
    row = np.repeat(np.arange(n), [len(b["words"]) for b in bags])
    term, times, row = term[term >= 0], times[term >= 0], row[term >= 0]
    weight = (1 + np.log(times)) * idf[term]
    weight /= np.sqrt(np.bincount(row, weight**2, n))[row]
    # Blocks of examples of one label that share words, seen through 64 random sums of them.
    seen = np.zeros((n, 64))
    spot = mix(vocab.view(U64) if len(vocab) else none.view(U64))[term]
    np.add.at(seen, (row, (spot >> U64(58)).astype(np.int64)), np.where(spot & U64(1), weight, -weight))
    blocks = [part for label in (0, 1) for part in _alike_together(seen, np.flatnonzero(toxic == label))]
    new = np.concatenate([none, *blocks])
    place, block_of = np.zeros(n, np.int64), np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    place[new] = np.arange(n)
    bags, toxic, row = [bags[i] for i in new], toxic[new], place[row]
    order = np.lexsort((row, term))
    small = np.int16 if n < 1 << 15 else np.int32  # the index is sent to every executor
    held, example, value = term[order], row[order].astype(small), weight[order]
    fresh = np.ones(len(held), bool)
    fresh[1:] = (held[1:] != held[:-1]) | (block_of[example[1:]] != block_of[example[:-1]])
    begin = np.flatnonzero(fresh)
    in_examples = np.bincount(held, minlength=len(vocab))
    often = np.argsort(-in_examples, kind="stable")[:COMMON]
    common = np.full(len(vocab), -1)
    common[often] = np.arange(len(often))
    common_weight = np.zeros((len(often), n))
    is_common = common[held] >= 0
    common_weight[common[held[is_common]], example[is_common]] = value[is_common]
    in_label = np.array([max((toxic == label).sum(), 1) for label in (0, 1)])
    mean = np.zeros((2, len(vocab)))
    np.add.at(mean, (toxic[example], held), value)
    index = Index(
        vocabulary=vocab,
        idf=idf,
        ids=np.array([b["doc_id"] for b in bags], np.int64),
        toxic=toxic,
        block_toxic=np.array([toxic[np.searchsorted(block_of, b)] for b in range(len(blocks))], np.int64),
        block_first=np.searchsorted(block_of, np.arange(len(blocks) + 1)),
        common=common,
        common_weight=common_weight,
        first=np.searchsorted(held[begin], np.arange(len(vocab) + 1)).astype(np.int32),
        block=block_of[example[begin]],
        most=_upper(np.maximum.reduceat(value, begin)) if len(begin) else np.zeros(0, np.float32),
        begin=np.append(begin, len(held)).astype(np.int32),
        example=example,
        weight=value,
        mean=mean / in_label[:, None],
        frequent=none,
        frequent_idf=np.zeros(0),
    )
    index.rate = float(toxic.mean()) if n and rate is None else rate or 0.0
    bare = np.bincount(row, minlength=n) == 0
    index.empty = (float(toxic[bare].sum()) + PRIOR * index.rate) / (bare.sum() + PRIOR)
    if 0 < toxic[~bare].sum() < (~bare).sum():
        _calibrate(index, term, weight, row, np.flatnonzero(~bare))
    return index


def _calibrate(index: Index, term: np.ndarray, weight: np.ndarray, row: np.ndarray, some: np.ndarray) -> None:
    """Fit the curve on every example with words, held against all others."""
    order = np.argsort(row, kind="stable")
    term, weight, row = term[order], weight[order], row[order]
    first = np.searchsorted(row, np.arange(len(index.ids) + 1))
    size = np.array([(index.toxic == label).sum() for label in (0, 1)])
    votes = []
    for top in range(0, len(index.ids), ROWS):
        own = slice(first[top], first[min(top + ROWS, len(index.ids))])
        rows = min(ROWS, len(index.ids) - top)
        mine = np.arange(top, top + rows)
        query = (row[own] - top, term[own], weight[own], rows)
        others = np.repeat(size[None], rows, 0)
        of_all = index.of_all(*query) * size
        others[np.arange(rows), index.toxic[mine]] -= 1
        of_all[np.arange(rows), index.toxic[mine]] -= np.bincount(query[0], query[2] ** 2, rows)
        votes.append(index.votes(*index.search(*query, NEAREST, mine), np.maximum(of_all, 0) / np.maximum(others, 1)))
    x, y = np.concatenate(votes)[some], index.toxic[some].astype(float)
    index.centre, index.spread = x.mean(0), x.std(0) + 1e-9
    x = np.c_[(x - index.centre) / index.spread, np.ones(len(x))]
    curve, ridge = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, 0.01), 1e-3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -50, 50)))
        gradient = x.T @ (p - y) + ridge * curve
        curve -= 0.7 * np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
    share, rate = y.mean(), min(max(index.rate, 1e-6), 1 - 1e-6)
    curve[-1] += np.log(rate / (1 - rate)) - np.log(share / (1 - share))
    index.curve = curve


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> word and in how many texts; the number of texts under a null word."""
    for batch in slices(batches, "text"):
        word, n = np.unique(_counted(batch)[1].view(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *word.tolist()], pa.int64()), pa.array([batch.num_rows, *n.tolist()], pa.int64())],
            ["word", "n"],
        )


def train(docs: DataFrame, labels: DataFrame, each: int = EACH) -> Index:
    """Index of a bounded sample of ``labels(doc_id, toxic)``, at most ``each`` of a label;
    frequencies over all ``docs``, the share of toxic labels over all ``labels``."""
    plain = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    plain = plain.where("doc_id is not null and toxic in (0, 1)")
    rate = plain.agg(F.avg("toxic")).first()[0] or 0.0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = [labelled_texts(texts, plain.where(F.col("toxic") == label), "toxic", each) for label in (0, 1)]
    table = (
        chosen[0]
        .unionByName(chosen[1])
        .select("doc_id", "toxic", "text")
        .mapInArrow(_bags, "doc_id long, toxic long, words array<long>, times array<long>")
        .toArrow()
        .combine_chunks()
    )
    ids, toxic = table.column("doc_id").to_pylist(), table.column("toxic").to_pylist()
    columns = [table.column(c) for c in ("words", "times")]
    bags = [
        {"doc_id": ids[i], "toxic": toxic[i], "words": columns[0][i].values.to_numpy(), "times": columns[1][i].values.to_numpy()}
        for i in range(table.num_rows)
    ]
    vocab = np.unique(np.concatenate([np.zeros(0, np.int64), *(b["words"] for b in bags)]))
    counts = written_copy(
        docs.select("text").mapInArrow(_counting, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "word_counts",
    )
    rows, held = counts.agg(
        F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))), F.lit(0)),
    ).first()

    def of_examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_found(vocab, batch.column("word").to_numpy(zero_copy_only=False)) >= 0))

    words_only = counts.where("word is not null")
    known = words_only.mapInArrow(of_examples, "word long, n long").toArrow()
    n = np.zeros(len(vocab))
    n[np.searchsorted(vocab, known.column("word").to_numpy())] = known.column("n").to_numpy()
    index = build(vocab, _idf(n, rows), bags, rate)
    # Words of many documents are looked up in tasks: the join of the others has no hot word.
    often = words_only.where(F.col("n") >= max(OFTEN, held // MOST_OFTEN)).toArrow()
    word, n = often.column("word").to_numpy(), often.column("n").to_numpy()
    other = np.flatnonzero(_found(vocab, word) < 0)
    other = other[np.argsort(word[other])]
    index.frequent, index.frequent_idf = word[other], _idf(n[other], rows)
    index.rows, index.counts = rows, words_only
    return index


def _row_keys(batch: pa.RecordBatch) -> np.ndarray:
    """A 64-bit key of doc_id (hashed in ``_seed``) and text."""
    data, offsets = text_bytes(batch.column("text"))
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=total[1:])
    value = mix((total[offsets[1:]] - total[offsets[:-1]]) * inverse[offsets[:-1]] + np.diff(offsets).astype(U64))
    return mix(value + mix(batch.column("_seed").to_numpy().view(U64))).view(np.int64)


_BYTES = numbers(41, 256)


def score(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, score, predicted and evidence (nearest examples with cosine) for every row.

    Null and empty texts, and texts without any word of an example, get the share of toxic
    examples among those without any word, and no evidence.  Other columns are ignored; repeated
    rows get equal results; an empty table gives no rows; without examples every score is 0.

    The words of the examples decide who is near; all words of a text count in its norm.  Those
    that neither an example nor many documents hold find their frequency by a join.
    """
    counts, index = index.counts, replace(index, counts=None)
    # Each function is sent no more of the index than it reads.
    vocab, frequent, none = index.vocabulary, index.frequent, np.zeros(0, np.int64)
    judge = replace(
        index, vocabulary=none, idf=none, first=none, block=none, most=none, begin=none, example=none,
        weight=none, mean=none, common=none, common_weight=none, frequent=none, frequent_idf=none,
    )

    def parts(batch: pa.RecordBatch):
        row, value, times = _counted(batch)
        value = value.view(np.int64)
        at, often = _found(vocab, value), _found(frequent, value)
        return row, value, times, at, often, (at < 0) & (often < 0)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, _, times, at, often, rare = parts(batch)
            n = batch.num_rows
            weight = np.zeros(len(row))
            known, other = at >= 0, often >= 0
            weight[known] = (1 + np.log(times[known])) * index.idf[at[known]]
            weight[other] = (1 + np.log(times[other])) * index.frequent_idf[often[other]]
            square = np.bincount(row, weight**2, n).astype(float)
            norm = np.sqrt(square)
            first = np.searchsorted(row, np.arange(n + 1))
            weight /= np.maximum(norm, 1e-300)[row]
            parts_found = []
            for top in range(0, n, ROWS):
                some = np.flatnonzero(known[first[top] : first[min(top + ROWS, n)]]) + first[top]
                query = (row[some] - top, at[some], weight[some], min(ROWS, n - top))
                near = index.search(*query, NEAREST)
                parts_found.append((near[0] + top, near[1], near[2], index.of_all(*query)))
            of, found, cosine, of_all = (np.concatenate(x) for x in zip(*parts_found, strict=True))
            cut = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(_row_keys(batch)),
                    pa.array(np.bincount(row[rare], minlength=n) > 0),
                    pa.array(square),
                    pa.ListArray.from_arrays(cut, pa.array(found.astype(np.int32))),
                    pa.ListArray.from_arrays(cut, pa.array(cosine)),
                    pa.array(of_all[:, 0], pa.float64()),
                    pa.array(of_all[:, 1], pa.float64()),
                ],
                ["doc_id", "_key", "_rare", "_square", "_found", "_cosine", "_clean", "_toxic"],
            )

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, value, times, _, _, rare = parts(batch)
            row, value, times = row[rare], value[rare], times[rare]
            lead = np.ones(len(row), np.int64)  # once per row: repeated rows share a key
            lead[1:] = row[1:] != row[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_row_keys(batch)[row]), pa.array(lead), pa.array(value), pa.array(times.astype(np.int64))],
                ["_key", "_lead", "word", "times"],
            )

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            square = batch.column("_square").to_numpy()
            share = np.sqrt(square / np.maximum(square + batch.column("_other").to_numpy(), 1e-300))
            size = batch.column("_found").value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), size)
            found = batch.column("_found").flatten().to_numpy()
            cosine = batch.column("_cosine").flatten().to_numpy() * share[row]
            of_all = np.stack([batch.column(c).to_numpy() for c in ("_clean", "_toxic")], 1) * share[:, None]
            scores = np.where(size > 0, judge.score(judge.votes(row, found, cosine, of_all)), judge.empty)
            cut = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            near = pa.StructArray.from_arrays(
                [pa.array(judge.ids[found]), pa.array(judge.toxic[found]), pa.array(cosine)], ["doc_id", "toxic", "cosine"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.ListArray.from_arrays(cut, near)],
                ["doc_id", "score", "evidence"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("_seed"))
    near = keyed.mapInArrow(
        searched,
        f"doc_id {kind}, _key long, _rare boolean, _square double, _found array<int>, _cosine array<double>, "
        "_clean double, _toxic double",
    )
    pairs = keyed.mapInArrow(rare_words, "_key long, _lead long, word long, times long")
    if counts is None:
        counts = docs.sparkSession.createDataFrame([], "word long, n long")
    idf = F.greatest(
        F.log((F.lit(index.rows) + 1) / (F.coalesce("n", F.lit(0)) + 0.5)), F.lit(LEAST_IDF)
    )
    idf = F.pow(idf, F.lit(float(POWER)))
    other = (
        pairs.join(counts, "word", "left")
        .select("_key", "_lead", F.pow((F.log("times") + 1) * idf, F.lit(2.0)).alias("_part"))
        .groupBy("_key")
        .agg((F.sum("_part") / F.sum("_lead")).alias("_other"))
    )
    # Rows without rare words are joined by a key of their own, so that they are spread.
    lone = F.xxhash64("_key", F.rand(5))
    return (
        near.withColumn("_key", F.when(F.col("_rare"), F.col("_key")).otherwise(lone))
        .join(other, "_key", "left")
        .withColumn("_other", F.when(F.col("_rare"), F.col("_other")).otherwise(F.lit(0.0)))
        .withColumn("_other", F.coalesce("_other", F.lit(0.0)))
        .select("doc_id", "_square", "_other", "_found", "_cosine", "_clean", "_toxic")
        .mapInArrow(voted, f"doc_id {kind}, score double, evidence array<struct<doc_id: long, toxic: long, cosine: double>>")
        .select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
    )
