"""Document quality from a linear-chain conditional random field over lines.

Every non-blank line gets binned features of itself and of its two neighbours (character
classes, word lengths, words that repeat, lines that repeat).  The field labels lines good or
bad; forward-backward marginals, weighted by line length, give the share of good text, and a
logistic curve fitted on the training documents turns it into a probability.

Training uses at most ``SAMPLE`` labelled documents; a line starts out with its document's label.
Scoring sees the whole text, line by line, in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import (
    SPACES,
    U64,
    labelled_texts,
    mix,
    ship,
    slices,
    text_bytes,
    words,
)

ship(__name__)
SAMPLE = 4000  # labelled documents the model is fitted on, at most
ROUNDS = 120
_CLASSES = 8  # of bytes: other, lower case, upper case, digit, blank, stop, bar, sign


def _byte_classes() -> np.ndarray:
    out = np.full(256, 7, np.uint8)
    out[128:] = 1
    out[97:123], out[65:91], out[48:58] = 1, 2, 3
    out[[32, 9, 13]] = 4
    out[[ord(c) for c in ".,;:?'\"()-"]] = 5
    out[ord("|")] = 6
    out[:9] = 0
    return out


CLASS = _byte_classes()
RATIO_EDGES = np.array([1e-9, 0.01, 0.03, 0.08, 0.15, 0.3, 0.6])
SIZE_EDGES = np.array([4.0, 16, 40, 100, 250, 700, 2000])
WORD_EDGES = np.array([1.0, 2.5, 3.5, 4.5, 5.5, 7.0, 10.0])
BINS, KINDS = 8, 11


@dataclass
class Lines:
    """Non-blank lines of a batch: size, binned features, and the first line of each row."""

    size: np.ndarray
    bins: np.ndarray
    first: np.ndarray


def read_lines(column: pa.Array) -> Lines:
    data, offsets = text_bytes(column)
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    begins[1:][data == 10] = True
    start = np.flatnonzero(begins[:n])
    if not len(start):
        return Lines(np.zeros(0), np.zeros((0, KINDS), np.int64), np.zeros(len(offsets), np.int64))
    end = np.append(start[1:], n)
    line = np.repeat(np.arange(len(start)), end - start)
    kinds = np.bincount(line * _CLASSES + CLASS[data], minlength=len(start) * _CLASSES)
    kinds = kinds.reshape(-1, _CLASSES).astype(float)
    kinds[:, 7] -= np.bincount(line[data == 10], minlength=len(start))  # line ends
    w = words(data, offsets, SPACES)
    of = line[w.start]
    n_words = np.bincount(of, minlength=len(start)).astype(float)
    again = np.zeros(len(of), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of[again], minlength=len(start))
    row = np.searchsorted(offsets, start, "right") - 1
    # The same words in an earlier line of the text.
    place = (np.arange(len(of)) - np.searchsorted(of, np.arange(len(start)))[of]).astype(U64)
    whole = np.zeros(len(start), U64)
    np.add.at(whole, of, mix(w.hash + place * U64(0x9E3779B97F4A7C15)))
    order = np.lexsort((start, whole, row))
    seen = np.zeros(len(start), bool)
    seen[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    keep = np.flatnonzero(n_words)
    kinds, n_words, repeats, seen, row = (x[keep] for x in (kinds, n_words, repeats, seen, row))
    size = kinds.sum(1)
    solid = np.maximum(size - kinds[:, 4], 1)
    share = [kinds[:, k] / solid for k in (1, 2, 3, 5, 6, 7)]
    share += [repeats / n_words, kinds[:, 7] / n_words / 4]
    bins = [np.digitize(x, RATIO_EDGES) for x in share]
    bins += [
        np.digitize(size, SIZE_EDGES),
        np.digitize(solid / n_words, WORD_EDGES),
        seen.astype(np.int64),
    ]
    first = np.searchsorted(row, np.arange(len(offsets)))
    return Lines(size, np.stack(bins, 1), first)


def _features(lines: Lines) -> np.ndarray:
    """Indices of the active weights per line: own, previous and next line; 0 where none."""
    n, d = lines.bins.shape
    own = lines.bins + np.arange(d) * BINS
    out = np.zeros((n, 3 * d), np.int64)
    out[:, :d] = own + 1
    edge = np.zeros(n + 1, bool)
    edge[lines.first] = True
    after = ~edge[1:n] if n else edge[:0]
    out[1:, d : 2 * d][after] = own[:-1][after] + 1 + d * BINS
    out[:-1, 2 * d :][after] = own[1:][after] + 1 + 2 * d * BINS
    return out


def marginals(score: np.ndarray, first: np.ndarray, move: np.ndarray, pairs: bool = False):
    """P(good) per line, and the summed pair marginals if asked for.

    Rows are advanced together, longest first, so step t touches the rows with over t lines.
    """
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    longest = int(count.max()) if len(count) else 0
    active = np.searchsorted(-count[order], -np.arange(longest), "left")
    begin = first[:-1][order]
    local = np.ones((len(score), 2))
    local[:, 1] = np.exp(np.clip(score, -30, 30))
    change = np.exp(np.clip(move, -10, 10))
    ahead, back = np.zeros((len(score), 2)), np.ones((len(score), 2))
    for t in range(longest):
        at = begin[: active[t]] + t
        x = local[at] if t == 0 else (ahead[at - 1] @ change) * local[at]
        ahead[at] = x / x.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        x = (local[at + 1] * back[at + 1]) @ change.T
        back[at] = x / x.sum(1, keepdims=True)
    good = ahead * back
    good = good[:, 1] / good.sum(1) if len(good) else good[:, 1]
    if not pairs:
        return good, None
    total = np.zeros((2, 2))
    inner = np.ones(len(score), bool)
    inner[first[:-1][count > 0]] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] * change * (local[at] * back[at])[:, None, :]
    total = (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return good, total


def _logit(x):
    x = np.clip(x, 1e-4, 1 - 1e-4)
    return np.log(x / (1 - x))


@dataclass
class Model:
    weights: np.ndarray
    move: np.ndarray
    slope: float
    offset: float

    def documents(self, lines: Lines) -> np.ndarray:
        """The score of every row; rows without lines get the score of half-good text."""
        rows = len(lines.first) - 1
        share = np.full(rows, 0.5)
        if len(lines.size):
            good, _ = marginals(
                self.weights[_features(lines)].sum(1), lines.first, self.move
            )
            row = np.repeat(np.arange(rows), np.diff(lines.first))
            total = np.bincount(row, lines.size, rows)
            part = np.bincount(row, lines.size * good, rows)
            share = np.where(total > 0, part / np.maximum(total, 1), 0.5)
        return 1 / (1 + np.exp(-(self.slope * _logit(share) + self.offset)))


def fit(lines: Lines, labels: list[int]) -> Model:
    """Maximum likelihood by gradient steps with per-weight scaling; a weak pull to zero."""
    active = _features(lines)
    count = np.diff(lines.first)
    label = np.asarray(labels, float)
    y = np.repeat(label, count)
    width = 3 * lines.bins.shape[1] * BINS + 1
    theta, scale = np.zeros(width + 4), np.full(width + 4, 1e-6)
    inner = np.ones(len(y), bool)
    inner[lines.first[:-1][count > 0]] = False
    same = np.zeros((2, 2))
    for a in (0, 1):
        same[a, a] = (y[inner] == a).sum()
    momentum = np.zeros_like(theta)
    for step in range(ROUNDS if len(y) else 0):
        move = theta[width:].reshape(2, 2)
        good, pairs = marginals(theta[:width][active].sum(1), lines.first, move, True)
        grad = np.zeros_like(theta)
        wrong = np.repeat(y - good, active.shape[1])
        grad[:width] = np.bincount(active.ravel(), wrong, width)
        grad[width:] = (same - pairs).ravel()
        grad = grad / max(len(y), 1) - 1e-4 * theta
        momentum = 0.9 * momentum + 0.1 * grad
        scale = 0.99 * scale + 0.01 * grad**2
        theta += 0.1 * momentum / (np.sqrt(scale / (1 - 0.99 ** (step + 1))) + 1e-6)
    model = Model(theta[:width], theta[width:].reshape(2, 2), 1.0, 0.0)
    x = _logit(model.documents(lines)) if len(label) else label
    for _ in range(200 if len(label) else 0):
        p = 1 / (1 + np.exp(-(model.slope * x + model.offset)))
        w = p * (1 - p) + 1e-6
        g = np.array([((label - p) * x).sum() - 0.01 * (model.slope - 1), (label - p).sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        d = np.linalg.solve(h, g)
        model.slope, model.offset = model.slope + 0.5 * d[0], model.offset + 0.5 * d[1]
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of ``labels(doc_id, quality)`` joined with their texts."""
    # Tasks read the lines; only their sizes and bins come to the driver.
    rows = (
        labelled_texts(docs, labels, "quality", sample)
        .select(F.xxhash64("doc_id", "text").alias("_order"), "text", F.col("quality").cast("long"))
        .mapInArrow(_read, "_order long, quality long, size binary, bins binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["_order"], r["quality"]))
    size = [np.frombuffer(r["size"]) for r in rows]
    lines = Lines(
        np.concatenate([np.zeros(0), *size]),
        np.frombuffer(b"".join(r["bins"] for r in rows), np.uint8).reshape(-1, KINDS).astype(np.int64),
        np.concatenate([[0], np.cumsum([len(x) for x in size])]).astype(np.int64),
    )
    return fit(lines, [int(r["quality"]) for r in rows])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        lines = read_lines(batch.column("text"))
        runs = list(zip(lines.first[:-1], lines.first[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_order"),
                batch.column("quality"),
                pa.array([lines.size[a:b].tobytes() for a, b in runs], pa.binary()),
                pa.array([lines.bins[a:b].astype(np.uint8).tobytes() for a, b in runs], pa.binary()),
            ],
            ["_order", "quality", "size", "bins"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of good quality) for every row.

    Null, empty and blank texts get the score of text that is half good.  Other columns are
    ignored; repeated rows get equal scores; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = model.documents(read_lines(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out)], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.col("score"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            good = model.documents(read_lines(batch.column("text"))) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
