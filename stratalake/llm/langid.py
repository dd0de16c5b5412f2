"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into windows of ``WINDOW`` bytes; a forward and a backward gated recurrent layer
read each window, and every byte position gets a probability per language.  A document's
probabilities are the mean over all its positions.  The layers squash with x / (1 + |x|), which
numpy computes several times faster than the hyperbolic tangent, and learn as well with it.  The network is trained here, in numpy, by
backpropagation through time on a bounded sample of labelled windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bounded_sample, ship, slices, text_bytes
from stratalake.storage import written_copy

ship(__name__)
WINDOW, HIDDEN, TOGETHER = 48, 8, 2048
SAMPLE = 6000  # labelled documents the network is trained on, at most; three pieces of each
PIECE, BATCH, STEPS, RATE = 96, 256, 320, 0.02
LETTER = r"\p{L}"


def _squash(x):
    y = np.abs(x)
    y += 1
    return np.divide(x, y, out=y)


def _slope(y):
    """The derivative of the squashing function where its value is ``y``."""
    y = 1 - np.abs(y)
    return y * y


def _gates(x, u, h):
    """One step, features by windows: update, reset, candidate, its recurrent part, new state."""
    k = h.shape[0]
    a = u @ h
    gate = _squash(x[: 2 * k] + a[: 2 * k])
    gate += 1
    gate *= 0.5
    z, r = gate[:k], gate[k:]
    n = _squash(x[2 * k :] + r * a[2 * k :])
    new = h - n
    new *= z
    new += n
    return z, r, n, a[2 * k :], new


@dataclass
class Network:
    """Two directions: input tables [3h, 256] and recurrent matrices [3h, h]; output layer."""

    langs: list[str]
    table: list[np.ndarray]
    inner: list[np.ndarray]
    out: np.ndarray  # [languages, 2h + 1]

    def states(self, codes: np.ndarray, direction: int) -> np.ndarray:
        """[h, length, windows] for ``codes`` [length, windows]."""
        length, n = codes.shape
        h = np.zeros((self.inner[direction].shape[1], n), np.float32)
        out = np.empty((h.shape[0], length, n), np.float32)
        table, u = self.table[direction], self.inner[direction]
        x = np.empty((len(table), n), np.float32)
        for t in range(length) if direction == 0 else range(length - 1, -1, -1):
            h = _gates(table.take(codes[t], axis=1, out=x, mode="clip"), u, h)[-1]
            out[:, t] = h
        return out

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities [languages, length, windows] of every position."""
        k = self.inner[0].shape[1]
        length, n = codes.shape
        logit = self.out[:, :k] @ self.states(codes, 0).reshape(k, -1)
        logit += self.out[:, k : 2 * k] @ self.states(codes, 1).reshape(k, -1)
        logit += self.out[:, 2 * k :]
        logit -= logit.max(0)
        np.exp(logit, out=logit)
        logit /= logit.sum(0)
        return logit.reshape(-1, length, n)

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities [rows, languages]; zero for rows without bytes."""
        sizes = np.diff(offsets)
        count = -(-sizes // WINDOW)
        row = np.repeat(np.arange(len(sizes)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = offsets[:-1][row] + nth * WINDOW
        used = np.minimum(offsets[1:][row] - start, WINDOW)
        total = np.zeros((len(sizes), len(self.langs)))
        padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
        for a in range(0, len(row), TOGETHER):
            s, m = start[a : a + TOGETHER], used[a : a + TOGETHER]
            steps = np.arange(WINDOW)[:, None]
            codes = padded[s + steps].astype(np.intp)
            valid = steps < m
            codes[~valid] = 0
            p = self.positions(codes)
            p *= valid
            for k, sums in enumerate(p.sum(1)):
                total[:, k] += np.bincount(row[a : a + TOGETHER], sums, len(sizes))
        return total / np.maximum(sizes, 1)[:, None]


def train_network(codes: np.ndarray, label: np.ndarray, langs: list[str], seed: int = 5) -> Network:
    """Adam on the mean log-likelihood of all positions of ``codes`` [samples, length]."""
    rng = np.random.default_rng(seed)
    k, c = HIDDEN, len(langs)
    net = Network(
        langs,
        [rng.normal(0, 0.3, (3 * k, 256)).astype(np.float32) for _ in (0, 1)],
        [rng.normal(0, 0.35, (3 * k, k)).astype(np.float32) for _ in (0, 1)],
        rng.normal(0, 0.1, (c, 2 * k + 1)).astype(np.float32),
    )
    params = [*net.table, *net.inner, net.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = 0
    for _ in range(-(-STEPS * BATCH // len(codes))):
        order = rng.permutation(len(codes))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            steps += 1
            for p, g, m, v in zip(params, _gradient(net, codes[pick].T, label[pick]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)
    return net


def _gradient(net: Network, codes: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Gradients of the loss by backpropagation through time, for codes [length, n]."""
    codes = codes.astype(np.intp)
    length, n = codes.shape
    k = net.inner[0].shape[1]
    kept: list[list] = [[], []]
    state = np.zeros((2, k, length, n), np.float32)
    for d in (0, 1):
        h = np.zeros((k, n), np.float32)
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            z, r, m, am, new = _gates(net.table[d].take(codes[t], axis=1), net.inner[d], h)
            kept[d].append((t, h, z, r, m, am))
            state[d, :, t] = h = new
    both = np.concatenate([state[0].reshape(k, -1), state[1].reshape(k, -1), np.ones((1, length * n), np.float32)])
    logit = net.out @ both
    logit -= logit.max(0)
    p = np.exp(logit)
    p /= p.sum(0)
    p[np.tile(label, length), np.arange(length * n)] -= 1
    p /= length * n
    grad_out = p @ both.T
    tables, inners = [], []
    for d in (0, 1):
        above = (net.out[:, d * k : (d + 1) * k].T @ p).reshape(k, length, n)
        gt, gu = np.zeros_like(net.table[d]), np.zeros_like(net.inner[d])
        carry = np.zeros((k, n), np.float32)
        for t, h, z, r, m, am in reversed(kept[d]):
            g = above[:, t] + carry
            dm = g * (1 - z) * _slope(m)
            dz = g * (h - m) * 0.5 * _slope(2 * z - 1)
            dr = dm * am * 0.5 * _slope(2 * r - 1)
            da = np.concatenate([dz, dr, dm * r])
            dx = np.concatenate([dz, dr, dm])
            gu += da @ h.T
            for i in range(3 * k):
                gt[i] += np.bincount(codes[t], dx[i], 256)
            carry = g * z + net.inner[d].T @ da
        tables.append(gt)
        inners.append(gu)
    return [*tables, *inners, grad_out]


def train(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Learn from ``docs(doc_id, text, lang)``; None if there is nothing to learn from."""
    size = F.length("text")
    usable = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    usable = usable.where(F.col("text").rlike(LETTER))
    pieces = [
        F.substring(
            F.col("text"),
            (F.pmod(F.xxhash64("doc_id", F.lit(j)), F.greatest(size - PIECE, F.lit(1))) + 1).cast("int"),
            F.lit(PIECE),
        )
        for j in range(3)
    ]
    # One row per doc_id (the smallest language and pieces), written by tasks: the driver gets
    # the sample and nothing else.
    known = usable.where("doc_id is not null").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    chosen = F.broadcast(written_copy(bounded_sample(known, "doc_id", sample), "language_sample"))
    cut = usable.join(chosen, ["doc_id", "lang"]).select("doc_id", "lang", F.array(*pieces).alias("pieces"))
    rows = cut.groupBy("doc_id", "lang").agg(F.min("pieces").alias("pieces")).collect()
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    codes, label = [], []
    for r in sorted(rows, key=lambda r: (str(r["doc_id"]), r["pieces"])):
        for piece in r["pieces"]:
            raw = piece.encode()[:WINDOW]
            codes.append(np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8))
            label.append(langs.index(r["lang"]))
    return train_network(np.stack(codes), np.array(label), langs)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs(doc_id, text)``.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing
    was learned.  Ties go to the first language in order.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch.column("text"), "")
            known = pc.match_substring_regex(texts, LETTER).to_numpy(zero_copy_only=False)
            names, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if net is not None:
                mean = net.documents(*text_bytes(texts))
                best = mean.argmax(1)
                names = [net.langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
                score = np.where(known, np.clip(mean.max(1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )
